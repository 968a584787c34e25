"""Operator 2: near-duplicates by Order MinHash.

A text is its words; its k-mers are runs of words, labelled with how often each stood before. For each of
`entries` hash functions the sketch takes the `taken` labelled k-mers of the least hashes and keeps them in text
order, so two sketches agree in an entry when the same k-mers stand in the same order: alike in the sense of
edits, not of word sets. Texts that agree in one entry share a bucket; a pair that agrees in `least_agreed`
entries or more is a candidate.

A third of the entries is of five words running. Where a word in five is edited few of those are left, and in short
texts none, so the other thirds are of three and of two words, and of two and one in short texts (`sizes`). Each entry
changes at a length of its own, so that texts of about one length have most entries in common.

A banded alignment decides: a link is a pair whose edit similarity, twice the most words in one order over the
words of both, is the threshold or more. Classes are what links connect.

  1. Equal texts become one vertex.
  2. Each text meets the head of its buckets, the least text there, where they share enough of them. A group of
     any number of near copies becomes one component by as many alignments as it has texts.
  3. In each bucket that still holds several components, sketches are compared as arrays in blocks of bounded
     size, and the candidates of different components aligned, until each is linked or refused. A bucket larger
     than a block is dealt out as pairs of blocks, a far larger one first by the second entry that pairs agree in:
     whichever copies its texts less often.

No pair of rows is made by a join, and no candidate that could join two components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import TO_WORDS, Tables, bounded_broadcast, columns_of, hashed_words

SHINGLE = 5
#: Words of a text between which entries of the second third go from two words to three, and the last third's from one
#: to two.
TWO_TO_THREE, ONE_TO_TWO = (10, 30), (6, 18)
#: Texts of a bucket that are compared with one another, or with as many others, at once.
BLOCK = 800
#: Copies of a text, one a pair of blocks, beyond which a bucket is rather dealt out by the second entry agreed in.
COPIES = 16
#: Texts that meet one copy of their bucket's head.
HEAD_BLOCK = 200
#: Characters of a bucket's block.
BLOCK_CHARS = 4_000_000
#: Broadcast at most so many texts' keys; more are joined by a shuffle.
BROADCAST_KEYS = 100_000
#: Words of one text that the alignment takes as the bits of one number.
BITS = 2048
#: Hashes of a sketch that are held at once.
HELD = 1 << 20

_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def word_hashes(text: str | None) -> np.ndarray:
    """64 bits of each word of a text, A-Z lower-cased."""
    return hashed_words((text or "").encode().translate(TO_WORDS))


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """64 bits of each run of `size` words; of all words if they are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    h = words[: len(words) - size + 1].copy()
    for k in range(1, size):
        h = h * _BASE + words[k : len(words) - size + 1 + k]
    h *= _MIX
    return h ^ (h >> np.uint64(29))


def labelled(kmers: np.ndarray) -> np.ndarray:
    """k-mers mixed with the number of equal ones before each."""
    order = np.argsort(kmers, kind="stable")
    same = kmers[order]
    fresh = np.concatenate([[True], same[1:] != same[:-1]])
    if fresh.all():
        return kmers
    run = np.arange(len(kmers)) - np.maximum.accumulate(np.where(fresh, np.arange(len(kmers)), 0))
    occurrence = np.empty(len(kmers), dtype=np.uint64)
    occurrence[order] = run
    h = (kmers + occurrence * _BASE) * _MIX
    return np.where(occurrence > 0, h ^ (h >> np.uint64(32)), kmers)


def _least(x: np.ndarray, drawn: np.ndarray, taken: int) -> np.ndarray:
    """Places, in text order, of the `taken` k-mers of the least hashes, a column a hash function."""
    h = (x[None, :] ^ drawn[0][:, None]) * (drawn[1][:, None] | np.uint64(1))
    h ^= h >> np.uint64(32)
    h *= _MIX
    rows = np.arange(len(h))
    places = []
    for _ in range(min(taken, len(x))):
        at = h.argmin(axis=1)
        places.append(at)
        h[rows, at] = np.uint64(0xFFFFFFFFFFFFFFFF)
    return np.sort(np.stack(places), axis=0)


def sizes(words: int, entries: int) -> np.ndarray:
    """Words of a k-mer in each entry, for a text of so many words."""
    ends = [entries * k // 3 for k in range(4)]

    def above(least: int, most: int, n: int) -> np.ndarray:
        return words > least * (most / least) ** ((np.arange(n) + 0.5) / max(n, 1))

    second, last = ends[2] - ends[1], ends[3] - ends[2]
    return np.concatenate([np.full(ends[1], SHINGLE), 2 + above(*TWO_TO_THREE, second), 1 + above(*ONE_TO_TWO, last)])


def sketch(words: np.ndarray, entries: int, taken: int) -> np.ndarray:
    """The Order MinHash sketch: `entries` numbers of 64 bits. words: at least one."""
    drawn = np.random.default_rng(20190701).integers(1, 1 << 63, size=(2, entries), dtype=np.uint64)
    size_of = sizes(len(words), entries)
    out = np.zeros(entries, dtype=np.uint64)
    for size in np.unique(size_of).tolist():
        x = labelled(shingles(words, size))
        own = np.flatnonzero(size_of == size)
        step = max(1, HELD // len(x))
        for at in range(0, len(own), step):
            part = own[at : at + step]
            for places in _least(x, drawn[:, part], taken):
                out[part] = (out[part] ^ x[places]) * _BASE
                out[part] ^= out[part] >> np.uint64(30)
    return out


def sketches(docs: DataFrame, entries: int, taken: int) -> DataFrame:
    """(uid, chars, sketch) of each text with a word; uid is the MD5 of the text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list] = [[], [], []]
            for k, uid in enumerate(batch.column("uid").to_pylist()):
                text = batch.column("text")[k].as_py()
                words = word_hashes(text)
                if len(words):
                    for column, value in zip(found, (uid, len(text), sketch(words, entries, taken).astype(np.int64)), strict=True):
                        column.append(value)
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, (pa.binary(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["uid", "chars", "sketch"])

    return docs.select("uid", "text").mapInArrow(rows, "uid binary, chars long, sketch array<long>")


def words_in_order(a: list[int], b: list[int], band: int) -> int:
    """The most words of a and b in one order, of equal ones at most `band` places apart.

    The columns of the table are bits of a number, BITS words of `a` at a time: what a row of it adds is carried from
    one number to the next. Only places within the band are visited, and memory is linear in the texts.
    """
    carried = bytearray(len(b))
    found = 0
    for low in range(0, len(a), BITS):
        part = a[low : low + BITS]
        size = len(part)
        marks: dict[int, int] = {}
        for k, w in enumerate(part):
            marks[w] = marks.get(w, 0) | 1 << k
        full = free = (1 << size) - 1
        for j in range(max(0, low - band), min(len(b), low + size + band)):
            equal = marks.get(b[j], 0)
            if equal:
                least, most = j - band - low, j + band + 1 - low
                if least > 0:
                    equal = equal >> least << least
                if most < size:
                    equal &= (1 << most) - 1
            elif not carried[j]:
                continue
            both = free & equal
            total = free + both + carried[j]
            carried[j] = total >> size
            free = (total | (free - both)) & full
        found += size - free.bit_count()
    return found


class Words:
    """A text's words, and the same in sorted order with their numbers of occurrence."""

    def __init__(self, text: str):
        self.hashes = word_hashes(text)
        self.bag = np.sort(labelled(self.hashes))


def alike(a: Words, b: Words, threshold: float) -> bool:
    """Whether the edit similarity of two texts is the threshold or more.

    An alignment of that similarity has at most (1 - threshold) * all words edits and so keeps within a band as wide.
    The band begins narrow and widens while the answer is open.
    """
    x, y = a.hashes, b.hashes
    both = len(x) + len(y)
    needed = threshold * both / 2 - 1e-9
    if min(len(x), len(y)) < needed:
        return False
    at = np.searchsorted(a.bag, b.bag)
    if np.count_nonzero(a.bag[np.minimum(at, len(a.bag) - 1)] == b.bag) < needed:
        return False
    n = min(len(x), len(y))
    other = np.flatnonzero(x[:n] != y[:n])
    head = int(other[0]) if len(other) else n
    other = np.flatnonzero(x[::-1][: n - head] != y[::-1][: n - head])
    tail = int(other[0]) if len(other) else n - head
    p, q = x[head : len(x) - tail].tolist(), y[head : len(y) - tail].tolist()
    widest = int((1 - threshold) * both) + 1
    band = min(widest, 64 + abs(len(p) - len(q)))
    while head + tail + words_in_order(p, q, band) < needed:
        if band >= widest:
            return False
        band = min(widest, 4 * band)
    return True


def sketch_table(at: list[list[int]], keys: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Entries that texts hold as a table, a text a row, and which of its cells are held."""
    rows = np.repeat(np.arange(len(at)), [len(x) for x in at])
    columns = np.concatenate([np.asarray(x, dtype=np.int64) for x in at])
    table = np.zeros((len(at), int(columns.max()) + 1), dtype=np.int64)
    held = np.zeros(table.shape, dtype=bool)
    table[rows, columns] = np.concatenate([np.asarray(x, dtype=np.int64) for x in keys])
    held[rows, columns] = True
    return table, held


def owned_pairs(table: np.ndarray, held: np.ndarray, comps: np.ndarray, sides: np.ndarray, entry: int, second: int, least_agreed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of a bucket's candidates, a pair a row, and the entries each agrees in.

    table: a sketch a row; held: the cells that count. comps: components; pairs of one are none. sides: the block of
    each row; where there are two, only pairs across them count. entry: the first entry that the bucket's pairs agree
    in, so that each pair is in one bucket only; second: the second one, -1 where the bucket is not dealt out by it.
    """
    n, last = len(table), max(entry, second)
    agreed, before = np.zeros((n, n), dtype=np.int16), np.zeros((n, n), dtype=np.int16)
    for k in range(table.shape[1]):
        if k == last:
            before = agreed.copy()
        rows = np.flatnonzero(held[:, k])
        if len(rows) == n:
            agreed += table[:, k][:, None] == table[:, k][None, :]
        elif len(rows) > 1:
            own = table[rows, k]
            agreed[np.ix_(rows, rows)] += own[:, None] == own[None, :]
    own = (agreed >= least_agreed) & (before == (second >= 0)) & (comps[:, None] != comps[None, :])
    if sides.min() != sides.max():
        own &= sides[:, None] != sides[None, :]
    pairs = np.argwhere(np.triu(own))
    return pairs, agreed[pairs[:, 0], pairs[:, 1]]


def links_of_bucket(texts: list[str], pairs: np.ndarray, comps: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """The candidates that the alignment links, but for those whose texts are connected before their turn."""
    parent: dict[int, int] = {}
    words: dict[int, Words] = {}
    found = []

    def top(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for x, y in pairs.tolist():
        p, q = top(int(comps[x])), top(int(comps[y]))
        if p != q:
            for k in (x, y):
                if k not in words:
                    words[k] = Words(texts[k])
            if alike(words[x], words[y], threshold):
                parent[p] = q
                found.append((x, y))
    return found


def gathered(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of a key running together and in order, in partitions by key."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys, *order)


def runs_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """The rows of each key in turn, where they run together and the key is the first columns."""
    held: list[tuple] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for row in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns], strict=True):
                if held and held[0][:keys] != row[:keys]:
                    yield held
                    held = []
                held.append(row)
    if held:
        yield held


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*pairs, strict=True)], names=["a", "b"])


def head_links(shared: DataFrame, texts: DataFrame, threshold: float, least_agreed: int, tables: Tables) -> DataFrame:
    """(a, b): links of texts with the heads of their buckets. shared: entry, key, uid, n, head. texts: uid, text.

    A head of very many texts is dealt out, with as many copies of its own text as there are blocks of them.
    """
    candidates = shared.where("uid <> head").groupBy("uid", "head").agg(F.count(F.lit(1)).alias("met"), F.max("n").alias("n")).where(F.col("met") >= least_agreed)
    blocks = F.ceil(F.col("n") / HEAD_BLOCK)
    placed = tables.written(candidates.select("head", blocks.alias("blocks"), F.pmod(F.xxhash64("uid"), blocks).alias("part"), "uid"), "candidates")
    members = placed.withColumn("role", F.lit(1))
    heads = placed.select("head", "blocks", "part").distinct().select("*", F.col("head").alias("uid"), F.lit(0).alias("role"))
    rows = members.unionByName(heads).join(texts, "uid").select("head", "blocks", "part", "role", "uid", "text")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, None
        for batch in batches:
            found = []
            for k in range(batch.num_rows):
                uid, role = batch.column("uid")[k].as_py(), batch.column("role")[k].as_py()
                if role == 0:
                    if uid != head:
                        head, own = uid, Words(batch.column("text")[k].as_py())
                elif alike(own, Words(batch.column("text")[k].as_py()), threshold):
                    found.append((uid, head))
            if found:
                yield _edges(found)

    return gathered(rows, ["head", "blocks", "part"], ["role"]).mapInArrow(linked, "a binary, b binary")


_BUCKET = ["entry", "key", "second", "key2"]


def _live(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows of the buckets that hold several components, with the bucket's n texts and chars."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("all_chars"), F.min("comp").alias("_least"), F.max("comp").alias("_most"))
    return rows.join(sizes.where("_least <> _most").drop("_least", "_most"), keys)


def bucket_links(shared: DataFrame, comps: DataFrame, sketched: DataFrame, texts: DataFrame, threshold: float, least_agreed: int, tables: Tables) -> DataFrame:
    """(a, b): links of candidates between different components. comps: uid and comp of texts already linked.

    What a pair agrees in are buckets of several components, so of a sketch no more than its entries in such buckets
    goes along, and texts with fewer of them than a candidate needs go first.
    """
    own = sketched.select("uid", "chars").join(bounded_broadcast(comps, BROADCAST_KEYS), "uid", "left").withColumn("comp", F.coalesce("comp", "uid"))
    named = shared.select("entry", "key", "uid").join(own, "uid").repartition("entry", "key")
    held = _live(named, ["entry", "key"]).groupBy("uid").agg(F.first("chars").alias("chars"), F.first("comp").alias("comp"), F.collect_list(F.struct("entry", "key", "n", "all_chars")).alias("held"))
    held = tables.written(held.where(F.size("held") >= least_agreed), "open")
    rows = held.select("uid", "chars", "comp", "held", F.explode("held").alias("_own")).select("uid", "chars", "comp", "held", "_own.*")
    rows = rows.withColumns({"second": F.lit(-1), "key2": F.lit(0).cast("long")})
    if least_agreed > 1:
        wide = rows.where(F.col("n") > COPIES * BLOCK).drop("n", "all_chars", "second", "key2").select("*", F.explode("held").alias("_other"))
        wide = wide.select("*", F.col("_other.entry").alias("second"), F.col("_other.key").alias("key2")).drop("_other").where("second > entry")
        rows = rows.where(F.col("n") <= COPIES * BLOCK).unionByName(_live(wide, _BUCKET))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.least(F.ceil(F.col("all_chars") / BLOCK_CHARS), F.ceil(F.col("n") / 2))).cast("int")
    placed = rows.withColumn("own", F.pmod(F.xxhash64("uid"), blocks).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    placed = placed.withColumn("i", F.least("own", "_other")).withColumn("j", F.greatest("own", "_other"))
    keys = [*_BUCKET, "i", "j"]
    columns = [*keys, "uid", "comp", "place", "later"]

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts with a candidate: their place in the bucket, and of each candidate after it entries and place."""
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.int64())]
        for group in runs_of(batches, len(keys)):
            if len(group) < 2:
                continue
            table, cells = sketch_table([g[9] for g in group], [g[10] for g in group])
            comps = np.unique(np.array([g[8].hex() for g in group]), return_inverse=True)[1]
            pairs, agreed = owned_pairs(table, cells, comps, np.array([g[7] for g in group]), group[0][0], group[0][2], least_agreed)
            if len(pairs):
                later: dict[int, list[int]] = {k: [] for k in np.unique(pairs).tolist()}
                for (x, y), n in zip(pairs.tolist(), agreed.tolist(), strict=True):
                    later[x].append(n << 32 | y)
                out = [(*group[k][:7], group[k][8], k, own) for k, own in later.items()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=columns)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of(batches, len(keys)):
            row = {g[8]: k for k, g in enumerate(group)}
            # those that agree most first
            ordered = sorted((-(y >> 32), g[8], y & 0xFFFFFFFF) for g in group for y in g[9])
            pairs = np.array([(row[x], row[y]) for _, x, y in ordered])
            comps = np.unique(np.array([g[7].hex() for g in group]), return_inverse=True)[1]
            found = links_of_bucket([g[10] for g in group], pairs, comps, threshold)
            if found:
                yield _edges([(group[x][6], group[y][6]) for x, y in found])

    schema = "entry int, key long, second int, key2 long, i int, j int, uid binary, comp binary, place int, later array<long>"
    bucket = placed.select(*keys, "uid", "own", "comp", F.col("held.entry").alias("at"), F.col("held.key").alias("keys"))
    taking = tables.written(gathered(bucket, keys, ["uid"]).mapInArrow(partners, schema), "partners")
    return gathered(taking.join(texts, "uid").select(*columns, "text"), keys, ["uid"]).mapInArrow(linked, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(uid, comp) of each vertex of the edges (a, b); comp is the least uid of its component.

    Rounds of two steps, each a grouping of the edges: the neighbours above a vertex, then those below it, are
    hung on the least of all. Edges stay as many as they were at most. Each round ends in a written table,
    which goes when the next one stands.
    """
    rounds = 0
    tables = Tables(edges.sparkSession)
    now = tables.written(edges.where("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges-0")
    while True:
        both = now.select("v", "u").unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m"))
        hung = both.where(F.col("u") > F.col("v")).join(bounded_broadcast(least, BROADCAST_KEYS), "v").select(F.col("u").alias("v"), F.least("m", "v").alias("u"))
        large = hung.distinct()
        below = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(bounded_broadcast(below, BROADCAST_KEYS), "v")
        after = small.select("v", F.col("m").alias("u")).unionByName(small.where(F.col("u") != F.col("m")).select(F.col("u").alias("v"), F.col("m").alias("u"))).where("v != u").distinct()
        after = tables.written(after, f"edges-{rounds + 1}")
        tables.drop(f"edges-{rounds}")
        rounds += 1
        # a star when every vertex hangs on one and none that is hung on hangs itself
        stars = after.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty() and after.join(after.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()
        now = after
        if stars:
            break
    return now.select(F.col("v").alias("uid"), F.col("u").alias("comp")).unionByName(now.select(F.col("u").alias("uid"), F.col("u").alias("comp")).distinct())


def near_duplicates(docs: DataFrame, threshold: float = 0.8, entries: int = 48, taken: int = 2, least_agreed: int = 2) -> DataFrame:
    """One row a document: doc_id, uid, class_id, class_size, n_links and kept.

    class_id is the least doc_id of the document's class, class_size its rows. n_links counts the other texts that an
    alignment linked to the document's own: those links alone connect the class, and texts that others had connected
    before their turn aren't aligned. kept marks the rows of class_id's text: repeated rows are all marked. A text without words, null and empty ones too, is in no class but its own and is
    kept. Null doc_ids come after others; an empty table gives no rows; other columns are not looked at.
    """
    own = columns_of(docs).withColumn("uid", F.unhex(F.md5(F.col("text").cast("binary"))))
    texts = own.select("uid", "text").where("text is not null")
    # a text on a third of the rows is sketched in each task that has it, and is one row from here on
    tables = Tables(docs.sparkSession)
    found = tables.written(sketches(texts, entries, taken).groupBy("uid").agg(F.first("chars").alias("chars"), F.first("sketch").alias("sketch")), "sketches")
    # one shuffle of all entries: the sizes of buckets are counted where the buckets' rows lie
    spread = found.select("uid", F.posexplode("sketch").alias("entry", "key")).repartition("entry", "key")
    buckets = spread.groupBy("entry", "key").agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("head")).where("n > 1")
    shared = tables.written(spread.join(buckets, ["entry", "key"]), "shared")
    several = shared.groupBy("uid").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least_agreed).select("uid")
    texts = tables.bucketed(texts.join(bounded_broadcast(several, BROADCAST_KEYS), "uid").groupBy("uid").agg(F.first("text").alias("text")), "texts", "uid")
    links = tables.written(head_links(shared, texts, threshold, least_agreed, tables), "links")
    tables.drop("candidates")
    grouped = tables.written(components(links), "groups")
    links = links.unionByName(tables.written(bucket_links(shared, grouped, found, texts, threshold, least_agreed, tables), "links"))
    tables.drop("partners", "open", "shared", "texts", "groups")
    comps = tables.written(components(links), "components")
    met = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().groupBy(F.col("a").alias("uid")).agg(F.count(F.lit(1)).alias("n_links"))
    # doc_ids and rows of each text, then of each class
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid"))
    per_text = own.where(F.col("uid").isNotNull()).groupBy("uid").agg(head.alias("head"), F.count(F.lit(1)).alias("n"))
    per_text = per_text.join(found.select("uid"), "uid", "left_semi").join(comps.join(met, "uid", "left"), "uid", "left")
    per_text = tables.written(per_text.where("n > 1 or comp is not null").withColumn("comp", F.coalesce("comp", "uid")), "classed")
    per_class = per_text.groupBy("comp").agg(F.min("head").alias("head"), F.sum("n").alias("class_size"))
    named = tables.written(per_text.drop("head", "n").join(bounded_broadcast(per_class, BROADCAST_KEYS), "comp").select("uid", "head", "class_size", "n_links"), "classes")
    tables.drop("classed", "components", "links", "sketches")
    joined = own.select("doc_id", "uid").join(bounded_broadcast(named, BROADCAST_KEYS), "uid", "left")
    return joined.select(
        "doc_id",
        "uid",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("head").isNull() | (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("uid") == F.col("head.uid")))).alias("kept"),
    )


def keep_one(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of docs without their near-duplicates: one of each class stays, with its columns, whatever their names.

    Null and empty texts and null doc_ids stay where near_duplicates() keeps them; of repeated rows one stays; an empty
    table gives no rows.
    """
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select("row", F.col("row.doc_id").cast("long").alias("doc"), F.unhex(F.md5(F.col("row.text").cast("binary"))).alias("uid"))
    grouped = found.where("class_size > 1").select(F.col("doc_id").alias("found_doc"), F.col("uid").alias("found_uid"), "kept").distinct()
    joined = rows.join(bounded_broadcast(grouped, BROADCAST_KEYS), F.col("doc").eqNullSafe(F.col("found_doc")) & (F.col("uid") == F.col("found_uid")), "left")
    heads = joined.where("kept").dropDuplicates(["doc", "uid"])
    return joined.where("kept is null").unionByName(heads).select("row.*")

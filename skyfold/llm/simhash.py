"""Operator 11: near-duplicates by SimHash, found with a generalised pigeonhole.

A text's fingerprint has 64 bits; a bit is set if it is set in over half of the XXH64 hashes of the text's 3-word
shingles. Fingerprints link at three or fewer differing bits, and components are what links connect.

  1. Equal fingerprints become one vertex.
  2. The bits are grouped into parts, those that are correlated over the corpus together, so that parts are as
     independent of one another as can be.
  3. Each fingerprint gets a threshold for each part, one less than nothing to three bits, so that thresholds plus one
     sum up to four: two fingerprints that differ in three bits differ by no more than the threshold in one part at
     least, whichever of the two the thresholds belong to. A dynamic programme chooses them by the number of
     fingerprints that each ball holds, which the counts of all values of a part tell, so that a value that very many
     share is not probed.
  4. Each fingerprint is filed under its value of each part and probes the values within its thresholds. Where filed
     and probing ones meet, whole fingerprints are compared as arrays, in cells of bounded size, and a cell gives no
     more edges than it has fingerprints. No pair of rows is made by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import bounded_broadcast, columns_of, fits, written
from skyfold.llm.near_dedup import BROADCAST_KEYS, components

#: Differing bits of a link.
DISTANCE = 3
SEED = 42
#: Filed fingerprints of a value that meet as many probing ones at once.
CELL = 1024
#: What a probe costs, in comparisons.
PROBE = 8
#: Bits of a value whose counts are held; wider parts are estimated from pieces as wide.
PIECE = 16
#: Bytes of a text that are cut into words at once.
_PART = 1 << 18

_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)


def fingerprint(text: str | None) -> int:
    """The fingerprint, 0 for a text without words. A text of one or two words is one shingle."""
    data = (text or "").encode().translate(_LOWER)
    counts, n, words, at = np.zeros(64, dtype=np.int64), 0, [], 0
    digest = xxhash.xxh64_digest
    while at < len(data):
        end = data.find(b" ", at + _PART) + 1 or len(data)
        words += data[at:end].split()
        at = end
        if len(words) > 2:
            joined = b" ".join(words)
            ends = list(accumulate(map(len, words), lambda a, b: a + 1 + b))
            begins = [0, *[e + 1 for e in ends[:-1]]]
            counts += _ones(b"".join([digest(joined[a:b], SEED) for a, b in zip(begins, ends[2:], strict=False)]))
            n += len(words) - 2
            words = words[-2:]
    if n == 0 and words:
        counts, n = _ones(digest(b" ".join(words), SEED)), 1
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _ones(digests: bytes) -> np.ndarray:
    """How many of some hashes have each bit set, the highest first."""
    table = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    return np.concatenate([np.bincount(table[:, k], minlength=256) @ _BITS for k in range(8)])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of each document; fp has the fingerprint's bits as a signed number."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch.column("text")), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return columns_of(docs).mapInArrow(rows, "doc_id long, fp long")


def bit_counts(vertices: DataFrame) -> tuple[np.ndarray, int]:
    """(how many fingerprints have each pair of bits set, how many there are). Bit 0 is the lowest."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n = np.zeros((64, 64), dtype=np.int64), 0
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            table += (bits.T @ bits).astype(np.int64)
            n += len(fps)
        if n:
            first, second = np.divmod(np.arange(64 * 64 + 1), 64)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (first, second, np.append(table.ravel(), n))], names=["a", "b", "n"])

    found = vertices.select("fp").mapInArrow(rows, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()  # 4097 numbers
    table, n = np.zeros((64, 64)), 0
    for r in found:
        if r.a == 64:
            n = r.n
        else:
            table[r.a, r.b] = r.n
    return table, n


def grouped_bits(pairs: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """The bits of each part: each begins with the bit that is most correlated with others left, and takes in turn the
    one that is most correlated with those it has."""
    ones = np.diag(pairs)
    spread = np.sqrt(np.maximum(ones * (n - ones), 0))
    both = np.outer(spread, spread)
    linked = np.abs(np.divide(n * pairs - np.outer(ones, ones), both, out=np.zeros_like(both), where=both > 0))
    np.fill_diagonal(linked, 0)
    free, found = list(range(64)), []
    for k in range(parts):
        width = 64 // parts + (k < 64 % parts)
        own = [free.pop(int(linked[np.ix_(free, free)].sum(axis=1).argmax()))]
        while len(own) < width:
            own.append(free.pop(int(linked[np.ix_(free, own)].sum(axis=1).argmax())))
        found.append(sorted(own))
    return found


def values_of(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The number that some bits of each fingerprint make."""
    found = np.zeros(len(fps), dtype=np.uint64)
    for k, bit in enumerate(bits):
        found |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    return found.view(np.int64)


def pieces(bits: list[int]) -> list[list[int]]:
    """A part's bits in pieces of PIECE bits or fewer."""
    n = -(-len(bits) // PIECE)
    return [bits[len(bits) * k // n : len(bits) * (k + 1) // n] for k in range(n)]


def value_counts(vertices: DataFrame, layout: list[list[int]]) -> list[np.ndarray]:
    """How many fingerprints have each value, piece by piece: 65,536 numbers a piece at most."""
    own = [p for bits in layout for p in pieces(bits)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(1 << len(p), dtype=np.int64) for p in own]
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for table, p in zip(counts, own, strict=True):
                table += np.bincount(values_of(fps, p), minlength=len(table))
        for k, table in enumerate(counts):
            (there,) = np.nonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(there), k)), pa.array(there), pa.array(table[there])], names=["piece", "value", "n"])

    counted = vertices.select("fp").mapInArrow(rows, "piece long, value long, n long").groupBy("piece", "value").agg(F.sum("n").alias("n")).toArrow()
    found = [np.zeros(1 << len(p), dtype=np.int64) for p in own]
    piece, value, n = (counted.column(c).to_numpy() for c in ("piece", "value", "n"))
    for k, table in enumerate(found):
        table[value[piece == k]] = n[piece == k]
    return found


def shells(counts: np.ndarray) -> np.ndarray:
    """How many fingerprints have a value at 0, 1, 2 and 3 bits of each, from how many have each value."""
    width = len(counts).bit_length() - 1
    at = np.arange(len(counts))
    near = [counts.astype(np.float64)]
    for k in range(1, DISTANCE + 1):
        beside = sum((near[-1][at ^ (1 << b)] for b in range(width)), np.zeros(len(counts)))
        near.append((beside - ((width - k + 2) * near[-2] if k > 1 else 0)) / k)
    return np.stack(near)


def ball(width: int, radius: int) -> np.ndarray:
    """What a value differs by from those within so many bits of it."""
    return np.array([sum(1 << b for b in some) for k in range(radius + 1) for some in combinations(range(width), k)], dtype=np.int64)


def thresholds(fps: np.ndarray, layout: list[list[int]], near: list[np.ndarray], n: int) -> np.ndarray:
    """The threshold of each part for each fingerprint, -1 for a part that isn't probed.

    near: shells() of each piece. A ball costs the fingerprints that it holds and its probes. Of all choices that sum
    up to what the pigeonhole needs the cheapest is taken, part by part.
    """
    units = DISTANCE + 1
    cost = np.full((units + 1, len(fps)), np.inf)
    cost[0] = 0
    taken, at = [], 0
    for bits in layout:
        held = None
        for p in pieces(bits):
            own = near[at][:, values_of(fps, p)]
            at += 1
            held = own if held is None else np.stack([sum(held[a] * own[t - a] for a in range(t + 1)) / max(n, 1) for t in range(units)])
        probes = np.cumsum([comb(len(bits), t) for t in range(units)])
        price = np.concatenate([np.zeros((1, len(fps))), np.cumsum(held, axis=0) + PROBE * probes[:, None]])
        options = np.stack([np.stack([cost[b - u] + price[u] if u <= b else np.full(len(fps), np.inf) for u in range(units + 1)]) for b in range(units + 1)])
        taken.append(options.argmin(axis=1))
        cost = options.min(axis=1)
    left, found = np.full(len(fps), units), np.zeros((len(layout), len(fps)), dtype=np.int64)
    for k in range(len(layout) - 1, -1, -1):
        used = taken[k][left, np.arange(len(fps))]
        found[k] = used - 1
        left = left - used
    return found


def parts_for(n: int) -> int:
    """How many parts n fingerprints take: so few that a value of a part is shared by a thousand or so at most."""
    return 4 if n < 1 << 26 else 3 if n < 1 << 31 else 2


def filed(vertices: DataFrame, layout: list[list[int]], counts: list[np.ndarray], n: int) -> DataFrame:
    """(part, value, fp, role): where each fingerprint is filed (1), where it probes (2), and where it does both (3)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = [shells(c) for c in counts]
        around = [[ball(len(bits), t)[1:] for t in range(DISTANCE + 1)] for bits in layout]
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                fps = batch.column("fp").slice(low, 2000).to_numpy(zero_copy_only=False).view(np.uint64)
                allowed = thresholds(fps, layout, near, n)
                for k, bits in enumerate(layout):
                    values = values_of(fps, bits)
                    out = [(values, fps, np.where(allowed[k] >= 0, 3, 1))]
                    for t in range(1, DISTANCE + 1):
                        own = allowed[k] == t
                        if own.any():
                            probed = values[own][:, None] ^ around[k][t][None, :]
                            out.append((probed.ravel(), np.repeat(fps[own], probed.shape[1]), np.full(probed.size, 2)))
                    value, fp, role = (np.concatenate(x) for x in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array(value), pa.array(fp.view(np.int64)), pa.array(role.astype(np.int32))], names=["part", "value", "fp", "role"])

    return vertices.select("fp").mapInArrow(rows, "part int, value long, fp long, role int")


def cell_edges(fps: np.ndarray, roles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): each fingerprint of a cell that links connect with others, and the first of those."""
    found, probing = fps[(roles & 1) > 0], fps[(roles & 2) > 0]
    if not len(found) or not len(probing):
        return fps[:0], fps[:0]
    which, other = np.nonzero(np.bitwise_count(probing[:, None] ^ found[None, :]) <= DISTANCE)
    a, b = probing[which], found[other]
    apart = a != b
    if not apart.any():
        return fps[:0], fps[:0]
    vertices, places = np.unique(np.concatenate([a[apart], b[apart]]), return_inverse=True)
    x, y = np.split(places, 2)
    label = np.arange(len(vertices))
    while True:
        least = np.minimum(label[x], label[y])
        after = label.copy()
        np.minimum.at(after, x, least)
        np.minimum.at(after, y, least)
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    hung = label != np.arange(len(vertices))
    return vertices[hung], vertices[label[hung]]


def _cells(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(fingerprints, roles) of each key in turn, where the rows of a key run together: keys, then fp and role."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        changed = np.zeros(len(columns[0]) - 1, dtype=bool)
        for c in columns[:keys]:
            changed |= c[1:] != c[:-1]
        starts = np.concatenate([[0], np.flatnonzero(changed) + 1])
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            yield columns[keys][a:b].view(np.uint64), columns[keys + 1][a:b]
        held = [c[starts[-1] :] for c in columns]
    if held is not None:
        yield held[keys].view(np.uint64), held[keys + 1]


def edges(rows: DataFrame) -> DataFrame:
    """(a, b) of fingerprints that links connect. rows: filed()."""
    files, probes = (F.col("role").bitwiseAND(F.lit(bit)) > 0 for bit in (1, 2))
    sizes = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"), F.sum(files.cast("long")).alias("n_filed"), F.sum(probes.cast("long")).alias("n_probing"))
    sizes = sizes.where("n > 1 and n_filed > 0 and n_probing > 0").drop("n")
    met = rows.join(sizes, ["part", "value"])
    high, wide = F.ceil(F.col("n_filed") / CELL), F.ceil(F.col("n_probing") / CELL)
    own = F.xxhash64("fp")
    one = met.where((high == 1) & (wide == 1)).select("part", "value", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"), "fp", "role")
    large = met.where((high > 1) | (wide > 1))
    down = large.where(files).select("part", "value", F.pmod(own, high).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), wide - 1)).alias("j"), "fp", F.lit(1).alias("role"))
    across = large.where(probes).select("part", "value", F.explode(F.sequence(F.lit(0).cast("long"), high - 1)).alias("i"), F.pmod(own, wide).alias("j"), "fp", F.lit(2).alias("role"))
    keys = ["part", "value", "i", "j"]

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps, roles in _cells((b for b in batches if b.num_rows), len(keys)):
            if len(fps) > 1:
                a, b = cell_edges(fps, roles)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = one.unionByName(down).unionByName(across).repartition(n, *keys).sortWithinPartitions(*keys)
    return cells.mapInArrow(linked, "a long, b long")


def near_duplicates(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """One row a document: doc_id, fingerprint (16 hex digits) and component_id, the least doc_id of its component.

    Null, empty and wordless texts have fingerprint 0, which links like any other. Documents of null doc_id count as
    rows but give no component its name unless it has no others. Repeated rows are in one component; an empty table
    gives no rows; other columns are not looked at. parts: how many parts the bits are grouped into, 1 to 4.
    """
    found = written(fingerprints(docs), "fingerprints")
    vertices = written(found.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "vertices")
    pairs, n = bit_counts(vertices)
    layout = grouped_bits(pairs, n, parts or parts_for(n))
    rows = written(filed(vertices, layout, value_counts(vertices, layout), n), "filed")
    comps = written(components(edges(rows)), "components").withColumnRenamed("uid", "fp")
    named = vertices.join(bounded_broadcast(comps, BROADCAST_KEYS), "fp", "left").where("n > 1 or comp is not null")
    named = written(named.select("fp", F.coalesce("comp", "fp").alias("comp"), "least"), "named")
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    table = written(named.join(bounded_broadcast(least, BROADCAST_KEYS), "comp").select("fp", "component_id"), "classes")
    small = fits(table, BROADCAST_KEYS)
    joined = found.join(F.broadcast(table) if small else table, "fp", "left")
    own = F.when(F.col("component_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), own.alias("component_id"))

"""Operator 12: a Merkle manifest of a dataset, in a node store on disk.

Each row is a leaf; each language's leaves, by doc_id, make a tree in which every 8 nodes running have one above them,
and the languages' roots, by language, make another such tree. A digest is the lowercase hex of a SHA-256 over its
inputs one after another, digests as their hex text.

  1. Leaves are hashed where the rows are read; texts go no further. Range partitions of them are sorted runs on disk,
     and a place in its tree is a leaf's place in its run plus the lengths of the runs before.
  2. Each level is a Parquet table, `level=k` of the store. It comes from reading the one below once, in its order: a
     task hashes the groups of eight as they pass, and hands on only those that its part of the file cuts, a few a file,
     which are put together by their place.
  3. Proofs come from a merge of the levels by coordinate. Trees are cut into blocks of 512 leaves. A task passes
     through a block's nodes from the top, then its leaves, with one block's digests in memory; what a proof has above
     its block is one string, the same for the whole block.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold.llm.common import bounded_broadcast, scratch_dir, written

FAN = 8
#: Levels below the top of a block: it has FAN ** BLOCK leaves.
BLOCK = 3
#: Hex digits of a digest.
HEX = 64
#: Broadcast at most so many starts of runs.
BROADCAST_RUNS = 100_000

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(**changed: Column) -> Column:
    """The digest of a row, with some columns' values changed."""
    return F.sha2(F.concat(*[_field(changed.get(c, F.col(c))) for c in COLUMNS]), 256)


def tampered(doc_id: Column) -> Column:
    """Whether a row's text is tampered with: where 3 divides the CRC-32 of its doc_id in decimal."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, digest, shown) of each row; shown is what the tampered row hashes to, null where none is."""
    lowered = F.translate("text", _UPPER, _LOWER)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c) for c in COLUMNS[1:]])
    return own.select("doc_id", F.col("lang").cast("string").alias("lang"), leaf_of().alias("digest"), F.when(tampered(F.col("doc_id")), leaf_of(text=lowered)).alias("shown"))


def placed(rows: DataFrame, tree: str | None, order: list[str]) -> DataFrame:
    """rows with pos, their place from 0 in their tree, and n, the tree's rows, in runs sorted by tree and order.

    Nulls come first. Rows that are equal in all of these are split between partitions like others.
    """
    spark = rows.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in ([tree] if tree else []) + order]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    runs = written(dealt.withColumn("_at", F.monotonically_increasing_id()), "runs").withColumn("_run", F.shiftright("_at", 33))
    tree_of = F.col(tree) if tree else F.lit(0)
    begun = runs.groupBy("_run", tree_of.alias("_tree")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_tree")
    before = whole.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select(F.col("_run").alias("_r"), "_tree", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_base"), "_first", F.sum("_n").over(whole).cast("long").alias("n"))
    found = runs.join(bounded_broadcast(begun, BROADCAST_RUNS), (F.col("_run") == F.col("_r")) & tree_of.eqNullSafe(F.col("_tree")))
    return found.select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_base")).alias("pos"), "n")


def digest_of(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes above those of (tree, pos, n, digest), which come in runs. Of a group that isn't whole the digests there
    are, as `part`, and the place of the first."""
    held: tuple[int, int, int, int, bytes] | None = None  # tree, node above, nodes of the level, first place, digests

    def out(groups: list) -> pa.RecordBatch:
        rows = []
        for tree, up, n, first, own in groups:
            whole = first == 0 and len(own) // HEX == min(FAN, n - FAN * up)
            rows.append((tree, up, -(-n // FAN), digest_of(own) if whole else None, first, None if whole else own.decode()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["tree", "pos", "n", "digest", "first", "part"])

    for batch in batches:
        if not batch.num_rows:
            continue
        tree, pos, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "pos", "n"))
        data = "".join(batch.column("digest").to_pylist()).encode()
        cut = (tree[1:] != tree[:-1]) | (pos[1:] != pos[:-1] + 1) | (pos[1:] % FAN == 0)
        starts = [0, *(np.flatnonzero(cut) + 1).tolist(), len(pos)]
        groups = []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            own = (int(tree[a]), int(pos[a]) // FAN, int(n[a]), int(pos[a]) % FAN, data[HEX * a : HEX * b])
            if held is not None and held[:2] == own[:2] and held[3] + len(held[4]) // HEX == own[3]:
                held = (*held[:4], held[4] + own[4])
            else:
                if held is not None:
                    groups.append(held)
                held = own
        if groups:
            yield out(groups)
    if held is not None:
        yield out([held])


_NODE = "tree long, pos long, n long, digest string"


def level_above(nodes: DataFrame) -> DataFrame:
    """The level above (tree, pos, n, digest); trees of one node have none."""
    found = written(nodes.where("n > 1").select("tree", "pos", "n", "digest").mapInArrow(parents, f"{_NODE}, first int, part string"), "passed")
    pieces = found.where("digest is null").groupBy("tree", "pos", "n").agg(F.array_sort(F.collect_list(F.struct("first", "part"))).alias("_p"))  # 8 at most
    joined = pieces.select("tree", "pos", "n", F.sha2(F.array_join(F.col("_p.part"), ""), 256).alias("digest"))
    return found.where("digest is not null").select("tree", "pos", "n", "digest").unionByName(joined)


class Store:
    """The levels of some trees as Parquet tables of a folder, `level=0` upwards."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.levels = spark, folder, []

    def add(self, nodes: DataFrame) -> DataFrame:
        path = f"{self.folder}/level={len(self.levels)}"
        nodes.write.parquet(path)
        self.levels.append(self.spark.read.schema(nodes.schema).parquet(path))
        return self.levels[-1]

    def grow(self, nodes: DataFrame) -> Store:
        """Adds nodes, which have tree, pos, n and digest besides others, and all levels above them."""
        size = self.add(nodes).agg(F.max("n").alias("n")).head().n or 1
        while size > 1:
            self.add(level_above(self.levels[-1]))
            size = -(-size // FAN)
        return self

    def roots(self) -> DataFrame:
        """(tree, digest) of each tree's root."""
        found = self.levels[0].where("n = 1").select("tree", "digest")
        for level in self.levels[1:]:
            found = found.unionByName(level.where("n = 1").select("tree", "digest"))
        return found


def tails(store: Store, stop: int, above: DataFrame | None = None) -> DataFrame:
    """(tree, pos, n, level, tail) of the nodes at level `stop`, and of the roots of lower trees: all that a proof has
    above them, left to right. above: tree and tail of the roots; none for a tree that is all there is."""
    found, low = None, None
    for k in range(len(store.levels) - 1, -1, -1):
        nodes = store.levels[k].select("tree", "pos", "n", "digest")
        tops = nodes.where("n = 1").select("tree", "pos", "n", F.lit(k).alias("level"))
        tops = tops.withColumn("tail", F.lit("")) if above is None else tops.join(above, "tree")
        if k < stop:  # trees that end below
            low = tops if low is None else low.unionByName(tops)
            continue
        if found is not None:
            runs = nodes.where("n > 1").groupBy("tree", F.expr(f"pos div {FAN}").alias("up"), "n").agg(F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("run"))
            each = runs.join(found.select("tree", F.col("pos").alias("up"), F.col("tail").alias("_t")), ["tree", "up"]).select("tree", "n", "run", "_t", F.explode("run.pos").alias("pos"))
            others = F.array_join(F.transform(F.filter("run", lambda x: x["pos"] != F.col("pos")), lambda x: x["digest"]), "")
            tops = tops.unionByName(each.select("tree", "pos", "n", F.lit(k).alias("level"), F.concat(others, "_t").alias("tail")))
        found = tops
    return found if low is None else low if found is None else found.unionByName(low)


def steps(pos: int, n: int) -> list[tuple[int, int]]:
    """Up a tree from a node: (its place in its run, the run's nodes), level by level."""
    found = []
    while n > 1:
        found.append((pos % FAN, min(FAN, n - pos // FAN * FAN)))
        pos, n = pos // FAN, -(-n // FAN)
    return found


def folded(digest: bytes, sides: list[tuple[bytes, bytes]]) -> bytes:
    """The root over a digest, from what stands left and right of it level by level."""
    for left, right in sides:
        digest = digest_of(left + digest + right).encode()
    return digest


class _Block:
    """What the proofs of a block's leaves need: its nodes below its top, and all that stands above it."""

    def __init__(self, level: int, block: int, n: int, tail: str, subroot: str, tree: int, n_trees: int):
        self.level, self.first, self.tail, self.subroot = level, block, tail.encode(), subroot
        self.nodes = {k: bytearray() for k in range(1, level)}
        self.above, at = [], 0
        for place, run in [*steps(block, n), *steps(tree, n_trees)]:
            middle, end = at + HEX * place, at + HEX * (run - 1)
            self.above.append((self.tail[at:middle], self.tail[middle:end]))
            at = end

    def inside(self, leaf: int) -> list[tuple[bytes, bytes]]:
        """What stands beside the nodes above a leaf, from the lowest up to the block's top."""
        found, pos = [], leaf
        for k in range(1, self.level):
            pos //= FAN
            own, at = self.nodes[k], pos - self.first * FAN ** (self.level - k)
            low = at // FAN * FAN
            found.append((bytes(own[HEX * low : HEX * at]), bytes(own[HEX * (at + 1) : HEX * (low + FAN)])))
        return found

    def proofs(self, run: list[tuple], root: str) -> list[tuple]:
        """Of the leaves of one run: (pos, digest, doc_id, shown) each."""
        upper = self.inside(run[0][0])
        shared = b"".join(a + b for a, b in upper) + self.tail
        own = "".join(r[1] for r in run).encode()
        out = []
        for k, (_, digest, doc, shown) in enumerate(run):
            beside = [(own[: HEX * k], own[HEX * (k + 1) :])] if self.level else []
            end = folded((shown or digest).encode(), [*beside, *upper, *self.above]).decode()
            out.append((doc, digest, self.subroot, root, digest_of(b"".join(a + b for a, b in beside) + shared), end, end == root))
        return out


#: The level that the row of a block's tail has, so that it comes first.
_TAIL = 99
_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def merge_scan(root: str, n_trees: int):
    """The proofs from rows of (tree, block, level, pos, n, digest, tail, doc_id, shown), a block's together, its levels
    downwards. The row of the tail has the block's level as pos, the nodes of that level as n, the subroot as digest."""
    names = [c.split()[0] for c in _PROOF.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[c.split()[1]] for c in _PROOF.split(", ")]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, run, out = None, [], []
        for batch in batches:
            for tree, block, level, pos, n, digest, tail, doc, shown in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if run and (level or pos // FAN != run[0][0] // FAN):
                    out += now.proofs(run, root)
                    run = []
                if level == _TAIL:
                    now = _Block(pos, block, n, tail, digest, tree, n_trees)
                elif level:
                    now.nodes[level] += digest.encode()
                else:
                    run.append((pos, digest, doc, shown))
            if out:
                yield batch_of(out)
                out = []
        if run:
            yield batch_of(now.proofs(run, root))

    return extract


def manifest(docs: DataFrame) -> tuple[Store, Store]:
    """The node stores of the languages' trees and of the tree over their roots.

    Level 0 of the first has doc_id, lang and shown besides tree, pos, n and digest, that of the second lang.
    """
    spark = docs.sparkSession
    folder = f"{scratch_dir(spark)}/merkle-{uuid.uuid4().hex}"
    own = written(leaves(docs), "leaves")
    langs = placed(own.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).drop("_n"), None, ["lang"])
    langs = written(langs.select(F.col("lang").alias("_lang"), F.col("pos").alias("tree"), F.col("n").alias("n_trees")), "langs")
    found = placed(own, "lang", ["doc_id", "digest"])
    named = found.join(bounded_broadcast(langs.drop("n_trees"), BROADCAST_RUNS), F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang")
    trees = Store(spark, f"{folder}/rows").grow(named)
    roots = trees.roots().join(langs, "tree").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("n_trees").alias("n"), "digest", F.col("_lang").alias("lang"))
    return trees, Store(spark, f"{folder}/langs").grow(roots)


def prove(trees: Store, tops: Store) -> DataFrame:
    """One row a leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified."""
    spark = trees.spark
    end = tops.roots().head()
    if end is None:
        return spark.createDataFrame([], _PROOF)
    n_trees = tops.levels[0].head().n
    over = tails(tops, 0).select(F.col("pos").alias("tree"), "tail")
    subroots = tops.levels[0].select(F.col("pos").alias("tree"), "digest")
    blocks = tails(trees, BLOCK, over).join(bounded_broadcast(subroots, BROADCAST_RUNS), "tree")
    none = {"tail": F.lit(None).cast("string"), "doc_id": F.lit(None).cast("long"), "shown": F.lit(None).cast("string")}
    rows = blocks.select("tree", F.col("pos").alias("block"), F.lit(_TAIL).alias("level"), F.col("level").cast("long").alias("pos"), "n", "digest", "tail", none["doc_id"].alias("doc_id"), none["shown"].alias("shown"))
    for k, nodes in enumerate(trees.levels[:BLOCK]):
        kept = {"doc_id": F.col("doc_id"), "shown": F.col("shown")} if k == 0 else none
        block = F.expr(f"pos div {FAN ** (BLOCK - k)}")
        # the root of a tree is no node below a block's top, unless it is a lone leaf
        below = nodes if k == 0 else nodes.where("n > 1")
        rows = rows.unionByName(below.select("tree", block.alias("block"), F.lit(k).alias("level"), "pos", "n", "digest", none["tail"].alias("tail"), kept["doc_id"].alias("doc_id"), kept["shown"].alias("shown")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "tree", "block").sortWithinPartitions("tree", "block", F.col("level").desc(), "pos")
    return dealt.mapInArrow(merge_scan(end.digest, n_trees), _PROOF)


def merkle_proofs(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    docs has doc_id, source, lang, n_chars and text; nulls are leaves' `-`, other columns are not looked at. Rows of one
    doc_id and language, nulls first, stand in the order of their digests; equal rows each have a leaf and a proof of
    their own. A null doc_id is never tampered with. An empty table gives no rows.
    """
    return prove(*manifest(docs))

"""What the training-data operators share: scratch tables, row keys, prefix sums."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a temporary one only where none is set and all runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="skyfold-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """df written as a Parquet table in the shared folder and read back: the lineage ends there.

    Every executor sees the table, so a lost executor costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Removes a table of the shared folder that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Tables:
    """Tables of the shared folder that go by name once what reads them has been written itself."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.names = spark, {}, {}

    def written(self, df: DataFrame, label: str) -> DataFrame:
        """df written and read back as written() does, and known by its label from here on."""
        path = f"{scratch_dir(self.spark)}/{label}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.paths.setdefault(label, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, label: str, key: str) -> DataFrame:
        """df written in buckets of a key, one a shuffle partition: joins on the key don't shuffle it again."""
        name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
        path = f"{scratch_dir(self.spark)}/{name}"
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.format("parquet").option("path", path).bucketBy(n, key).sortBy(key).saveAsTable(name)
        self.paths.setdefault(label, []).append(path)
        self.names[path] = name
        return self.spark.table(name)

    def drop(self, *labels: str) -> None:
        """Removes the tables of these labels."""
        for label in labels:
            for path in self.paths.pop(label, []):
                if path in self.names:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop(path)}")
                removed(self.spark, path)


#: Bytes of an Arrow batch that goes to a Python worker.
ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches in bytes where the session doesn't: a batch of 10,000 long texts would be any size."""
    if ARROW_BATCH not in spark.conf.getAll:
        spark.conf.set(ARROW_BATCH, "3m")


def columns_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id long and text string alone, so that no other column can clash with those an operator adds."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def text_key() -> Column:
    """128 bits of a text: rows with the same doc_id and key are the same row repeated, whatever the id means."""
    return F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), F.col("text")).alias("b"))


def ranged(docs: DataFrame, *extra: str) -> DataFrame:
    """Rows in ascending doc_id order over range partitions; nulls first.

    Ties go by a hash of the text, so that a doc_id on very many rows is still split between partitions.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.withColumn("tie", F.xxhash64("text"))
    return keyed.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text", *extra)


def bases(totals: DataFrame, part: str, size: str, base: str) -> DataFrame:
    """The sum of `size` over all earlier parts, one row a part. There are as many rows as partitions, not as data."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = totals.groupBy(part).agg(F.sum(size).alias("_size"))
    return sums.select(part, F.coalesce(F.sum("_size").over(before), F.lit(0)).cast("long").alias(base))


#: What a broadcast table may have in bytes, besides the row bound that its caller gives.
BROADCAST_BYTES = 32_000_000


def fits(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows and BROADCAST_BYTES: counted on the executors, nothing is gathered."""
    fixed = sum(kind not in ("string", "binary") and "<" not in kind for _, kind in df.dtypes)
    size = F.lit(8 * fixed + 16)
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
        elif "<" in kind:
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(name)))), F.lit(0))
    found = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("size")).head()
    return found.n <= rows and found.size <= BROADCAST_BYTES


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows and bytes; else as it is, for a shuffled join."""
    return F.broadcast(df) if fits(df, rows) else df


#: Bytes of UTF-8 to words: A-Z lower-cased, white space for all of ASCII but digits and letters.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


#: Bytes of text whose words are hashed at once: arrays of numbers are bounded by it, not by the text.
_PART = 1 << 16
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_UP = np.cumprod(np.full(_PART, _BASE))
_DOWN = np.cumprod(np.full(_PART, np.uint64(pow(int(_BASE), -1, 1 << 64))))


def _hashed(data: np.ndarray) -> np.ndarray:
    """64 bits of each word: the sum of its bytes times powers of a base, from running sums over the data."""
    space = data == 32
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[: len(data)])])
    h = (sums[ends] - sums[begins]) * _DOWN[begins] * _MIX
    return h ^ (h >> np.uint64(31))


def hashed_words(data: bytes) -> np.ndarray:
    """64 bits of each word of data, in which words are what spaces separate."""
    found, at = [np.zeros(0, np.uint64)], 0
    while at < len(data):
        end = len(data) if at + _PART > len(data) else data.rfind(b" ", at, at + _PART) + 1
        if end > at:
            found.append(_hashed(np.frombuffer(data, np.uint8, end - at, at)))
        else:  # a word longer than a part
            end = data.find(b" ", at + _PART) + 1 or len(data)
            word = hashlib.blake2b(data[at:end].rstrip(b" "), digest_size=8).digest()
            found.append(np.frombuffer(word, "<u8").astype(np.uint64))
        at = end
    return np.concatenate(found) if len(found) != 2 else found[1]

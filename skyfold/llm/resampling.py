"""Operator 3: importance resampling with hashed n-gram models.

Two generative models are bags of hashed word 1- and 2-grams: one of a target text, one of all raw text. A
document's log importance is the sum over its n-grams of log(target share / raw share). Adding a Gumbel variate
to each and keeping the k largest samples k documents without replacement, in proportion to importance. The
variate is drawn from a hash of the document, so runs repeat.

Buckets are counted in each task and added up on the executors; a model is `buckets` numbers, whatever the
input. The k-th largest key is found from range partitions and their sizes, not by gathering rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import TO_WORDS, bases, columns_of, hashed_words, text_key, written

_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def buckets_of(text: bytes, buckets: int) -> np.ndarray:
    """The bucket of each word 1-gram and 2-gram of a text in UTF-8, A-Z lower-cased."""
    word = hashed_words(text.translate(TO_WORDS))
    grams = np.concatenate([word, word[:-1] * np.uint64(_BASE) + word[1:] + np.uint64(1)]) * np.uint64(_MIX)
    return ((grams >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, buckets: int) -> np.ndarray:
    """How many n-grams of all the documents fall in each bucket. Only `buckets` sums come to the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                if text := (batch.column("text")[k].as_py() or "").encode():
                    total += np.bincount(buckets_of(text, buckets), minlength=buckets)
        own = np.flatnonzero(total)
        if len(own):
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["bucket", "n"])

    sums = columns_of(docs).select("text").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = np.zeros(buckets, dtype=np.float64)
    for r in sums.collect():
        found[r.bucket] = r.n
    return found


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float) -> np.ndarray:
    """log(target share / raw share) of each bucket, with `smoothing` added to every count."""
    return np.log((target + smoothing) / (target + smoothing).sum()) - np.log((raw + smoothing) / (raw + smoothing).sum())


def resample(docs: DataFrame, target: DataFrame, share: float, buckets: int = 10_000, smoothing: float = 1.0, seed: int = 1) -> DataFrame:
    """One row a document: doc_id, log_weight, gumbel_key, rank (1 for the largest key) and kept, for the
    round(share * documents) largest keys.

    target: a column text. log_weight is over the n-grams of the whole text; a null or empty one has none and 0.
    Equal keys, as of repeated rows, go by doc_id, nulls first. An empty target makes all weights alike up to
    smoothing; an empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    weights = spark.sparkContext.broadcast(log_ratio(bucket_counts(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets), bucket_counts(docs, buckets), smoothing))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            found = [float(w[buckets_of((x.as_py() or "").encode(), buckets)].sum()) for x in batch.column("text")]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("draw"), pa.array(found)], names=["doc_id", "draw", "log_weight"])

    # a uniform variate in (0, 1) from 52 bits of a hash of id and text
    key = text_key()
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", key), 12).cast("double") + 0.5) / float(1 << 52)
    scored = columns_of(docs).withColumn("draw", -F.log(-F.log(uniform))).mapInArrow(weighed, "doc_id long, draw double, log_weight double")
    scored = scored.withColumn("gumbel_key", F.col("log_weight") + F.col("draw"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("gumbel_key").desc(), F.col("doc_id").asc_nulls_first()]
    placed = written(scored, "scores").repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = written(placed.select("doc_id", "log_weight", "gumbel_key", F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row")), "ranks")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = written(bases(sizes, "_part", "_n", "_before"), "before")
    k = round(share * placed.count())
    ranked = placed.join(F.broadcast(before), "_part").withColumn("rank", F.col("_before") + F.col("_row") + 1)
    return ranked.select("doc_id", "log_weight", "gumbel_key", "rank", (F.col("rank") <= k).alias("kept"))

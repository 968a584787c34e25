"""Documents to packed training sequences, in five stages, each written as Parquet and read back by the next.

Every stage works on all that its predecessor kept, and its decisions take effect: rejected documents go, one of
each group of near-duplicates stays, contaminated documents go, personal data and what discloses it is
generalised in the text, and what is left is packed. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm import decontamination, near_dedup, packing, pii, quality
from skyfold.llm.common import written
from skyfold.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the trained model reject go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.filter_kept(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the least doc_id."""
    return near_dedup.keep_one(docs, written(near_dedup.near_duplicates(docs), "classes"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more stand in benchmark windows go."""
    found = decontamination.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontamination.keep_clean(docs, written(found, "judged"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are generalised; every document stays, n_chars follows its text."""
    clean = pii.sanitise(docs, written(pii.find_pii(docs), "pii"))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else clean


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece of a document, with its ids, in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, vocabulary(), budget=2048, end_id=1, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("personal data", personal_data),
    ("packing", sequence_packing),
]

#: Training, sketches and token ids are beyond SQL; tests/llm/test_pipeline.py holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

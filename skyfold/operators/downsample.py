"""Time blocks in which the last arrival wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.functions.timeunits import floor_to


def last_of_block(records: DataFrame, key: str, ts: str, block: int, order: list[str]) -> DataFrame:
    """One row a key and block: the whole record that arrived last, its time moved to the block's start."""
    others = [c for c in records.columns if c not in (key, ts)]
    latest = F.max_by(F.struct(*others), F.struct(*order)) if len(order) > 1 else F.max_by(F.struct(*others), F.col(order[0]))
    found = records.groupBy(key, floor_to(F.col(ts), block).alias("_block")).agg(latest.alias("_r"))
    return found.select(key, F.col("_block").alias(ts), *[F.col(f"_r.{c}").alias(c) for c in others])


def ended(block_start: Column, block: int, watermark: Column) -> Column:
    """Whether a block is over at a watermark: its end is reached, the bound included."""
    return block_start + block <= watermark


def latest_per_key(df: DataFrame, key: str, by: list[Column]) -> DataFrame:
    """The whole latest row of each key by descending `by`, nulls in other columns and all."""
    from pyspark.sql.window import Window

    rank = F.row_number().over(Window.partitionBy(key).orderBy(*by))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def restore(table: DataFrame, start: Column, end: Column) -> DataFrame:
    """Confirmed metadata before a run: icao, seed_call_sign and seed_squawk of each aircraft's latest row in
    [start, end). Codes that aren't hex digits are left out; the latest row counts even where it has nulls."""
    from skyfold.functions.geo import icao_number

    own = table.where((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    last = latest_per_key(own, "mode_s_code", [F.col("timestamp").desc()])
    return last.withColumn("icao", icao_number(F.col("mode_s_code"))).where("icao is not null").select(F.col("icao").cast("int").alias("icao"), F.col("call_sign").alias("seed_call_sign"), F.col("squawk").alias("seed_squawk"))

"""The output table: Parquet by minute, upserted by key or replaced by minute."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold import fs
from skyfold.functions.geo import icao_hex
from skyfold.functions.timeunits import PER_MINUTE, minute_key, of_timestamp, to_timestamp
from skyfold.scratch import cut

KEY = ("mode_s_code", "timestamp")


def rendered(records: DataFrame) -> DataFrame:
    """Output rows of records with icao and a block-aligned ts_100ns."""
    return records.select(to_timestamp(F.col("ts_100ns")).alias("timestamp"), icao_hex(F.col("icao")).alias("mode_s_code"), "lat", "lon", "alt", "call_sign", "squawk", "on_ground")


def minute_of(at: Column) -> Column:
    return minute_key(of_timestamp(at))


def in_range(records: DataFrame, start: int, end: int, ts: str = "ts_100ns") -> DataFrame:
    """Records of [start, end)."""
    return records.where((F.col(ts) >= start) & (F.col(ts) < end))


def merged(old: DataFrame, new: DataFrame, key: Iterable[str] = KEY, order: Column | None = None) -> DataFrame:
    """old and new rows, one a key: the new one where there is one, with its nulls too. order ranks new rows that
    share a key, the greatest last."""
    columns = old.columns
    both = old.select(*columns, F.lit(0).alias("_new"), F.lit(None).cast("long").alias("_o")).unionByName(new.select(*columns, F.lit(1).alias("_new"), (F.lit(0) if order is None else order).cast("long").alias("_o")))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("_new").desc(), F.col("_o").desc()))
    return both.withColumn("_rank", rank).where("_rank = 1").select(*columns)


def replaced(old: DataFrame, new: DataFrame, minutes: tuple[int, int], minute: Column) -> DataFrame:
    """old without the Unix minutes [first, end), and new: minutes that new has nothing for end up empty."""
    return old.where((minute < minutes[0]) | (minute >= minutes[1])).unionByName(new.select(*old.columns))


#: Columns without nulls.
REQUIRED = ("timestamp", "mode_s_code", "on_ground")


def checked(rows: DataFrame) -> DataFrame:
    """rows of the table, with their minute, which fail the job that writes them if a required value is null or a key
    comes twice. They are dealt out by minute and sorted by key, as they are written."""
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])
    keyed = rows.repartition("minute").withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("minute", *KEY)))
    fault = F.when(missing != "", F.concat(F.lit("null in "), missing)).when(F.col("_n") > 1, F.concat(F.lit("key twice: "), F.concat_ws(" ", *KEY)))
    return keyed.withColumn("mode_s_code", F.when(fault.isNull(), F.col("mode_s_code")).otherwise(F.raise_error(fault))).drop("_n").sortWithinPartitions("minute", *KEY)


def _write(rows: DataFrame, path: str) -> None:
    """Staged files, moved in when all tasks have ended well: a job that fails leaves the table as it was."""
    checked(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("minute").parquet(path)


def replace_minutes(rows: DataFrame, path: str, first: int, end: int) -> None:
    """Writes rows of Unix minutes [first, end) in place of what those minutes hold.

    Minutes with new rows come first; those of the range that have none, which dynamic overwrite leaves alone, are then
    removed by one look at the table's folder. A job that fails before has changed nothing, and running twice gives the
    same table. Each minute is moved in by itself: this is no transaction over several minutes.
    """
    spark = rows.sparkSession
    placed = rows.withColumn("minute", minute_of(F.col("timestamp")))
    own = placed.where(((F.col("minute") >= first) & (F.col("minute") < end)) | F.col("minute").isNull()).persist()
    filled = {r.minute for r in own.select("minute").distinct().collect()}  # at most the minutes of the run
    _write(own, path)
    there = (n.removeprefix("minute=") for n in fs.names(spark, path) if n.startswith("minute="))
    for m in sorted(int(n) for n in there if n.isdigit()):
        if first <= m < end and m not in filled:
            fs.remove(spark, f"{path}/minute={m}")
    own.unpersist()


def upsert(rows: DataFrame, path: str, order: str | None = None) -> None:
    """Merges rows into the table: only the minutes that rows touch are read and written again."""
    spark = rows.sparkSession
    placed = rows.withColumn("minute", minute_of(F.col("timestamp"))).persist()
    touched = [r.minute for r in placed.select("minute").distinct().collect()]  # a batch's minutes
    plain = placed.drop(order) if order else placed
    if touched and fs.exists(spark, path):
        old = spark.read.schema(plain.schema).parquet(path).where(F.col("minute").isin(touched))
    else:
        old = plain.limit(0)
    best = merged(old, placed, order=F.col(order) if order else None)
    _write(cut(best) if touched else best, path)  # read before its partitions are written over
    placed.unpersist()


def with_retries(write: Callable[[], None], attempts: int = 3, pause_s: float = 0.5) -> None:
    """Runs write again if it fails; the last failure is raised, so that a batch is never lost unseen."""
    for k in range(attempts):
        try:
            return write()
        except Exception:
            if k == attempts - 1:
                raise
            time.sleep(pause_s)


def ready_minutes(records: DataFrame, confirmed: int, start: int) -> DataFrame:
    """Records of minutes from `start` on that are over at the confirmed time, so that nothing can join them."""
    end = (F.col("ts_100ns") - F.pmod("ts_100ns", F.lit(PER_MINUTE))) + PER_MINUTE
    return records.where((F.col("ts_100ns") >= start) & (end <= confirmed))

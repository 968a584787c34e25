"""The as-of join: to each row the latest row of another table at or before its time.

Both tables are cut into buckets of time. Each bucket's last row of the other table is carried into the buckets after
it, on one row a key and bucket, and the buckets are merged by themselves. So a key is the work of as many tasks as it
has buckets, however many of the rows it has, and no row meets more than one other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold.functions.timeunits import floor_to


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, bucket: int, within: int | None = None, strict: bool = False, ties: list[str] | None = None, out: str = "other") -> DataFrame:
    """left with `out`: the row of right, as a struct, that has the same `by` and the latest `on` not after left's; null
    if there is none.

    by, on: columns of both tables; on holds whole numbers. bucket: the span that a task merges. within: how far back
    a row may be, the bound included. strict: rows at the same time don't count. ties: columns of right; of rows at one
    time the greatest by them is taken. Rows with a null in by or on meet none; all rows of left stay, with all columns.
    """
    own = left.select(F.struct("*").alias("_l"))
    sides = [F.struct(*[F.col(f"_l.{c}") for c in by]).alias("_k"), F.col(f"_l.{on}").cast("long").alias("_t")]
    none = F.lit(None).cast(right.select(F.struct("*").alias("r")).schema["r"].dataType)
    rows = own.select(*sides, "_l", none.alias("_r"), F.lit(0 if strict else 1).alias("_side"))
    known = F.lit(True)
    for c in by:
        known = known & F.col(f"_k.{c}").isNotNull()
    matched = rows.where(known & F.col("_t").isNotNull())
    alone = rows.where(~(known & F.col("_t").isNotNull()))
    others = right.select(F.struct("*").alias("_r"))
    others = others.select(F.struct(*[F.col(f"_r.{c}") for c in by]).alias("_k"), F.col(f"_r.{on}").cast("long").alias("_t"), F.lit(None).cast(own.schema["_l"].dataType).alias("_l"), "_r", F.lit(1 if strict else 0).alias("_side"))
    others = others.where(known & F.col("_t").isNotNull())
    rank = F.struct("_t", *[F.col(f"_r.{c}").alias(f"_tie{k}") for k, c in enumerate(ties or [])])
    both = matched.unionByName(others).withColumn("_b", floor_to(F.col("_t"), bucket)).withColumn("_rank", F.struct("_t", "_side", *[F.col(f"_r.{c}").alias(f"_tie{k}") for k, c in enumerate(ties or [])]))
    # one row a key and bucket: its last row of the other table, and the last one before it
    last = both.groupBy("_k", "_b").agg(F.max_by("_r", F.when(F.col("_r").isNotNull(), rank)).alias("_last"))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    into = last.select("_k", "_b", F.last("_last", ignorenulls=True).over(before).alias("_in"))
    inside = Window.partitionBy("_k", "_b").orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = both.withColumn("_o", F.last("_r", ignorenulls=True).over(inside)).where(F.col("_l").isNotNull()).join(into, ["_k", "_b"])
    met = F.coalesce("_o", "_in")
    if within is not None:
        met = F.when(F.col("_t") - met[on].cast("long") <= within, met)
    found = merged.select("_l", met.alias(out)).unionByName(alone.select("_l", none.alias(out)))
    return found.select("_l.*", out)

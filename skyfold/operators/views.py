"""Queries over the output table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold.functions.geo import label, thousandths, web_mercator

COLUMNS = ("timestamp", "mode_s_code", "lat", "lon", "alt", "call_sign", "squawk", "on_ground")


def predicates(start: datetime | Column | None = None, end: datetime | Column | None = None, codes: list[str] | None = None, call_signs: list[str] | None = None, on_ground: bool | None = None) -> Column:
    """A position, and whatever else is given; a parameter that isn't given filters nothing."""
    found = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    if start is not None:
        found &= F.col("timestamp") >= F.lit(start)
    if end is not None:
        found &= F.col("timestamp") < F.lit(end)
    if codes is not None:
        found &= F.col("mode_s_code").isin(*codes)
    if call_signs is not None:
        found &= F.col("call_sign").isin(*call_signs)
    if on_ground is not None:
        found &= F.col("on_ground") == F.lit(on_ground)
    return found


def select_points(table: DataFrame, limit: int | None = None, **filters) -> DataFrame:
    """The eight columns of rows that pass the filters, by code and time; the first `limit` of them if given."""
    found = table.where(predicates(**filters)).select(*COLUMNS).orderBy("mode_s_code", "timestamp")
    return found if limit is None else found.limit(limit)


def totals(points: DataFrame) -> DataFrame:
    """One row: aircraft, rows, first and last time, lowest and highest altitude, call signs sorted and joined."""
    named = F.when(F.trim("call_sign") != "", F.col("call_sign"))
    return points.agg(
        F.count_distinct("mode_s_code").alias("aircraft"),
        F.count(F.lit(1)).alias("rows"),
        F.min("timestamp").alias("t_start"),
        F.max("timestamp").alias("t_end"),
        F.min("alt").alias("alt_min"),
        F.max("alt").alias("alt_max"),
        F.array_join(F.array_sort(F.collect_set(named)), ", ").alias("call_signs"),
    )


def per_aircraft(points: DataFrame) -> DataFrame:
    """One row an aircraft, those with most rows first: rows, call signs or a dash, time and altitude ranges."""
    named = F.when(F.trim("call_sign") != "", F.col("call_sign"))
    joined = F.array_join(F.array_sort(F.collect_set(named)), ", ")
    found = points.groupBy("mode_s_code").agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.nullif(joined, F.lit("")), F.lit("-")).alias("call_signs"),
        F.min("timestamp").alias("t_start"),
        F.max("timestamp").alias("t_end"),
        F.min("alt").alias("alt_min"),
        F.max("alt").alias("alt_max"),
    )
    return found.orderBy(F.col("rows").desc(), "mode_s_code")


def last_points(points: DataFrame) -> DataFrame:
    """Each aircraft's last point, with its place on the map and its label."""
    rest = [c for c in points.columns if c not in ("mode_s_code", "timestamp")]
    last = points.groupBy("mode_s_code").agg(F.max("timestamp").alias("timestamp"), F.max_by(F.struct(*rest), "timestamp").alias("_r"))
    last = last.select("mode_s_code", "timestamp", *[F.col(f"_r.{c}").alias(c) for c in rest])
    x, y = web_mercator(F.col("lat"), F.col("lon"))
    return last.withColumn("x", x).withColumn("y", y).withColumn("label", label(F.col("mode_s_code"), F.col("call_sign"), F.col("alt")))


def trajectories(points: DataFrame) -> DataFrame:
    """The line of each aircraft with two points or more: n_points and wkt, in time order, in map metres."""
    x, y = web_mercator(F.col("lat"), F.col("lon"))
    placed = points.select("mode_s_code", "timestamp", x.alias("x"), y.alias("y"))
    placed = placed.select("mode_s_code", F.struct("timestamp", thousandths(F.col("x")).alias("x"), thousandths(F.col("y")).alias("y")).alias("p"))
    lines = placed.groupBy("mode_s_code").agg(F.array_sort(F.collect_list("p")).alias("points")).where(F.size("points") >= 2)
    text = F.array_join(F.transform("points", lambda p: F.format_string("%.3f %.3f", p.x, p.y)), ", ")
    return lines.select("mode_s_code", F.size("points").cast("long").alias("n_points"), F.concat(F.lit("LINESTRING ("), text, F.lit(")")).alias("wkt"))


def legs(points: DataFrame) -> DataFrame:
    """Each aircraft's consecutive points as pairs, for lines too long for one row."""
    w = Window.partitionBy("mode_s_code").orderBy("timestamp")
    x, y = web_mercator(F.col("lat"), F.col("lon"))
    placed = points.select("mode_s_code", "timestamp", x.alias("x"), y.alias("y"))
    return placed.withColumns({"from_x": F.lag("x").over(w), "from_y": F.lag("y").over(w)}).where("from_x is not null")


def sample(points: DataFrame, n: int = 20) -> DataFrame:
    return points.limit(n)

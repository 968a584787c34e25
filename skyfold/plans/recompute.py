"""The batch job: minute files to replaced minutes of the output table."""

from __future__ import annotations

import sys
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyfold import fs
from skyfold.config import Config, from_args
from skyfold.functions.modes import decode
from skyfold.functions.timeunits import PER_MINUTE, from_datetime
from skyfold.metrics import Totals, counts, log
from skyfold.operators.downsample import last_of_block, restore
from skyfold.operators.state import track
from skyfold.operators.watermark import anchored, confirm_chain, watermarks
from skyfold.schema import ARRIVAL
from skyfold.scratch import cut
from skyfold.sinks import table
from skyfold.sources.files import read_minutes
from skyfold.sources.minutes import MISSING, TRAILING

ORDER = list(ARRIVAL)


def marked(events: DataFrame, cfg: Config) -> DataFrame:
    """Events with their watermarks and late. A minute's files arrive together, in the order of their times; offsets
    beyond the minute make events of the next one late."""
    return watermarks(events, list(cfg.sensors), cfg.timeout, F.col("file_minute"), ORDER)


def admitted(marks: DataFrame, cfg: Config) -> DataFrame:
    """Events that aren't late with accepted: what the de-duplication lets through."""
    chained = confirm_chain(marks.where("not late"), cfg.quantum, PER_MINUTE)
    return anchored(chained, "frame", ORDER, "confirmed_before", "ts_100ns", cfg.ttl)


def positions(events: DataFrame, cfg: Config, seed: DataFrame | None = None, totals: Totals | None = None) -> DataFrame:
    """Block rows of events: icao, ts_100ns (block starts), lat, lon, alt, call_sign, squawk, on_ground. totals counts
    what is dropped on the way, where it is given."""
    marks = marked(events, cfg)
    taken = admitted(marks, cfg)
    if totals is None:
        decoded = decode(taken.where("accepted"))
    else:  # counted in the passes that make the tables
        before, after = Observation(), Observation()
        taken = cut(taken.observe(before, *counts({"deduped_dropped": ~F.col("accepted"), "_kept": F.lit(True)})))
        told = dict(before.get)
        totals.add(dropped_late=events.count() - told.pop("_kept"), **told)
        decoded = cut(decode(taken.where("accepted")).observe(after, *counts({"rejected_crc": F.col("reject_reason") == "crc_invalid", "unsupported_df": F.col("reject_reason") == "unsupported_df"})))
        totals.add(**after.get)
    fixes = track(decoded.where("reject_reason is null"), ORDER, cfg.debounce, cfg.pair, seed, cfg.reference)
    fixes = fixes.withColumn("_seen", F.col("ts_100ns"))  # blocks move the time; arrival keeps it
    order = ["file_minute", "_seen", "sensor_ordinal", "record_index"]
    return last_of_block(fixes, "icao", "ts_100ns", cfg.block, order).drop(*order)


def seed_rows(spark: SparkSession, cfg: Config) -> DataFrame | None:
    """Metadata confirmed in the lookback before the run; none by default."""
    if not cfg.lookback_s or not fs.exists(spark, cfg.table):
        return None
    start = cfg.start - timedelta(seconds=cfg.lookback_s)
    return restore(spark.read.parquet(cfg.table), F.lit(start), F.lit(cfg.start))


def sound_events(read: DataFrame, totals: Totals) -> DataFrame:
    """The events of read_minutes(), kept for the steps to come; what is wrong is counted in the pass that reads them."""
    seen, problem = Observation(), F.col("problem")
    flags = {"malformed_short_frame": F.col("frame_reject") == "malformed_short_frame", "parse_error": F.col("frame_reject") == "bad_length", "missing_files": problem == MISSING, "trailing_bytes": problem == TRAILING}
    kept = read.observe(seen, *counts(flags)).where("problem is null and frame_reject is null").drop("problem", "frame_reject")
    found = cut(kept)
    totals.add(**seen.get)
    for name in ("missing_files", "trailing_bytes"):
        if totals[name]:
            log.warning("%s=%d", name, totals[name])
    return found


def recompute(spark: SparkSession, cfg: Config) -> Totals:
    """Reads the run's minutes and the one before, and replaces the run's minutes in the table; the run's counters."""
    totals = Totals()
    read = read_minutes(spark, cfg.data_dir, cfg.template, cfg.minutes(), list(cfg.sensors))
    events = sound_events(read, totals)
    start, end = from_datetime(cfg.start), from_datetime(cfg.end)
    rows = cut(table.rendered(table.in_range(positions(events, cfg, seed_rows(spark, cfg), totals), start, end)))
    totals.count(rows, positions_emitted=F.lit(True))
    table.replace_minutes(rows, cfg.table, start // PER_MINUTE, end // PER_MINUTE)
    totals.add(db_upserts=totals["positions_emitted"])
    totals.report()
    return totals


def main(argv: list[str] | None = None) -> None:
    mode, cfg = from_args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName(f"skyfold-{mode}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if mode == "recompute":
        from skyfold.plans.progressive import recompute_progressive

        recompute_progressive(spark, cfg, cfg.stretch) if cfg.stretch else recompute(spark, cfg)
        return
    from skyfold.streaming.realtime import start

    query = start(spark, cfg)
    try:
        query.awaitTermination()
    finally:
        query.stop()

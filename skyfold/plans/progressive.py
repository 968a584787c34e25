"""A long batch job in stretches of minutes, which writes as it goes and goes on where it was.

Each stretch is read once and run by the batch operators, from what the one before it left: the sensors' latest times,
live frames, the few messages of each aircraft that can still matter, and rows of minutes that aren't over yet. A minute
is written when the confirmed time has passed its end, those without rows too, and never again. The ledger, one small
file, says what is read and written; it changes in one step, after the tables it names, so a run that is ended anywhere
begins again with the stretch it was in.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold import fs
from skyfold.config import Config
from skyfold.functions.modes import decode
from skyfold.functions.timeunits import PER_MINUTE, from_datetime
from skyfold.metrics import Totals
from skyfold.operators import state
from skyfold.operators.downsample import last_of_block
from skyfold.operators.watermark import Carried, anchored, carried_over, confirm_chain, live_frames, watermarks
from skyfold.plans.recompute import ORDER, seed_rows, sound_events
from skyfold.scratch import cut
from skyfold.sinks import table
from skyfold.sources.files import read_minutes

TABLES = ("live", "messages", "seeds", "pending")
#: Which of a block's records is the last.
ARRIVED = ["file_minute", "_seen", "sensor_ordinal", "record_index"]


@dataclass
class Ledger:
    """Minutes since the epoch: read up to, written up to; stretch: which tables go with it, none before the first."""

    read: int
    written: int
    stretch: int = -1
    carried: Carried = Carried()

    def said(self) -> str:
        own = {"latest": self.carried.latest, "watermark": self.carried.watermark, "confirmed": self.carried.confirmed}
        return json.dumps({"read": self.read, "written": self.written, "stretch": self.stretch, "carried": own})


def load(spark: SparkSession, folder: str, first: int) -> Ledger:
    """The ledger of a folder, or that of a run which begins: it reads the minute before the first one as well."""
    text = fs.read_text(spark, f"{folder}/ledger.json")
    if text is None:
        return Ledger(first - 1, first)
    own = json.loads(text)
    return Ledger(own["read"], own["written"], own["stretch"], Carried(**own["carried"]))


def followed_stretch(events: DataFrame, cfg: Config, first: int, carried: Carried, before: dict[str, DataFrame | None]) -> tuple[DataFrame, Carried, dict[str, DataFrame]]:
    """(rows of blocks with their arrival, what is carried over, the tables that go on) of the events of minutes from
    `first` on."""
    sensors = list(cfg.sensors)
    marks = watermarks(events, sensors, cfg.timeout, F.col("file_minute"), ORDER, carried=carried)
    chained = cut(confirm_chain(marks.where("not late"), cfg.quantum, PER_MINUTE, carried))
    taken = cut(anchored(chained, "frame", ORDER, "confirmed_before", "ts_100ns", cfg.ttl, before["live"]))
    after = carried_over(chained, sensors, carried)
    own = cut(decode(taken.where("accepted")).where("reject_reason is null"))
    rows = own.select(*state.MESSAGE, *[c for c in ORDER if c not in state.MESSAGE])
    if before["messages"] is not None:
        rows = rows.unionByName(before["messages"].select(rows.columns))
    rows = cut(state.followed(rows, ORDER, cfg.debounce, cfg.pair, before["seeds"], cfg.reference))
    found = state.fixes(rows, ORDER).where(F.col("file_minute") >= first * PER_MINUTE).withColumn("_seen", F.col("ts_100ns"))
    if before["pending"] is not None:
        found = found.unionByName(before["pending"].select(found.columns))
    blocks = cut(last_of_block(found, "icao", "ts_100ns", cfg.block, ARRIVED))
    going_on = {"live": live_frames(taken, "frame", "ts_100ns", cfg.ttl, after.confirmed, before["live"]), "messages": state.tail(rows, ORDER, cfg.debounce), "seeds": state.confirmed_values(rows, ORDER, before["seeds"])}
    return blocks, after, going_on


def recompute_progressive(spark: SparkSession, cfg: Config, stretch: int = 60, folder: str | None = None) -> Totals:
    """What recompute() writes, `stretch` minutes at a time; the counters of what this run wrote."""
    totals = Totals()
    folder = (folder or f"{cfg.table.rstrip('/')}-progress").rstrip("/")
    start, end = (from_datetime(t) // PER_MINUTE for t in (cfg.start, cfg.end))
    now = load(spark, folder, start)
    while now.written < end:
        first, last = now.read, min(now.read + stretch, end)
        minutes = [datetime(1970, 1, 1, tzinfo=UTC) + timedelta(minutes=m) for m in (first, last - 1)]
        if now.stretch < 0:
            before = dict.fromkeys(TABLES) | {"seeds": seed_rows(spark, cfg)}
        else:
            before = {name: spark.read.parquet(f"{folder}/stretch={now.stretch}/{name}") for name in TABLES}
        events = sound_events(read_minutes(spark, cfg.data_dir, cfg.template, minutes, list(cfg.sensors)), totals)
        blocks, carried, going_on = followed_stretch(events, cfg, first, now.carried, before)
        confirmed = end * PER_MINUTE if last == end else carried.confirmed
        ready = now.written if confirmed is None else min(end, max(now.written, confirmed // PER_MINUTE))
        if ready > now.written:
            rows = cut(table.rendered(table.ready_minutes(blocks, ready * PER_MINUTE, now.written * PER_MINUTE)))
            table.replace_minutes(rows, cfg.table, now.written, ready)
            n = rows.count()
            totals.add(positions_emitted=n, db_upserts=n)
        going_on["pending"] = blocks.where(F.col("ts_100ns") >= ready * PER_MINUTE)
        after = Ledger(last, ready, now.stretch + 1, carried)
        for name in TABLES:
            going_on[name].write.mode("overwrite").parquet(f"{folder}/stretch={after.stretch}/{name}")
        fs.write_text(spark, f"{folder}/ledger.json", after.said())
        if now.stretch >= 0:
            fs.remove(spark, f"{folder}/stretch={now.stretch}")
        now = after
        totals.tick()
    totals.report()
    return totals

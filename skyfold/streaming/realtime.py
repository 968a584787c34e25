"""The streaming job: messages to final rows of a table, in two queries with a log between them.

The first query gives each event of a batch its place on the sensors' common time: whether it is late, and the confirmed
time before and after it. That takes all sensors together, so it runs as the batch operators on each micro-batch, bucket
by bucket; all that it carries over is a few numbers. A batch of the log is a folder that appears in one step, with
its events, and with those numbers beside them. A batch that is begun again after a failure writes the same or finds it
there.

The second query streams the log through Spark's own stateful operators: frames, then aircraft, then blocks of time. Its
event time is the confirmed time, so a frame leaves the state when it has expired, and a block's row is emitted once, in
append mode, when no event can change it any more. A tick that each batch has in the log moves that time where events
don't: by the clock that messages arrive by, or at the end of the input, when every block is over.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyfold import fs
from skyfold.config import Config
from skyfold.functions.cpr import global_airborne, local_surface
from skyfold.functions.geo import icao_hex
from skyfold.functions.modes import decode
from skyfold.functions.timeunits import PER_MINUTE, of_timestamp
from skyfold.metrics import Listener, Totals, counts
from skyfold.operators.downsample import restore
from skyfold.operators.watermark import Carried, carried_over, confirm_chain, drained, watermarks
from skyfold.scratch import cut
from skyfold.sinks import table
from skyfold.sources.feed import stream_feed
from skyfold.sources.files import message_events, stream_messages
from skyfold.streaming.stateful import ADMITTED, EVENT, FIX, Aircraft, FirstCome, names

ORDER = ["seq", "record_index"]
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What the log's clock is ahead of the confirmed time, and Spark's watermark behind the clock.
DELAY_MS = 1
_CARRIED = "_carried.json"


def load(spark: SparkSession, log: str, batch: int) -> Carried:
    """What a batch left behind; nothing before the first."""
    text = fs.read_text(spark, f"{log}/batch={batch}/{_CARRIED}")
    return Carried() if text is None else Carried(**json.loads(text))


def _said(carried: Carried) -> str:
    return json.dumps({"latest": carried.latest, "watermark": carried.watermark, "confirmed": carried.confirmed})


def _clock(confirmed: Column) -> Column:
    return F.timestamp_micros(F.call_function("div", confirmed, F.lit(10).cast("long")) + 1000 * DELAY_MS)


def _ticked(spark: SparkSession, confirmed: int) -> DataFrame:
    """A row of the log without an event, which moves the clock."""
    none = [F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in EVENT.split(", ")[1:-1]]
    return spark.range(0, 1, 1, 1).select(*none, _clock(F.lit(confirmed)).alias("clock"))


def marked(messages: DataFrame, cfg: Config, before: Carried, totals: Totals) -> tuple[DataFrame, Carried]:
    """(events of a batch of messages that aren't late, with confirmed_before and clock; what they leave behind).

    messages: seq, content and arrived, a timestamp. Events that are refused or late are counted.
    """
    sensors, seen = list(cfg.sensors), Observation()
    header, frame = F.col("header_reject").isNotNull(), F.col("frame_reject")
    sound = ~header & ~F.col("unknown_sensor") & frame.isNull()
    flags = {"parse_error": header | (frame == "bad_length"), "unknown_sensor": F.col("unknown_sensor"), "malformed_short_frame": frame == "malformed_short_frame", "_sound": sound}
    events = cut(message_events(messages, sensors).observe(seen, *counts(flags)))
    found = dict(seen.get)
    n = found.pop("_sound")
    totals.add(**found)
    own = events.where(sound).select("seq", "record_index", "sensor_id", "ts_100ns", "frame")
    marks = watermarks(own, sensors, cfg.timeout, F.col("seq"), ORDER, carried=before)
    chained = cut(confirm_chain(marks.where("not late"), cfg.quantum, PER_MINUTE, before))
    totals.add(dropped_late=n - chained.count())
    return chained.withColumn("clock", _clock(F.col("confirmed_after"))).select(*names(EVENT)[1:]), carried_over(chained, sensors, before)


def mark_batch(cfg: Config, log: str, totals: Totals, wall_clock: bool):
    """What each micro-batch of the first query does."""

    def write(batch: DataFrame, number: int) -> None:
        spark, place = batch.sparkSession, f"{log}/batch={number}"
        if fs.exists(spark, place):  # written before a failure
            return
        before = load(spark, log, number - 1)
        events, carried = marked(batch.withColumn("seq", _arrival()).drop("path"), cfg, before, totals)
        if wall_clock and (now := batch.agg(F.max(of_timestamp(F.col("arrived"))).alias("now")).head().now) is not None:
            carried = drained(carried, now, cfg.timeout, cfg.quantum)
        if carried.confirmed is not None:
            events = events.unionByName(_ticked(spark, carried.confirmed))
        aside = f"{log}/_{number}-{uuid.uuid4().hex}"
        events.write.parquet(aside)
        fs.write_text(spark, f"{aside}/{_CARRIED}", _said(carried))
        fs.move(spark, aside, place)

    return write


def _arrival() -> Column:
    """The order of messages: when they came, then by name."""
    return F.concat(F.lpad(F.unix_micros("arrived").cast("string"), 20, "0"), F.lit(" "), F.col("path"))


def end_input(spark: SparkSession, cfg: Config, log: str) -> None:
    """Says in the log that no event comes any more before the last block's end: every block is over then."""
    batches = [int(n.removeprefix("batch=")) for n in fs.names(spark, log) if n.startswith("batch=")]
    if not batches:
        return
    last = max(batches)
    carried = load(spark, log, last)
    top = max([*carried.latest.values(), *(x for x in (carried.watermark, carried.confirmed) if x is not None)], default=None)
    if top is None:
        return
    end = top - top % cfg.block + cfg.block
    aside = f"{log}/_end-{uuid.uuid4().hex}"
    _ticked(spark, end).write.parquet(aside)
    fs.write_text(spark, f"{log}/batch={last}/{_CARRIED}", _said(Carried(carried.latest, end, end)))
    (part,) = [n for n in fs.names(spark, aside) if n.startswith("part-")]
    fs.move(spark, f"{aside}/{part}", f"{log}/batch={last}/{part}")
    fs.remove(spark, aside)


def blocks(log: DataFrame, cfg: Config, seeds: DataFrame | None = None) -> DataFrame:
    """Rows of the log to the table's rows, each final when it comes. log: a stream of EVENT."""
    timed = log.withWatermark("clock", f"{DELAY_MS} milliseconds")
    # the condition names the clock, so that it isn't moved before the watermark sees the ticks
    events = timed.where(F.when(F.col("clock").isNotNull(), F.col("frame").isNotNull()))
    admitted = events.groupBy("frame").transformWithState(FirstCome(cfg.ttl), ADMITTED, "append", "eventTime", eventTimeColumnName="clock")
    admitted = admitted.observe("admission", *counts({"deduped_dropped": ~F.col("accepted")}))
    decoded = decode(admitted.where("accepted"))
    decoded = decoded.observe("decoding", *counts({"rejected_crc": F.col("reject_reason") == "crc_invalid", "unsupported_df": F.col("reject_reason") == "unsupported_df"}))
    kept = ["icao", "batch", "seq", "record_index", "ts_100ns", "clock", "kind", "parity_bit", "lat_cpr", "lon_cpr", "alt_ft", "ca_ground", "call_sign", "squawk", "emergency"]
    aircraft = Aircraft(cfg.debounce, cfg.pair, cfg.reference is not None)
    initial = None if seeds is None else seeds.groupBy("icao")
    fixes = decoded.where("reject_reason is null").select(*kept).groupBy("icao").transformWithState(aircraft, FIX, "append", "eventTime", initialState=initial, eventTimeColumnName="at")
    airborne = F.col("kind") == "airborne"
    lat, lon = global_airborne(F.col("other_lat"), F.col("other_lon"), F.col("lat_cpr"), F.col("lon_cpr"), F.col("parity_bit"))
    ground = local_surface(F.col("lat_cpr"), F.col("lon_cpr"), F.col("parity_bit"), *cfg.reference) if cfg.reference else (F.lit(None), F.lit(None))
    placed = fixes.withColumns({"lat": F.when(airborne, lat).otherwise(ground[0]).cast("double"), "lon": F.when(airborne, lon).otherwise(ground[1]).cast("double")})
    placed = placed.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    said = ["lat", "lon", "alt", "call_sign", "squawk", "on_ground"]
    last = placed.groupBy(F.window("at", f"{cfg.block_ms} milliseconds").alias("_w"), "icao").agg(F.max_by(F.struct(*said), F.struct("batch", "seq", "record_index")).alias("_r"))
    return last.select(F.col("_w.start").alias("timestamp"), icao_hex(F.col("icao")).alias("mode_s_code"), *[F.col(f"_r.{c}").alias(c) for c in said])


def write_blocks(cfg: Config, totals: Totals):
    def write(batch: DataFrame, number: int) -> None:
        rows = cut(batch)
        table.with_retries(lambda: table.upsert(rows, cfg.table))
        n = rows.count()
        totals.add(positions_emitted=n, db_upserts=n)

    return write


class Running:
    """The job's two queries. Where it takes what is there and ends, the second begins when the first has ended."""

    def __init__(self, spark: SparkSession, first: StreamingQuery, second, listener: Listener, then=None):
        self.spark, self.first, self._second, self.listener, self._then = spark, first, second, listener, then
        self.second: StreamingQuery | None = None if then else second()

    def awaitTermination(self) -> None:
        try:
            if self._then:
                self.first.awaitTermination()
                self._then()
                self.second = self._second()
                self.second.awaitTermination()
            else:
                while self.first.isActive and self.second.isActive:
                    self.spark.streams.awaitAnyTermination(10)
                for q in (self.first, self.second):
                    if q.exception():
                        raise q.exception()
        finally:
            self.stop()

    def stop(self) -> None:
        queries = [q for q in (self.first, self.second) if q is not None]
        for q in queries:
            q.stop()
        self.listener.settle({str(q.runId) for q in queries})
        self.spark.streams.removeListener(self.listener)


def start(spark: SparkSession, cfg: Config, checkpoint: str | None = None, available_now: bool = False, wall_clock: bool | None = None, totals: Totals | None = None, most_files: int = 1000, ends: bool = False) -> Running:
    """The running job. cfg.messages: a folder of message files, or a feed's address, feed://host:port.

    available_now: takes what is there, then ends. wall_clock: drains by arrival, as it does unless it takes what is
    there. ends: what is there is all there is, so the blocks that are open at its end come too.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    checkpoint = (checkpoint or f"{cfg.table.rstrip('/')}-checkpoint").rstrip("/")
    by_clock = not available_now if wall_clock is None else wall_clock
    totals, log = totals or Totals(), f"{checkpoint}/log"
    listener = Listener(totals)
    spark.streams.addListener(listener)
    messages = stream_feed(spark, cfg.messages, list(cfg.sensors), prefetch=most_files) if cfg.messages.startswith("feed://") else stream_messages(spark, cfg.messages, most_files)
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 second"}
    first = messages.writeStream.foreachBatch(mark_batch(cfg, log, totals, by_clock)).option("checkpointLocation", f"{checkpoint}/marks").trigger(**trigger).start()

    def follow() -> StreamingQuery:
        fs.write_text(spark, f"{log}/_begun", "")
        seeds = None
        if cfg.lookback_s and fs.exists(spark, cfg.table):
            span = F.expr(f"current_timestamp() - interval {cfg.lookback_s} seconds"), F.current_timestamp()
            seeds = cut(restore(spark.read.parquet(cfg.table), *span))
        rows = blocks(spark.readStream.schema(", ".join([*EVENT.split(", ")[1:], EVENT.split(", ")[0]])).parquet(log), cfg, seeds)
        return rows.writeStream.outputMode("append").foreachBatch(write_blocks(cfg, totals)).option("checkpointLocation", f"{checkpoint}/blocks").trigger(**trigger).start()

    return Running(spark, first, follow, listener, (lambda: end_input(spark, cfg, log) if ends else None) if available_now else None)

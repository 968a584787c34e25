"""The multi-sensor watermark, late events, the confirmed timeline and first-come de-duplication.

watermark = least of the sensors' latest times that are within `timeout` of the greatest of them, and never
falls. An event before the watermark is late and doesn't count as seen. The confirmed time follows the watermark in
steps of a quantum or more; a frame is a duplicate until the confirmed time has reached its expiry.

All of these are running values over the whole stream. Each is computed per bucket of arrival, carried over from
bucket to bucket on one row a bucket, and finished inside the buckets, so that no task sees the stream. What a run
carries over to the next one is a few numbers and the frames that are still live.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold.functions.timeunits import floor_to
from skyfold.scratch import cut


@dataclass(frozen=True)
class Carried:
    """What one run of the stream leaves to the next: each sensor's latest time, the watermark, the confirmed time."""

    latest: dict[str, int] = field(default_factory=dict)
    watermark: int | None = None
    confirmed: int | None = None


def _candidate(latest: list[Column], timeout: int) -> Column:
    frontier = F.greatest(*latest) if len(latest) > 1 else latest[0]
    live = [F.when(x >= frontier - timeout, x) for x in latest]
    return F.least(*live) if len(live) > 1 else live[0]


def _number(value: int | None) -> Column:
    return F.lit(value).cast("long")


def _marked(rows: DataFrame, sensors: list[str], timeout: int, order: list[str], ts: str, sensor: str, carried: Carried) -> DataFrame:
    """rows (with _b, their bucket, and _skip, whether they don't count) with wm_before, wm_after and late."""
    own = [F.when((F.col(sensor) == s) & ~F.col("_skip"), F.col(ts)) for s in sensors]
    names = [f"_l{k}" for k in range(len(sensors))]
    # 1. one row a bucket: each sensor's latest time there
    per = rows.groupBy("_b").agg(*[F.max(c).alias(n) for c, n in zip(own, names, strict=True)])
    # 2. what comes into each bucket; as many rows as buckets
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    begin = [_number(carried.latest.get(s)) for s in sensors]
    into = per.select("_b", *[F.greatest(F.max(n).over(before), b).alias(f"{n}_in") for n, b in zip(names, begin, strict=True)])
    # 3. inside the buckets
    inside = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = Window.partitionBy("_b").orderBy(*order)
    joined = rows.join(into, "_b")
    latest = [F.greatest(F.col(f"{n}_in"), F.max(c).over(inside)) for c, n in zip(own, names, strict=True)]
    joined = joined.withColumns({f"{n}_now": x for n, x in zip(names, latest, strict=True)})
    joined = joined.withColumn("_c", _candidate([F.col(f"{n}_now") for n in names], timeout))
    # the watermark that a bucket begins with: the greatest candidate so far, again one row a bucket
    tops = joined.groupBy("_b").agg(F.max("_c").alias("_top"))
    floor = tops.select("_b", F.greatest(F.max("_top").over(before), _number(carried.watermark)).alias("_floor"))
    joined = joined.join(floor, "_b").withColumn("wm_after", F.greatest(F.max("_c").over(inside), F.col("_floor")))
    # a row alone in being first has nothing before it but what came into its bucket
    joined = joined.withColumn("wm_before", F.when(F.row_number().over(at) > 1, F.lag("wm_after").over(at)).otherwise(F.col("_floor")))
    late = F.coalesce(F.col(ts) < F.col("wm_before"), F.lit(False))
    return joined.withColumn("late", late).select(*rows.columns, "wm_before", "wm_after", "late")


def watermarks(events: DataFrame, sensors: list[str], timeout: int, bucket: Column, order: list[str], ts: str = "ts_100ns", sensor: str = "sensor_id", carried: Carried | None = None, in_time_order: bool = False) -> DataFrame:
    """events with wm_before, null before the first event, wm_after and late.

    order: arrival order. bucket: what a task's window covers; it must not fall along the order. Events of sensors that
    aren't declared don't move the watermark.

    Which events are late depends on the watermark, and the watermark on which events count. Starting with none late,
    both are computed until no event changes sides. That ends, in the only solution there is: the statuses up to the
    first event that changes are right, so each round settles one more at least, and a burst of late events in one.
    in_time_order: the caller's word that times never fall along the order, so that none is late and one round does.
    """
    carried = carried or Carried()
    rows = events.withColumn("_b", bucket).withColumn("_skip", F.lit(False))
    found = _marked(rows, sensors, timeout, order, ts, sensor, carried)
    while not in_time_order:
        found = cut(found)
        if found.where("late <> _skip").isEmpty():
            break
        rows = found.withColumn("_skip", F.col("late")).select(*rows.columns)
        found = _marked(rows, sensors, timeout, order, ts, sensor, carried)
    return found.select(*events.columns, "wm_before", "wm_after", "late")


def _steps(values: np.ndarray, quantum: int) -> np.ndarray:
    """The place of the first value a quantum or more beyond each of some ascending ones; their number if none is."""
    return np.searchsorted(values, values + quantum)


def _exits(pdf: pd.DataFrame, quantum: int, start: int) -> pd.DataFrame:
    """One row of a bucket: where the chain could enter it, and the last confirmation there if it does.

    What comes in is less than the bucket's start, so the chain enters at a value less than a quantum beyond it, or at
    the first one of those further on.
    """
    values = np.sort(pdf["_wm"].to_numpy())
    step = _steps(values, quantum)
    last = np.where(step < len(values), step, np.arange(len(values)))
    while not np.array_equal(further := last[last], last):
        last = further
    n = min(len(values), int(np.searchsorted(values, start + quantum)) + 1)
    return pd.DataFrame({"_w": [start], "_enter": [values[:n].tolist()], "_leave": [values[last[:n]].tolist()]})


def _followed(pdf: pd.DataFrame, quantum: int) -> pd.DataFrame:
    """Each watermark of a bucket with the confirmed time at it, from the one that comes in."""
    values = np.sort(pdf["_wm"].to_numpy())
    into = pdf["_in"].iloc[0]
    step = _steps(values, quantum)
    at = 0 if pd.isna(into) else int(np.searchsorted(values, int(into) + quantum))
    places = []
    while at < len(values):
        places.append(at)
        at = int(step[at])
    which = np.searchsorted(np.array(places, dtype=np.int64), np.arange(len(values)), side="right") - 1
    found = pd.array([None] * len(values), dtype="Int64")
    found[which >= 0] = values[np.array(places, dtype=np.int64)[which[which >= 0]]] if places else []
    if not pd.isna(into):
        found[which < 0] = int(into)
    return pd.DataFrame({"_wm": values, "_confirmed": found})


def confirm_chain(marks: DataFrame, quantum: int, bucket: int, carried: Carried | None = None) -> DataFrame:
    """marks, one row an event with wm_before and wm_after, with confirmed_before and confirmed_after.

    confirmed becomes the watermark when that is `quantum` or more beyond it, first at the first watermark. bucket: the
    time that a task follows. For each bucket there is one row with its few possible entries and where each leads;
    the chain goes through these rows one after another, then through all buckets at once.
    """
    begin = carried.confirmed if carried else None
    advances = marks.select(F.explode(F.array("wm_before", "wm_after")).alias("_wm")).where(F.col("_wm").isNotNull())
    if begin is not None:
        advances = advances.where(F.col("_wm") >= begin)
    advances = advances.distinct().withColumn("_w", floor_to(F.col("_wm"), bucket))

    def exits(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return _exits(pdf, quantum, int(key[0]))

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row a bucket in turn, and one number between them."""
        confirmed = begin
        for batch in batches:
            into = []
            for enter, leave in zip(batch.column("_enter").to_pylist(), batch.column("_leave").to_pylist(), strict=True):
                into.append(confirmed)
                at = 0 if confirmed is None else int(np.searchsorted(enter, confirmed + quantum))
                if at < len(enter):
                    confirmed = leave[at]
            yield pa.RecordBatch.from_arrays([batch.column("_w"), pa.array(into, pa.int64())], names=["_w", "_in"])

    maps = advances.groupBy("_w").applyInPandas(exits, "_w long, _enter array<long>, _leave array<long>")
    into = maps.repartition(1).sortWithinPartitions("_w").mapInArrow(through, "_w long, _in long")
    chain = advances.join(into, "_w").groupBy("_w").applyInPandas(lambda pdf: _followed(pdf, quantum), "_wm long, _confirmed long")
    after = chain.select(F.col("_wm").alias("wm_after"), F.col("_confirmed").alias("confirmed_after"))
    before = chain.select(F.col("_wm").alias("wm_before"), F.col("_confirmed").alias("confirmed_before"))
    columns = [*marks.columns, "confirmed_before", "confirmed_after"]
    found = marks.join(after, "wm_after", "left").join(before, "wm_before", "left")
    if begin is not None:  # a watermark that has not moved since the last run
        found = found.withColumns({c: F.coalesce(c, F.lit(begin)) for c in columns[-2:]})
    return found.select(*columns)


def _taken(ts: np.ndarray, clock: np.ndarray, expiry: int | None, ttl: int) -> tuple[np.ndarray, int | None]:
    """(which rows of one frame are accepted, the last expiry). clock doesn't fall; expiry: of the live one before."""
    taken, at = np.zeros(len(ts), dtype=bool), 0
    while True:
        if expiry is not None:
            at = max(at, int(np.searchsorted(clock, expiry)))
        if at >= len(ts):
            return taken, expiry
        taken[at] = True
        expiry = int(ts[at]) + ttl
        at += 1


def anchored(df: DataFrame, frame: str, order: list[str], clock: str, ts: str, ttl: int, live: DataFrame | None = None) -> DataFrame:
    """df with accepted: the first of each frame, and any that comes once the last accepted one has expired.

    An entry expires when the clock column, which must not fall along the order, reaches its time + ttl; null is a
    clock that hasn't begun. Repeats that are dropped don't prolong it. live: frame and expiry of entries from before.
    Rows stream through each task with one expiry and are followed from one accepted row to the next; a frame on very
    many rows takes time there but no memory.
    """
    known = df.withColumn("_expiry", _number(None)) if live is None else df.join(live.select(frame, F.col("expiry").alias("_expiry")), frame, "left")
    begin = np.iinfo(np.int64).min

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, expiry = None, None
        for batch in batches:
            frames = batch.column(frame).dictionary_encode()
            which = frames.indices.to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.flatnonzero(np.diff(which)) + 1, [len(which)]])
            times, clocks = batch.column(ts).to_numpy(zero_copy_only=False), batch.column(clock).fill_null(begin).to_numpy(zero_copy_only=False)
            accepted = np.zeros(len(which), dtype=bool)
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if a < b:
                    own = batch.column(frame)[a].as_py()
                    if own != key:
                        key, expiry = own, batch.column("_expiry")[a].as_py()
                    accepted[a:b], expiry = _taken(times[a:b], clocks[a:b], expiry, ttl)
            kept = [c for c in batch.schema.names if c != "_expiry"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(accepted)], names=[*kept, "accepted"])

    schema = ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes) + ", accepted boolean"
    return known.select(*df.columns, "_expiry").repartition(frame).sortWithinPartitions(frame, *order).mapInArrow(follow, schema)


def live_frames(admitted: DataFrame, frame: str, ts: str, ttl: int, confirmed: int | None, live: DataFrame | None = None) -> DataFrame:
    """(frame, expiry) of what is still live at the confirmed time, after rows with `accepted`."""
    now = admitted.where("accepted").groupBy(frame).agg(F.max(F.col(ts) + ttl).alias("expiry"))
    if live is not None:
        now = now.unionByName(live.select(frame, "expiry")).groupBy(frame).agg(F.max("expiry").alias("expiry"))
    return now if confirmed is None else now.where(F.col("expiry") > confirmed)


def carried_over(marks: DataFrame, sensors: list[str], carried: Carried | None = None, ts: str = "ts_100ns", sensor: str = "sensor_id") -> Carried:
    """What rows with wm_after, late and confirmed_after leave behind: one row of as many numbers as there are sensors."""
    before = carried or Carried()
    own = [F.max(F.when((F.col(sensor) == s) & ~F.col("late"), F.col(ts))).alias(f"_l{k}") for k, s in enumerate(sensors)]
    row = marks.agg(*own, F.max("wm_after").alias("_w"), F.max("confirmed_after").alias("_c")).head()

    def later(a: int | None, b: int | None) -> int | None:
        return a if b is None else b if a is None else max(a, b)

    latest = {s: x for k, s in enumerate(sensors) if (x := later(before.latest.get(s), row[f"_l{k}"])) is not None}
    return Carried(latest, later(before.watermark, row["_w"]), later(before.confirmed, row["_c"]))


def drained(carried: Carried, now: int, timeout: int, quantum: int) -> Carried:
    """carried, at a clock that no sensor needs: the watermark is at least `timeout` behind it."""
    watermark = now - timeout if carried.watermark is None else max(carried.watermark, now - timeout)
    moved = carried.confirmed is None or watermark >= carried.confirmed + quantum
    return Carried(carried.latest, watermark, watermark if moved else carried.confirmed)

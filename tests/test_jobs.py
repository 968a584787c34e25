import os
from dataclasses import replace
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from skyfold.config import Config
from skyfold.functions.timeunits import PER_MINUTE, from_datetime
from skyfold.metrics import Totals
from skyfold.operators import views
from skyfold.plans.recompute import recompute
from skyfold.sinks import table
from skyfold.sources import wire
from skyfold.streaming.realtime import start

EVEN, ODD = (bytes.fromhex(x) for x in ("8D40058B58C901375147EFD09357", "8D40058B58C904A87F402D3B8C59"))
NOON = datetime(2026, 6, 27, 12, 0, tzinfo=UTC)
RECORDS = {"AB01": (1_000_000, EVEN, -50), "AB02": (2_000_000, ODD, -55), "AB03": (1_300_000, EVEN, -60)}


@pytest.fixture
def cfg(tmp_path):
    for sensor, r in RECORDS.items():
        (tmp_path / f"202606271200{sensor}.spkx").write_bytes(wire.encode_record(*r) + b"rest")
    return Config(tuple(RECORDS), data_dir=str(tmp_path), start=NOON, end=NOON.replace(minute=2), table=str(tmp_path / "table")).validated("recompute")


def rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*views.COLUMNS).collect())


def check(found):
    (r,) = found
    assert r[0] == datetime(2026, 6, 27, 12, 0) and r[1] == "40058B" and r[4:] == (39000, None, None, False)
    assert r[2:4] == pytest.approx((49.81755, 6.08442), abs=1e-3)


def test_recompute_twice_gives_the_same_table(spark, cfg):
    totals = recompute(spark, cfg)
    assert (totals["deduped_dropped"], totals["positions_emitted"], totals["db_upserts"], totals["dropped_late"]) == (1, 1, 1, 0)
    assert (totals["trailing_bytes"], totals["missing_files"]) == (3, 6)
    first = rows(spark, cfg.table)
    check(first)
    recompute(spark, cfg)
    assert rows(spark, cfg.table) == first


def test_recompute_empties_minutes_without_rows(spark, cfg, tmp_path):
    recompute(spark, cfg)
    for sensor in RECORDS:
        (tmp_path / f"202606271200{sensor}.spkx").write_bytes(b"")
    later = RECORDS["AB01"]
    (tmp_path / "202606271201AB01.spkx").write_bytes(wire.encode_record(*later) + wire.encode_record(2_000_000, ODD, -50))
    recompute(spark, cfg)
    assert [r[0].minute for r in rows(spark, cfg.table)] == [1]


def test_warm_up_is_read_and_not_written(spark, cfg, tmp_path):
    one = replace(cfg, start=NOON.replace(minute=1), end=NOON.replace(minute=2))
    # the first frame of the minute is still a duplicate; it moves the clock, so that those after it are not
    later = [(500_000, ODD, -50), (10_000_000, EVEN, -50), (20_000_000, ODD, -50)]
    (tmp_path / "202606271201AB01.spkx").write_bytes(b"".join(wire.encode_record(*r) for r in later))
    recompute(spark, one)
    assert [r[0].minute for r in rows(spark, cfg.table)] == [1]


def test_stream_writes_what_the_batch_writes(spark, cfg, tmp_path):
    recompute(spark, cfg)
    expected = rows(spark, cfg.table)
    folder = tmp_path / "messages"
    folder.mkdir()
    for k, sensor in enumerate(("AB01", "AB03", "AB02")):  # in the order of their times
        (folder / f"{k}.msg").write_bytes(wire.encode_message(sensor, "20260627120000", wire.encode_record(*RECORDS[sensor])))
    (folder / "3.msg").write_bytes(b"short")
    (folder / "4.msg").write_bytes(wire.encode_message("ZZ99", "20260627120000", b""))
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    live = replace(cfg, messages=str(folder), table=str(tmp_path / "live"))
    totals = Totals()
    query = start(spark, live, str(tmp_path / "offsets"), available_now=True, totals=totals, ends=True)
    query.awaitTermination()
    assert (totals["parse_error"], totals["unknown_sensor"], totals["deduped_dropped"], totals["positions_emitted"], totals["db_upserts"]) == (1, 1, 1, 1, 1)
    found = rows(spark, live.table)
    assert [r[:2] + r[4:] for r in found] == [r[:2] + r[4:] for r in expected]
    assert found[0][2:4] == pytest.approx(expected[0][2:4])


def stamped(path, second):
    at = NOON.timestamp() + second
    os.utime(path, (at, at))


def test_stream_by_the_clock_with_a_restart(spark, tmp_path):
    """One message a batch, drained by arrival, ended and begun again in the middle: rows as in one run, and as by hand."""
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    sent = [  # arrival in seconds after noon, sensor, records in ms after noon
        (1, "AB01", [(100, EVEN), (900, ODD)]),
        (4, "AB02", [(200, EVEN), (3500, EVEN)]),  # the first one is a second and more behind, but came in time
        (6, "AB01", [(2900, ODD), (5500, ODD)]),  # 2900 is late: 3000 was drained by the arrival at 4
        (9, "AB02", [(8500, EVEN)]),
    ]
    outcomes = {}
    for name, cuts in (("whole", [4]), ("restarted", [2, 4])):
        folder = tmp_path / name
        folder.mkdir()
        cfg = Config(("AB01", "AB02"), messages=str(folder), table=str(tmp_path / f"{name}-table")).validated("realtime")
        at, totals = 0, Totals()
        for end in cuts:
            for k in range(at, end):
                second, sensor, records = sent[k]
                body = b"".join(wire.encode_record(ms * 10_000, frame, -50) for ms, frame in records)
                (folder / f"{k}.msg").write_bytes(wire.encode_message(sensor, "20260627120000", body))
                stamped(folder / f"{k}.msg", second)
            at = end
            start(spark, cfg, str(tmp_path / f"{name}-offsets"), available_now=True, wall_clock=True, totals=totals, most_files=1, ends=end == 4).awaitTermination()
        outcomes[name] = (rows(spark, cfg.table), totals["dropped_late"], totals["deduped_dropped"])
    assert outcomes["whole"] == outcomes["restarted"]
    found, late, repeated = outcomes["whole"]
    assert [r[0].second for r in found] == [0, 3, 5, 8] and late == 2 and repeated == 0


def test_upsert_takes_new_rows_with_their_nulls(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    path = str(tmp_path / "t")
    schema = "timestamp timestamp, mode_s_code string, lat double, lon double, alt int, call_sign string, squawk string, on_ground boolean"
    at = datetime(2026, 6, 27, 12, 0)
    old = [(at, "A", 1.0, 1.0, 100, "OLD", None, False), (at, "B", 1.0, 1.0, 100, "KEPT", None, False)]
    new = [(at, "A", 2.0, 2.0, None, None, None, True), (at.replace(minute=1), "A", 3.0, 3.0, 1, None, None, False)]
    for batch in (old, new, new):
        table.upsert(spark.createDataFrame(batch, schema), path)
    assert rows(spark, path) == sorted([new[0], old[1], new[1]])


@pytest.mark.parametrize("fault", ["null", "twice"])
def test_rows_that_the_table_cannot_hold_leave_it_as_it_was(spark, tmp_path, fault):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    path = str(tmp_path / "t")
    schema = "timestamp timestamp, mode_s_code string, lat double, lon double, alt int, call_sign string, squawk string, on_ground boolean"
    at = datetime(2026, 6, 27, 12, 0)
    first = from_datetime(NOON) // PER_MINUTE
    good = [(at.replace(minute=m), c, 1.0, 1.0, None, None, None, False) for m in range(4) for c in "AB"]
    table.replace_minutes(spark.createDataFrame(good, schema), path, first, first + 4)
    before = rows(spark, path)
    assert before == sorted(good)
    flaw = (at.replace(minute=3), None if fault == "null" else "A", 2.0, 2.0, None, None, None, False)
    new = [(at.replace(minute=m), "A", 2.0, 2.0, None, None, None, False) for m in range(1, 4)]
    with pytest.raises(Exception, match="null in mode_s_code" if fault == "null" else "key twice"):
        table.replace_minutes(spark.createDataFrame([*new, flaw], schema), path, first, first + 4)
    assert rows(spark, path) == before
    table.replace_minutes(spark.createDataFrame(new, schema), path, first, first + 4)
    assert rows(spark, path) == sorted(new)  # the minute without a new row is gone
    table.replace_minutes(spark.createDataFrame([], schema), path, first, first + 2)
    assert rows(spark, path) == sorted(new[1:])


def test_ready_minutes(spark):
    minute = from_datetime(NOON)
    records = spark.createDataFrame([(minute,), (minute + PER_MINUTE,)], "ts_100ns long")
    ready = lambda t: table.ready_minutes(records, t, minute).count()
    assert [ready(minute + PER_MINUTE - 1), ready(minute + PER_MINUTE), ready(minute + 2 * PER_MINUTE)] == [0, 1, 2]


def test_retries_end_in_the_failure():
    calls = []

    def write():
        calls.append(1)
        raise OSError("down")

    with pytest.raises(OSError):
        table.with_retries(write, pause_s=0)
    assert len(calls) == 3


def test_views(spark):
    at = datetime(2026, 6, 27, 12, 0)
    schema = "timestamp timestamp, mode_s_code string, lat double, lon double, alt int, call_sign string, squawk string, on_ground boolean"
    points = spark.createDataFrame(
        [(at, "A", 1.0, 2.0, 100, "X1", None, False), (at.replace(second=1), "A", 1.5, 2.5, None, "  ", None, False), (at, "B", 0.0, 0.0, 300, None, None, True), (at, "C", None, 1.0, 1, "no", None, False)], schema
    )
    seen = points.where(views.predicates())
    assert [tuple(r)[:2] for r in views.select_points(points, limit=2).collect()] == [(at, "A"), (at.replace(second=1), "A")]
    assert views.select_points(points, on_ground=True).count() == 1 and views.select_points(points, codes=["A"], end=at.replace(second=1)).count() == 1
    total = views.totals(seen).first()
    assert (total.aircraft, total.rows, total.alt_min, total.alt_max, total.call_signs) == (2, 3, 100, 300, "X1")
    assert [(r.mode_s_code, r.rows, r.call_signs) for r in views.per_aircraft(seen).collect()] == [("A", 2, "X1"), ("B", 1, "-")]
    assert {r.mode_s_code: r.label for r in views.last_points(seen).collect()} == {"A": "A\nalt=-", "B": "B\nalt=300"}
    (line,) = views.trajectories(seen).collect()
    assert (line.mode_s_code, line.n_points) == ("A", 2) and line.wkt.startswith("LINESTRING (")
    assert views.legs(seen).count() == 1 and views.sample(seen, 2).count() == 2
    assert seen.where(F.col("call_sign") == "no").count() == 0

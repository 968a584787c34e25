import random

import pytest
from pyspark.sql import functions as F
from sequential import admission, debounced

from skyfold import metrics
from skyfold.operators import downsample, state, watermark
from skyfold.operators.watermark import Carried, carried_over, drained, live_frames

MS = 10_000


def stream(spark, events):
    return spark.createDataFrame([(k, *e) for k, e in enumerate(events)], "seq long, sensor_id string, ts_100ns long, frame string")


def admitted(spark, events, timeout, ttl, quantum, bucket, sensors=("s1", "s2", "s3")):
    marks = watermark.watermarks(stream(spark, events), list(sensors), timeout, F.expr("seq div 37"), ["seq"])
    chained = watermark.confirm_chain(marks, quantum, bucket)
    found = watermark.anchored(chained, "frame", ["seq"], "confirmed_before", "ts_100ns", ttl)
    return [r.asDict() for r in found.orderBy("seq").collect()]


def drawn(seed, n=300, jitter=0):
    draw = random.Random(seed)
    times = sorted(draw.randrange(0, 3000 * MS) for _ in range(n))
    return draw, [(draw.choice(["s1", "s2", "s3"]), t + draw.randrange(-jitter, jitter + 1), f"f{draw.randrange(6)}") for t in times]


@pytest.mark.parametrize(("seed", "jitter"), [(0, 0), (1, 0), (2, 0), (3, 40 * MS), (4, 200 * MS), (5, 1500 * MS)])
def test_admission_equals_the_rule_over_the_history(spark, seed, jitter):
    draw, events = drawn(seed, jitter=jitter)
    timeout, ttl = draw.choice([30, 100, 1000]) * MS, 50 * MS
    expected = admission(events, timeout, ttl, ttl)
    marks = watermark.watermarks(stream(spark, events), ["s1", "s2", "s3"], timeout, F.expr("seq div 23"), ["seq"]).orderBy("seq").collect()
    assert [(r.wm_before, r.late) for r in marks] == [(e["wm_before"], e["late"]) for e in expected]
    assert jitter == 0 or sum(r.late for r in marks) > 5
    kept = [e for e in expected if not e["late"]]
    own = watermark.watermarks(stream(spark, events), ["s1", "s2", "s3"], timeout, F.expr("seq div 23"), ["seq"]).where("not late")
    taken = watermark.anchored(watermark.confirm_chain(own, ttl, 200 * MS), "frame", ["seq"], "confirmed_before", "ts_100ns", ttl).orderBy("seq").collect()
    assert [(r.confirmed_before, r.accepted) for r in taken] == [(e["confirmed_before"], e["accepted"]) for e in kept]


def test_a_late_event_does_not_hold_the_watermark_back(spark):
    events = [("s2", 0, "a"), ("s1", 3000 * MS, "b"), ("s2", 1000 * MS, "c"), ("s1", 3100 * MS, "d"), ("s2", 2500 * MS, "e"), ("s1", 3200 * MS, "f"), ("s2", 3150 * MS, "g")]
    found = watermark.watermarks(stream(spark, events), ["s1", "s2"], 1000 * MS, F.expr("seq div 2"), ["seq"]).orderBy("seq").collect()
    assert found[5].wm_after == 3200 * MS and [r.late for r in found] == [False, False, True, False, True, False, True]


def test_dense_streams_are_confirmed_bucket_by_bucket(spark):
    """An event a millisecond for 20 s: no gap of a quantum anywhere, and more than one bucket."""
    rows = spark.range(20_000).select(F.col("id").alias("seq"), F.lit("s1").alias("sensor_id"), (F.col("id") * MS + F.col("id") % 7 * 1000).alias("ts_100ns"), F.lit("f").alias("frame"))
    marks = watermark.watermarks(rows, ["s1"], 0, F.expr("seq div 1000"), ["seq"], in_time_order=True)
    found = watermark.confirm_chain(marks, 50 * MS, 1000 * MS)
    values = [k * MS + k % 7 * 1000 for k in range(20_000)]
    expected, last = [], None
    for w in values:
        last = w if last is None or w - last >= 50 * MS else last
        expected.append(last)
    assert [r.confirmed_after for r in found.orderBy("seq").collect()] == expected


@pytest.mark.parametrize("jitter", [0, 300 * MS])
def test_runs_that_begin_where_the_last_one_ended(spark, jitter):
    """A stream cut into runs at any place is admitted as it is whole."""
    _, events = drawn(9, 240, jitter)
    timeout, ttl, sensors = 100 * MS, 50 * MS, ["s1", "s2", "s3"]
    expected = [(e["confirmed_before"], e["accepted"]) for e in admission(events, timeout, ttl, ttl) if not e["late"]]
    carried, live, found, at = Carried(), None, [], 0
    for size in (1, 100, 0, 57, 82):
        own = stream(spark, events).where(F.col("seq").between(at, at + size - 1))
        marks = watermark.watermarks(own, sensors, timeout, F.expr("seq div 19"), ["seq"], carried=carried)
        chained = watermark.confirm_chain(marks.where("not late"), ttl, 150 * MS, carried)
        taken = watermark.anchored(chained, "frame", ["seq"], "confirmed_before", "ts_100ns", ttl, live)
        rows = taken.orderBy("seq").collect()
        found += [(r.confirmed_before, r.accepted) for r in rows]
        carried = carried_over(chained, sensors, carried)
        left = live_frames(taken, "frame", "ts_100ns", ttl, carried.confirmed, live).collect()
        live = spark.createDataFrame([tuple(r) for r in left], "frame string, expiry long")
        at += size
    assert at == 240 and found == expected


def test_worked_cases(spark):
    run = lambda events: [r["accepted"] for r in admitted(spark, events, 1000 * MS, 50 * MS, 50 * MS, 60_000 * MS)]
    assert run([("s1", 0, "f"), ("s1", 60 * MS, "f")]) == [True, False]
    assert run([("s1", 0, "f"), ("s1", 60 * MS, "g"), ("s1", 61 * MS, "f")]) == [True, True, True]
    assert run([("s1", 0, "g"), ("s2", 0, "h"), ("s2", 800 * MS, "f"), ("s2", 850 * MS, "f")]) == [True, True, True, False]


def test_watermark_of_two_sensors(spark):
    events = [("s1", 10_000_000, "a"), ("s2", 20_000_000, "b"), ("s1", 25_000_000, "c")]
    found = watermark.watermarks(stream(spark, events), ["s1", "s2"], 1000 * MS, F.lit(0), ["seq"]).orderBy("seq").collect()
    assert [r.wm_after for r in found] == [10_000_000, 10_000_000, 20_000_000]


def test_lagging_sensor_is_left_out(spark):
    events = [("s1", 10_000_000, "a"), ("s2", 10_000_000, "b"), ("s1", 100_000_000, "c")]
    found = watermark.watermarks(stream(spark, events), ["s1", "s2"], 1000 * MS, F.lit(0), ["seq"]).orderBy("seq").collect()
    assert found[-1].wm_after == 100_000_000


def test_empty_streams(spark):
    assert admitted(spark, [], 1000 * MS, 50 * MS, 50 * MS, 60_000 * MS) == []


def test_wall_clock_drain(spark):
    begun = Carried({"s1": 10_000_000}, 10_000_000, 10_000_000)
    after = drained(begun, 30_000_000, 1000 * MS, 50 * MS)
    assert after == Carried({"s1": 10_000_000}, 20_000_000, 20_000_000)
    assert drained(after, 1, 1000 * MS, 50 * MS) == after
    assert drained(after, 30_000_001, 1000 * MS, 50 * MS) == Carried({"s1": 10_000_000}, 20_000_001, 20_000_000)
    events = stream(spark, [("s1", 19_999_999, "g"), ("s1", 20_000_000, "f")])
    found = watermark.watermarks(events, ["s1"], 1000 * MS, F.lit(0), ["seq"], carried=after).orderBy("seq").collect()
    assert [r.late for r in found] == [True, False]


def test_purge_edge(spark):
    """A frame is live until the confirmed time reaches its expiry, the bound included."""
    for at, taken in ((1_499_999, False), (1_500_000, True)):
        rows = [("s1", 1_000_000, "f"), ("s1", at, "g"), ("s1", at, "f")]
        assert admitted(spark, rows, 0, 50 * MS, 1, 60_000 * MS)[-1]["accepted"] == taken


def test_dedup_counts_and_order(spark):
    own = stream(spark, [("s1", 1000, "f1"), ("s2", 1200, "f1"), ("s1", 1300, "f2")]).withColumn("clock", F.lit(None).cast("long"))
    found = watermark.anchored(own, "frame", ["seq"], "clock", "ts_100ns", 50 * MS).orderBy("seq").collect()
    assert [r.accepted for r in found] == [True, False, True]


def debounce(spark, values, n=3, emergencies=(), seed=None):
    rows = spark.createDataFrame([(k, 1, v) for k, v in enumerate(values)], "seq long, icao int, v string").withColumn("seed", F.lit(seed).cast("string"))
    force = F.coalesce(F.col("v").isin(*emergencies), F.lit(False)) if emergencies else None
    return [r.c for r in state.debounce(rows, "icao", ["seq"], "v", n, "c", force=force, seed="seed" if seed else None).orderBy("seq").collect()]


def test_n_strikes(spark):
    assert debounce(spark, ["A", "A", "A"]) == [None, None, "A"]
    assert debounce(spark, ["A", "A", "B", "A", "A", "A"]) == [None] * 5 + ["A"]
    assert debounce(spark, ["1200", "1200", "7700"], emergencies=("7700",)) == [None, None, "7700"]
    assert debounce(spark, ["", "", ""]) == [None, None, ""]
    assert debounce(spark, ["B", "A", "A", "A"], seed="S") == ["S", "S", "S", "A"]


@pytest.mark.parametrize("seed", range(3))
def test_n_strikes_equal_the_sequential_rule(spark, seed):
    draw = random.Random(seed)
    values = [draw.choice(["A", "A", "B", "7700", None]) for _ in range(400)]
    n = draw.randint(1, 4)
    expected = debounced(values, n, {"7700"})
    assert debounce(spark, values, n, ("7700",)) == expected


def blocks(spark, rows):
    own = spark.createDataFrame(rows, "seq long, icao int, ts_100ns long, lat double, call_sign string")
    return sorted(tuple(r) for r in downsample.last_of_block(own, "icao", "ts_100ns", 10_000_000, ["seq"]).select("icao", "ts_100ns", "lat", "call_sign").collect())


def test_blocks(spark):
    assert blocks(spark, [(1, 1, 13_456_789, 1.0, "a")]) == [(1, 10_000_000, 1.0, "a")]
    # the last arrival wins with its nulls, not the latest time
    assert blocks(spark, [(1, 1, 10_900_000, 1.0, "a"), (2, 1, 10_100_000, 2.0, None)]) == [(1, 10_000_000, 2.0, None)]
    assert len(blocks(spark, [(1, 1, 1, 1.0, ""), (2, 2, 1, 1.0, ""), (3, 1, 10_000_000, 1.0, ""), (4, 1, -1, 1.0, "")])) == 4


def test_block_end(spark):
    start = F.lit(10_000_000)
    row = spark.range(1).select(downsample.ended(start, 10_000_000, F.lit(19_999_999)).alias("a"), downsample.ended(start, 10_000_000, F.lit(20_000_000)).alias("b")).first()
    assert (row.a, row.b) == (False, True)


def fixes(spark, rows, **more):
    schema = "seq long, ts_100ns long, icao int, kind string, parity_bit int, lat_cpr int, lon_cpr int, alt_ft int, ca_ground boolean, call_sign string, squawk string, emergency boolean"
    base = {"parity_bit": None, "lat_cpr": None, "lon_cpr": None, "alt_ft": None, "ca_ground": False, "call_sign": None, "squawk": None, "emergency": False}
    names = [c.split()[0] for c in schema.split(", ")]
    full = [{"seq": k, "icao": 1, **base, **r} for k, r in enumerate(rows)]
    own = spark.createDataFrame([tuple(r[c] for c in names) for r in full], schema)
    return state.track(own, ["seq"], 3, 10_000 * MS, **more).orderBy("seq").collect()


EVEN = {"kind": "airborne", "parity_bit": 0, "lat_cpr": 39848, "lon_cpr": 83951}
ODD = {"kind": "airborne", "parity_bit": 1, "lat_cpr": 21567, "lon_cpr": 81965}


def test_positions_need_a_pair_within_ten_seconds(spark):
    pair = lambda gap: fixes(spark, [{"ts_100ns": 0, **EVEN}, {"ts_100ns": gap, **ODD}])
    assert [len(pair(g)) for g in (10_000, 100_000_000, 100_000_001, 110_000_000)] == [1, 1, 0, 0]
    assert fixes(spark, [{"ts_100ns": 0, **EVEN}, {"ts_100ns": 1, **EVEN}]) == []


def test_altitude_of_a_fix(spark):
    told = {"ts_100ns": 2, "kind": "altitude", "alt_ft": 5000}
    unknown = {"ts_100ns": 3, "kind": "altitude"}
    rows = [{"ts_100ns": 0, **EVEN, "alt_ft": 900}, {"ts_100ns": 1, **ODD}, told, unknown, {"ts_100ns": 4, **EVEN}, {"ts_100ns": 5, **ODD, "alt_ft": 7000}, {"ts_100ns": 6, **EVEN}]
    assert [r.alt for r in fixes(spark, rows)] == [None, 5000, 7000, 5000]


def test_a_state_carried_over_gives_the_same_fixes(spark):
    """Messages followed in two runs, the second after the tail of the first, fix what they fix in one."""
    draw = random.Random(4)
    rows = []
    for k in range(160):
        kind = draw.choice([EVEN, ODD, {"kind": "callsign"}, {"kind": "squawk"}, {"kind": "altitude"}])
        row = {"seq": k, "ts_100ns": k * 7_000_000, "icao": draw.randrange(3), **kind}
        if kind == {"kind": "callsign"}:
            row["call_sign"] = draw.choice(["A", "B"])
        elif kind == {"kind": "squawk"}:
            row["squawk"] = draw.choice(["1000", "1000", "7700"])
            row["emergency"] = row["squawk"] == "7700"
        elif kind == {"kind": "altitude"}:
            row["alt_ft"] = draw.choice([None, 1000 + k])
        rows.append(row)
    schema = "seq long, ts_100ns long, icao int, kind string, parity_bit int, lat_cpr int, lon_cpr int, alt_ft int, ca_ground boolean, call_sign string, squawk string, emergency boolean"
    names = [c.split()[0] for c in schema.split(", ")]
    make = lambda own: spark.createDataFrame([tuple({"ca_ground": False, "emergency": False, **r}.get(c) for c in names) for r in own], schema)
    whole = [tuple(r) for r in state.track(make(rows), ["seq"], 3, 10_000 * MS).orderBy("seq").collect()]
    first = state.followed(make(rows[:90]), ["seq"], 3, 10_000 * MS)
    kept, seeds = state.tail(first, ["seq"], 3), state.confirmed_values(first, ["seq"])
    second = state.followed(make(rows[90:]).unionByName(kept.select(names)), ["seq"], 3, 10_000 * MS, seeds)
    found = [tuple(r) for r in state.fixes(second, ["seq"]).where("seq >= 90").orderBy("seq").collect()]
    assert found == [r for r in whole if r[-1] >= 90] and len(found) > 10
    assert kept.count() <= 3 * 9


def test_surface_positions_need_a_reference(spark):
    rows = [{"ts_100ns": 0, "kind": "surface", "parity_bit": 0, "lat_cpr": 115609, "lon_cpr": 116941, "alt_ft": None}, {"ts_100ns": 1, **ODD}]
    assert fixes(spark, rows) == []
    (r,) = fixes(spark, rows, reference=(51.99, 4.375))
    assert (r.on_ground, r.alt) == (True, None) and abs(r.lat - 51.99) < 1


def test_seeds_and_metadata(spark):
    seed = spark.createDataFrame([(1, "SEED", None), (2, "OTHER", "1000")], "icao int, seed_call_sign string, seed_squawk string")
    rows = [{"ts_100ns": 0, **EVEN}, {"ts_100ns": 1, **ODD}, *[{"ts_100ns": 2 + k, "kind": "callsign", "call_sign": "KLM"} for k in range(3)], {"ts_100ns": 6, "kind": "squawk", "squawk": "7700", "emergency": True}, {"ts_100ns": 7, **EVEN}]
    found = fixes(spark, rows, seed=seed)
    assert [(r.call_sign, r.squawk) for r in found] == [("SEED", None), ("KLM", "7700")]


def test_restore_takes_the_latest_row_with_its_nulls(spark):
    rows = [("2024-01-01 00:00:00", "40058B", "A", "1"), ("2024-01-01 00:00:01", "40058B", None, "2"), ("2024-01-01 00:00:02", "40058B", "late", "3"), ("2024-01-01 00:00:00", "no hex", "x", "4")]
    table = spark.createDataFrame(rows, "t string, mode_s_code string, call_sign string, squawk string").withColumn("timestamp", F.col("t").cast("timestamp"))
    start, end = (F.lit(f"2024-01-01 00:00:0{k}").cast("timestamp") for k in (0, 2))
    assert [tuple(r) for r in downsample.restore(table, start, end).collect()] == [(0x40058B, None, "2")]


def test_counters(spark):
    rows = spark.range(10)
    assert metrics.audit(rows, {"deduped_dropped": F.col("id") < 3, "dropped_late": F.lit(None).cast("boolean")}).first().asDict() == {"deduped_dropped": 3, "dropped_late": 0}
    seen, counted = metrics.observed(rows, "test", {"positions_emitted": F.col("id") >= 5})
    seen.collect()
    assert counted.get == {"positions_emitted": 5}

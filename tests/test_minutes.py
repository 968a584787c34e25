import time
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyfold.functions.timeunits import PER_MINUTE, from_datetime
from skyfold.sources import wire
from skyfold.sources.files import parsed_minutes, read_minutes
from skyfold.sources.minutes import MISSING, TRAILING, MinuteReader, scan_minutes

NOON = datetime(2026, 6, 27, 12, 0, tzinfo=UTC)
FIRST = from_datetime(NOON) // PER_MINUTE
TEMPLATE = "%Y/%d/%H%M{sensor}.bin"
FRAME = bytes.fromhex("8D40058B58C901375147EFD09357")


def put(tmp_path, minute, sensor, n, over=b""):
    path = tmp_path / (NOON + timedelta(minutes=minute)).strftime(TEMPLATE.replace("{sensor}", sensor))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"".join(wire.encode_record(1000 * k + minute, FRAME, -50) for k in range(n)) + over)


@pytest.fixture
def folder(tmp_path):
    put(tmp_path, 0, "AB01", 7)
    put(tmp_path, 0, "AB02", 1, b"12345")
    put(tmp_path, 1, "AB02", 0)
    put(tmp_path, 12, "AB01", 5, b"x")
    return str(tmp_path)


def rows(df):
    return sorted(((r.file_minute // PER_MINUTE - FIRST, r.sensor_id, r.sensor_ordinal, r.record_index, r.problem, r.record and int.from_bytes(r.record[:4], "little")) for r in df.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"minutesPerTask": 1}, {"slices": 3}, {"minutesPerTask": 4, "slices": 10}])
def test_every_record_once_and_every_problem_told(spark, folder, options):
    found = rows(scan_minutes(spark, folder, TEMPLATE, FIRST, FIRST + 13, ["AB02", "AB01"], **options))
    records = [r for r in found if r[4] is None]
    expected = [(0, "AB01", 1, k, None, 1000 * k) for k in range(7)] + [(0, "AB02", 0, 0, None, 0)] + [(12, "AB01", 1, k, None, 1000 * k + 12) for k in range(5)]
    assert records == sorted(expected, key=str)
    assert [r[:2] for r in found if r[4] == TRAILING] == [(0, "AB02"), (12, "AB01")]
    assert len([r for r in found if r[4] == MISSING]) == 13 * 2 - 4


def test_conditions_reach_the_scan(spark, folder):
    span = (spark, folder, TEMPLATE, FIRST, FIRST + 13, ["AB01", "AB02"])
    whole = rows(scan_minutes(*span))
    at = F.col("file_minute")
    for condition, minutes, sensors in (
        (F.col("sensor_id") == "AB02", range(13), {"AB02"}),
        (F.col("sensor_id").isin("AB01", "ZZ99"), range(13), {"AB01"}),
        ((at >= (FIRST + 2) * PER_MINUTE) & (at < (FIRST + 4) * PER_MINUTE + 1), range(2, 5), {"AB01", "AB02"}),
        ((at > (FIRST + 10) * PER_MINUTE - 1) & (at <= (FIRST + 12) * PER_MINUTE), range(10, 13), {"AB01", "AB02"}),
        (at == (FIRST + 12) * PER_MINUTE, [12], {"AB01", "AB02"}),
        (at == (FIRST + 12) * PER_MINUTE + 5, [], set()),
    ):
        kept = scan_minutes(*span, narrowed=True, minutesPerTask=1).where(condition)
        assert rows(kept) == [r for r in whole if r[0] in minutes and r[1] in sensors]
        assert kept.rdd.getNumPartitions() <= max(1, len(minutes))


def test_a_year_is_planned_without_a_look_at_files():
    began = time.monotonic()
    reader = MinuteReader({"folder": "/nowhere", "template": "%Y%m%d%H%M{sensor}", "sensors": ",".join(f"AB{k:02d}" for k in range(50)), "first": str(FIRST), "end": str(FIRST + 365 * 1440)})
    found = reader.partitions()
    assert time.monotonic() - began < 2 and len(found) == 52_560 and (found[0].first, found[-1].end) == (FIRST, FIRST + 365 * 1440)


def test_events_of_a_span(spark, folder):
    found = read_minutes(spark, folder, TEMPLATE, [NOON + timedelta(minutes=k) for k in range(13)], ["AB01", "AB02"])
    own = found.where("problem is null").orderBy("file_minute", "ts_100ns", "sensor_ordinal").collect()
    assert [r.ts_100ns - r.file_minute for r in own] == [0, 0, *range(1000, 7000, 1000), *range(12, 5012, 1000)]
    assert all(bytes(r.frame) == FRAME and r.frame_reject is None and r.rssi_dbm == -50 for r in own)
    bad = parsed_minutes(scan_minutes(spark, folder, TEMPLATE, FIRST + 1, FIRST + 2, ["AB01", "AB02"])).collect()
    assert [(r.problem, r.frame_reject, r.frame) for r in bad] == [(MISSING, None, None)]


def test_other_failures_end_the_job(spark, tmp_path):
    (tmp_path / "202606271200AB01.bin").mkdir()
    with pytest.raises(Exception, match="AB01"):
        scan_minutes(spark, str(tmp_path), "%Y%m%d%H%M{sensor}.bin", FIRST, FIRST + 1, ["AB01"]).collect()

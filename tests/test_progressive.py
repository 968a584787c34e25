import glob
import os
from dataclasses import replace

import pytest

from skyfold.config import Config
from skyfold.plans import progressive
from skyfold.plans.recompute import recompute
from skyfold.sinks import table
from skyfold.sources import wire
from test_jobs import NOON
from test_stateful import drawn, rows

SENSORS = ("AB01", "AB02", "AB03")
MINUTE = 600_000_000


@pytest.fixture
def cfg(tmp_path):
    """Six minutes, one of them without any frame, and the one before the first; times are ten times as far apart."""
    for sensor in SENSORS:
        for m in range(-1, 6):
            own = [(at * 10, f) for s, at, f in drawn(21, 620) if s == sensor and (at * 10) // MINUTE == m + 1 and m != 3]
            name = NOON.replace(hour=11, minute=59) if m < 0 else NOON.replace(minute=m)
            (tmp_path / f"{name:%Y%m%d%H%M}{sensor}.spkx").write_bytes(b"".join(wire.encode_record(at % MINUTE, f, -50) for at, f in own))
    return Config(SENSORS, debounce=2, ttl_ms=2000, data_dir=str(tmp_path), start=NOON, end=NOON.replace(minute=6), table=str(tmp_path / "whole")).validated("recompute")


def test_stretches_write_what_one_run_writes_and_go_on_after_a_failure(spark, cfg, tmp_path, monkeypatch):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    counted = recompute(spark, cfg)
    expected = rows(spark, cfg.table)
    assert len({r[0].minute for r in expected}) == 5 and counted["deduped_dropped"] > 10
    own = replace(cfg, table=str(tmp_path / "own"))
    written, write = [], table.replace_minutes

    def failing(new, path, first, end):
        if len(written) == 2:
            written.append("failed")
            raise OSError("down")
        written.append((first, end))
        write(new, path, first, end)

    monkeypatch.setattr(table, "replace_minutes", failing)
    with pytest.raises(OSError, match="down"):
        progressive.recompute_progressive(spark, own, 2)
    start = written[0][0]
    done = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{own.table}/minute=*/*.parquet")}
    ledger = progressive.load(spark, f"{own.table}-progress", start)
    assert 0 < ledger.written - start < 6 and done
    progressive.recompute_progressive(spark, own, 2)
    assert rows(spark, own.table) == expected
    assert {p: os.stat(p).st_mtime_ns for p in done} == done  # finished minutes were not written again
    spans = [w for w in written if w != "failed"]
    assert [a for a, _ in spans] == [start, *[b for _, b in spans[:-1]]] and spans[-1][1] == start + 6
    assert len(os.listdir(f"{own.table}-progress")) <= 3  # the ledger, its checksum, the last stretch
    before = len(written)
    progressive.recompute_progressive(spark, own, 2)
    assert len(written) == before

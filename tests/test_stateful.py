"""The stream against the batch job on the same frames, however the input is cut, and what its state keeps."""

import os
import random

import pytest
from pyspark.sql import Row

from skyfold.config import Config
from skyfold.functions.timeunits import from_datetime
from skyfold.metrics import Totals
from skyfold.operators import views
from skyfold.plans.recompute import recompute
from skyfold.sources import wire
from skyfold.streaming import stateful
from skyfold.streaming.realtime import start
from test_jobs import EVEN, NOON, ODD, stamped


def remainder(data: bytes) -> int:
    """What a frame's bits leave when they are divided by the parity generator."""
    left = int.from_bytes(data, "big") << 24
    for bit in range(8 * len(data) + 23, 23, -1):
        if left >> bit & 1:
            left ^= 0x1FFF409 << (bit - 24)
    return left


def sealed(data: bytes, over: int = 0) -> bytes:
    return data + (remainder(data) ^ over).to_bytes(3, "big")


def position(icao: int, odd: int, shift: int) -> bytes:
    """A position of one parity, the last bits of its longitude moved."""
    own = bytearray((ODD if odd else EVEN)[:11])
    own[1:4] = icao.to_bytes(3, "big")
    own[10] ^= shift % 8
    return sealed(bytes(own))


def name(icao: int, letter: int) -> bytes:
    text = (4 << 51) + sum((letter if k < 3 else 32) << (42 - 6 * k) for k in range(8))
    return sealed(b"\x8d" + icao.to_bytes(3, "big") + text.to_bytes(7, "big"))


def identity(icao: int, code: int) -> bytes:
    return sealed(bytes([5 << 3, 0, code >> 8, code & 255]), icao)


def test_frames_are_sealed_as_known_ones_are():
    assert sealed(EVEN[:11]) == EVEN and sealed(ODD[:11]) == ODD


def drawn(seed: int, n: int = 130) -> list[tuple[str, int, bytes]]:
    """(sensor, 100 ns after noon, frame), times rising; frames come again from other sensors a little later."""
    draw = random.Random(seed)
    at, found = 0, []
    for _ in range(n):
        at += draw.choice([1, 2, 15, 45, 120, 300]) * 10_000 + draw.randrange(10_000)
        icao = 0x400000 + draw.randrange(3)
        kind = draw.random()
        frame = position(icao, draw.randrange(2), draw.randrange(3)) if kind < 0.7 else name(icao, draw.choice([1, 2])) if kind < 0.85 else identity(icao, draw.choice([0x0808, 0x0A2A]))
        if found and draw.random() < 0.35:
            frame = found[-1][2]
        if draw.random() < 0.05:
            frame = frame[:-1] + bytes([frame[-1] ^ 7])
        found.append((draw.choice(["AB01", "AB02", "AB03"]), at, frame))
    return found


def rows(spark, path):
    return sorted((r[0], r[1], round(r[2], 9), round(r[3], 9), *r[4:]) for r in spark.read.parquet(path).select(*views.COLUMNS).collect())


def messages(events):
    """Events of one sensor running, three at most, as one message each."""
    found = []
    for sensor, at, frame in events:
        if found and found[-1][0] == sensor and len(found[-1][1]) < 3:
            found[-1][1].append((at, frame))
        else:
            found.append((sensor, [(at, frame)]))
    return [wire.encode_message(s, "20260627120000", b"".join(wire.encode_record(at, f, -50) for at, f in own)) for s, own in found]


def test_stream_equals_batch_however_it_is_cut(spark, tmp_path):
    events = drawn(11)
    sensors = ("AB01", "AB02", "AB03")
    for s in sensors:
        (tmp_path / f"202606271200{s}.spkx").write_bytes(b"".join(wire.encode_record(at, f, -50) for x, at, f in events if x == s))
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    batch = Config(sensors, debounce=2, data_dir=str(tmp_path), start=NOON, end=NOON.replace(minute=1), table=str(tmp_path / "table")).validated("recompute")
    counted = recompute(spark, batch)
    expected = rows(spark, batch.table)
    assert len(expected) > 15 and counted["deduped_dropped"] > 15 and counted["rejected_crc"] > 2
    assert {r[5] for r in expected} >= {None, "AAA"} and len({r[6] for r in expected}) > 1
    sent = messages(events)
    for label, parts in (("one", [(len(sent), 1000)]), ("cut", [(len(sent) // 3, 9), (len(sent), 1000)])):
        folder = tmp_path / label
        folder.mkdir()
        cfg = Config(sensors, debounce=2, messages=str(folder), table=str(tmp_path / f"{label}-table")).validated("realtime")
        at, totals = 0, Totals()
        for end, most in parts:
            for k in range(at, end):
                (folder / f"{k:04d}.msg").write_bytes(sent[k])
                stamped(folder / f"{k:04d}.msg", k)
            at = end
            query = start(spark, cfg, str(tmp_path / f"{label}-offsets"), available_now=True, totals=totals, most_files=most, ends=end == len(sent))
            query.awaitTermination()
        assert rows(spark, cfg.table) == expected
        # each block came once: what was written is what there is
        assert totals["db_upserts"] == totals["positions_emitted"] == len(expected)
        assert all(totals[c] == counted[c] for c in ("deduped_dropped", "rejected_crc", "dropped_late", "unsupported_df"))
        # every frame has expired by the end of the last block, and no block is open
        (*_, last) = query.second.recentProgress
        totals_of = [o["numRowsTotal"] for o in last["stateOperators"]]
        assert totals_of[0] == 0 and last["stateOperators"][0]["operatorName"] == "stateStoreSave"
        states = spark.read.format("statestore").option("path", f"{tmp_path}/{label}-offsets/blocks").option("operatorId", 0).option("stateVarName", "expiry").load() if totals_of[-1] else None
        assert states is None or all(r.value.at_100ns > from_datetime(NOON) for r in states.collect())


class Value:
    """A state variable in memory."""

    def __init__(self):
        self.own = None

    def exists(self):
        return self.own is not None

    def get(self):
        return self.own

    def update(self, value):
        self.own = value

    def clear(self):
        self.own = None


class Handle:
    def __init__(self):
        self.timers, self.value, self.map = [], Value(), {}

    def getValueState(self, *_):
        return self.value

    def getMapState(self, *_):
        handle = self

        class Map:
            containsKey = staticmethod(lambda key: key in handle.map)
            getValue = staticmethod(lambda key: handle.map[key])
            updateValue = staticmethod(lambda key, value: handle.map.__setitem__(key, value))

        return Map()

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def offered(own, batch, *events):
    """(time, confirmed before) each, handed over in a wrong order."""
    made = [Row(batch=batch, seq=f"{k}", record_index=0, ts_100ns=t, confirmed_before=c) for k, (t, c) in enumerate(events)]
    return [r.accepted for r in own.handleInputRows(("f",), reversed(made), None)]


def test_a_frame_is_forgotten_at_its_expiry_and_not_before():
    own, handle = stateful.FirstCome(500_000), Handle()
    own.init(handle)
    assert offered(own, 0, (1_000_000, None), (1_300_000, 1_000_000), (1_500_001, 1_499_999)) == [True, False, False]
    assert handle.timers == [150] and handle.value.get() == (1_500_000,)
    assert offered(own, 1, (1_600_001, 1_500_000)) == [True]
    assert handle.timers == [211]  # rounded up
    list(own.handleExpiredTimer(("f",), None, None))
    assert not handle.value.exists()


def test_an_aircraft_goes_on_from_what_was_known():
    own, handle = stateful.Aircraft(2, 10, surface=True), Handle()
    own.init(handle)
    own.handleInitialState((1,), Row(icao=1, seed_call_sign="OLD", seed_squawk=None), None)

    def see(batch, *told):
        blank = dict.fromkeys(("parity_bit", "lat_cpr", "lon_cpr", "alt_ft", "ca_ground", "call_sign", "squawk", "emergency"))
        made = [Row(**(blank | {"icao": 1, "batch": batch, "seq": "", "record_index": k, "kind": kind, "ts_100ns": ts} | more)) for k, (kind, ts, more) in enumerate(told)]
        return [(r.kind, r.other_lat, r.alt, r.call_sign, r.squawk, r.on_ground) for r in own.handleInputRows((1,), reversed(made), None)]

    def at(parity):
        return {"parity_bit": parity, "lat_cpr": 70 + parity, "lon_cpr": 0}

    assert see(0, ("airborne", 100, at(0)), ("callsign", 101, {"call_sign": "NEW"}), ("airborne", 110, at(1)), ("squawk", 111, {"squawk": "7700", "emergency": True})) == [("airborne", 70, None, "OLD", None, False)]
    assert see(1, ("altitude", 112, {"alt_ft": 900}), ("callsign", 113, {"call_sign": "NEW"}), ("airborne", 119, at(0)), ("altitude", 119, {}), ("airborne", 130, at(1)), ("surface", 131, {})) == [
        ("airborne", 71, 900, "NEW", "7700", False),
        ("surface", None, None, "NEW", "7700", True),
    ]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_runs_say_what_histories_say(n):
    from sequential import debounced

    draw = random.Random(n)
    values = [draw.choice("abc") for _ in range(400)]
    told, found = (None, None, 0), []
    for v in values:
        told = stateful.observed(told, v, n, v == "c")
        found.append(told[0])
    assert found == debounced(values, n, {"c"})


def test_order_is_that_of_arrival_not_of_names(spark, tmp_path):
    """Two writers whose names sort against time: the earlier message comes first."""
    folder = tmp_path / "m"
    folder.mkdir()
    for file, second, at in (("z.msg", 1, 10_000), ("a.msg", 2, 9_000_000)):
        (folder / file).write_bytes(wire.encode_message("AB01", "20260627120000", wire.encode_record(at, EVEN if at == 10_000 else ODD, -50)))
        stamped(folder / file, second)
    os.sync()
    totals = Totals()
    cfg = Config(("AB01",), messages=str(folder), table=str(tmp_path / "t")).validated("realtime")
    start(spark, cfg, str(tmp_path / "o"), available_now=True, totals=totals, ends=True).awaitTermination()
    assert totals["dropped_late"] == 0 and totals["positions_emitted"] == 1

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from skyfold.functions import cpr, geo, modes, timeunits
from skyfold.sources import wire

EVEN, ODD = "8D40058B58C901375147EFD09357", "8D40058B58C904A87F402D3B8C59"
MOST, LEAST = (1 << 63) - 1, -(1 << 63)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def decoded(spark, *frames):
    rows = spark.createDataFrame([(k, bytearray.fromhex(f) if f is not None else None) for k, f in enumerate(frames)], "k int, frame binary")
    return {r.k: r for r in modes.decode(rows).collect()}


# time


def test_saturation(spark):
    lit = lambda n: F.lit(n).cast("long")
    add = [timeunits.saturating_add(lit(a), lit(b)) for a, b in ((MOST, 1), (LEAST, -1), (5, 6), (MOST, -1))]
    assert one(spark, *add) == (MOST, LEAST, 11, MOST - 1)
    sub = [timeunits.saturating_sub(lit(a), lit(b)) for a, b in ((LEAST, 1), (MOST, -1), (5, 6))]
    assert one(spark, *sub) == (LEAST, MOST, -1)
    assert one(spark, timeunits.abs_delta(lit(MOST), lit(LEAST)), timeunits.abs_delta(lit(3), lit(10))) == (MOST, 7)


def test_driver_times():
    assert timeunits.from_ms(50) == 500_000
    assert timeunits.from_datetime(datetime(1970, 1, 1, 0, 0, 1, 5, tzinfo=UTC)) == 10_000_050
    assert timeunits.to_datetime(10_000_000_000_000_005) == datetime(2001, 9, 9, 1, 46, 40, tzinfo=UTC)
    assert timeunits.to_datetime(MOST) == datetime(1970, 1, 1, tzinfo=UTC)


def test_blocks_floor(spark):
    ts = [F.lit(x).cast("long") for x in (13_456_789, -5, 10_000_000)]
    assert one(spark, *[timeunits.floor_to(t, 10_000_000) for t in ts]) == (10_000_000, -10_000_000, 10_000_000)
    assert one(spark, *[timeunits.block_id(t, 10_000_000) for t in ts]) == (1, -1, 1)
    at = F.lit(timeunits.from_datetime(datetime(2026, 6, 27, 12, 3, 4, tzinfo=UTC)))
    assert one(spark, timeunits.minute_label(at), timeunits.minute_key(at)) == ("202606271203", 29709363)


# wire


def record(spark, body: bytes, minute: int = 0):
    rows = spark.createDataFrame([(bytearray(body), minute)], "body binary, minute_100ns long")
    return wire.parsed(wire.records(rows)).orderBy("record_index").collect()


def test_record(spark):
    (r,) = record(spark, wire.encode_record(123_456, bytes.fromhex(EVEN), -50), 600_000_000)
    assert (r.ts_100ns, r.rssi_dbm, r.frame.hex().upper(), r.frame_reject) == (600_123_456, -50, EVEN, None)


def test_short_frames(spark):
    clean = bytes([0x28]) + bytes(6)
    r = record(spark, wire.encode_record(0, clean, 0) + wire.encode_record(1, clean + b"\0\0\1", 0) + b"rest")
    assert [x.frame_reject for x in r] == [None, "malformed_short_frame"]
    assert (len(r[0].frame), r[1].frame, r[1].record_index) == (7, None, 1)


def test_long_frames_keep_their_zeros(spark):
    (r,) = record(spark, wire.encode_record(0, bytes([0x88]) + bytes(13), 0))
    assert len(r.frame) == 14


def test_offset_is_not_bounded(spark):
    (r,) = record(spark, (0xFFFFFFFF).to_bytes(4, "little") + bytes(16))
    assert r.ts_100ns == 0xFFFFFFFF


def test_bodies_without_a_record(spark):
    assert record(spark, b"") == [] and record(spark, b"short") == []


@pytest.mark.parametrize(("value", "dbm"), [(52735, -50), (65535, 0), (0, -255), (65534, 0), (65279, -1)])
def test_signal(spark, value, dbm):
    assert one(spark, wire.signal_dbm(F.lit(value).cast("long"))) == (dbm,)


def test_signal_round_trip(spark):
    assert all(one(spark, wire.signal_dbm(F.lit(wire.encode_signal(d)).cast("long"))) == (d,) for d in (0, -1, -50, -255))


def test_headers(spark):
    texts = ["AB0120260627120059rest", "AB01202606", "ab0120260627120000", "AB0120261327120000", "AB0120260230120000", "AB0120260627120060", "AB01+0260627120000", "ab0120261327120000", None]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").withColumn("content", F.col("t").cast("binary"))
    found = {r.k: r for r in wire.with_header(rows).collect()}
    assert [found[k].header_reject for k in range(len(texts))] == [None, "bad_length", "bad_sensor_id", "bad_timestamp", "bad_timestamp", "bad_timestamp", "bad_timestamp", "bad_sensor_id", "bad_length"]
    assert found[0].minute_100ns == timeunits.from_datetime(datetime(2026, 6, 27, 12, 0, tzinfo=UTC))
    assert bytes(found[0].body) == b"rest"


# frames


def test_airborne(spark):
    r = decoded(spark, "8D40621D58C382D690C8AC2863A7")[0]
    assert (r.kind, r.icao, r.parity_bit, r.lat_cpr, r.lon_cpr, r.alt_ft, r.ca_ground, r.reject_reason) == ("airborne", 0x40621D, 0, 93000, 51372, 38000, False, None)


def test_call_sign(spark):
    r = decoded(spark, "8D4840D6202CC371C32CE0576098")[0]
    assert (r.kind, r.icao, r.call_sign) == ("callsign", 0x4840D6, "KLM1023")


def test_rejects(spark):
    r = decoded(spark, "8D40621D58C382D690C8AC2863A0", "58" + "00" * 6, None, "8D4062", "5D" + "00" * 13)
    assert [r[k].reject_reason for k in range(5)] == ["crc_invalid", "unsupported_df", "parse_error", "parse_error", "parse_error"]
    assert all(x.kind is None and x.icao is None for x in r.values())


def checked(spark, data: str, over: int) -> str:
    """A frame of some data whose parity hides `over`."""
    zero = bytearray.fromhex(data + "000000")
    rest = spark.createDataFrame([(zero,)], "frame binary").select(modes.parity(F.col("frame")).alias("p")).first().p
    return f"{data}{rest ^ over:06X}"


def test_replies_carry_the_address_in_their_parity(spark):
    frames = [checked(spark, "28000000", 0xABCDEF), checked(spark, "20000000", 0xABCDEF), checked(spark, "A8" + "00" * 10, 0x123456), checked(spark, "A0" + "00" * 10, 0x123456)]
    r = decoded(spark, *frames)
    assert [(r[k].kind, r[k].icao) for k in range(4)] == [("squawk", 0xABCDEF), ("altitude", 0xABCDEF), ("squawk", 0x123456), ("altitude", 0x123456)]
    assert r[0].squawk == "0000" and r[1].alt_ft is None


@pytest.mark.parametrize(("id13", "code", "emergency"), [(0b0101010101010 | 0, None, None), (0, "0000", False)])
def test_squawk_bits(spark, id13, code, emergency):
    r = decoded(spark, checked(spark, f"2800{id13:04X}", 1))[0]
    if code is not None:
        assert (r.squawk, r.emergency) == (code, emergency)
    else:
        assert len(r.squawk) == 4 and set(r.squawk) <= set("01234567")


def test_emergencies(spark):
    def ident(code):  # C1 A1 C2 A2 C4 A4 0 B1 D1 B2 D2 B4 D4
        a, b, c, d = map(int, code)
        pulses = [c & 1, a & 1, c >> 1 & 1, a >> 1 & 1, c >> 2, a >> 2, 0, b & 1, d & 1, b >> 1 & 1, d >> 1 & 1, b >> 2, d >> 2]
        return int("".join(map(str, pulses)), 2)

    codes = ["7500", "7600", "7700", "1200", "0363"]
    r = decoded(spark, *[checked(spark, f"2800{ident(c):04X}", 1) for c in codes])
    assert [(r[k].squawk, r[k].emergency) for k in range(5)] == [("7500", True), ("7600", True), ("7700", True), ("1200", False), ("0363", False)]


def test_gillham_altitudes(spark):
    """Every code of the 100 ft sequence against a plain decoder of the published rule."""

    def plain(code):
        bit = lambda p: code >> p & 1
        gray = int("".join(str(bit(p)) for p in (2, 0, 11, 9, 7, 5, 3, 1)), 2)
        five = 0
        while gray:
            five, gray = five ^ gray, gray >> 1
        order = {0b001: 0, 0b011: 1, 0b010: 2, 0b110: 3, 0b100: 4}
        c = bit(12) << 2 | bit(10) << 1 | bit(8)
        if c not in order or bit(4):
            return None
        step = order[c] if five % 2 == 0 else 4 - order[c]
        feet = five * 500 + (step + 1) * 100 - 1300
        return feet if feet >= -1200 else None

    codes = [c for c in range(1, 8192) if not c >> 6 & 1 and not c >> 4 & 1]
    rows = spark.createDataFrame([(c,) for c in codes], "code long")
    found = {r.code: r.feet for r in modes.with_altitude(rows, "code", "feet").collect()}
    assert found == {c: plain(c) for c in codes}


def test_ground_flag(spark):
    r = decoded(spark, checked(spark, "8C40058B58C901375147EF", 0), checked(spark, "9440058B58C901375147EF", 0))
    assert r[0].ca_ground and not r[1].ca_ground and r[1].kind == "airborne"


# positions


def pair(spark, first, last):
    r = decoded(spark, first, last)
    cpr_of = [F.lit(x) for x in (r[0].lat_cpr, r[0].lon_cpr, r[1].lat_cpr, r[1].lon_cpr, r[1].parity_bit)]
    return one(spark, *cpr.global_airborne(*cpr_of))


def test_global_position(spark):
    lat, lon = pair(spark, EVEN, ODD)
    assert (lat, lon) == pytest.approx((49.81755, 6.08442), abs=1e-3)
    back = pair(spark, ODD, EVEN)
    assert back == pytest.approx((49.82410, 6.06785), abs=1e-3)


def test_surface_position(spark):
    """Encoded around a reference, and found again."""
    lat, lon, scale = 52.3208, 4.7347, 131072
    for odd in (0, 1):
        d_lat = 90 / (60 - odd)
        y = int(scale * (lat % d_lat) / d_lat + 0.5) % scale
        nl = one(spark, cpr.zones(F.lit(lat)))[0]
        d_lon = 90 / max(nl - odd, 1)
        x = int(scale * (lon % d_lon) / d_lon + 0.5) % scale
        found = one(spark, *cpr.local_surface(F.lit(y), F.lit(x), F.lit(odd), 51.99, 4.375))
        assert found == pytest.approx((lat, lon), abs=1e-3)


def test_zones(spark):
    lats = [0.0, 10.0, 10.47, 10.48, 52.0, 86.9, 87.0, 88.0, -52.0]
    assert one(spark, *[cpr.zones(F.lit(x)) for x in lats]) == (59, 59, 59, 58, 36, 2, 2, 1, 36)


def test_identifiers_and_labels(spark):
    assert one(spark, geo.icao_hex(F.lit(0x40058B)), geo.icao_hex(F.lit(10))) == ("40058B", "00000A")
    assert one(spark, *[geo.icao_number(F.lit(x)) for x in ("40058B", "xyz", "", "+1F", "123456789")]) == (0x40058B, None, None, 31, None)
    null = F.lit(None)
    assert one(spark, geo.label(F.lit("40058B"), F.lit("KLM1 "), F.lit(100)), geo.label(F.lit("40058B"), null.cast("string"), null.cast("int"))) == ("40058B / KLM1\nalt=100", "40058B\nalt=-")
    x, y = one(spark, *geo.web_mercator(F.lit(49.81755), F.lit(6.08442)))
    assert (x, y) == pytest.approx((677314.5, 6410797.0), rel=1e-3)

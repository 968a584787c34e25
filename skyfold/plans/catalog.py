"""Query catalogue: the engine's operators over the driver's tables.

Those tables have no radio frames, so `events` stands for the stream: user_id for the aircraft, event_type for
the sensor or the value to debounce, (event_type, props) for the bits of a frame, event_id for arrival. Spans are
hours where radio traffic has milliseconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold import metrics
from skyfold.functions import cpr, geo, modes
from skyfold.functions.timeunits import floor_to, minute_key, minute_label, of_timestamp
from skyfold.operators import downsample, state, views, watermark
from skyfold.operators.asof import asof_join
from skyfold.plans import oracles
from skyfold.plans.oracles import BLOCK, HOUR, PAIR, QUANTUM, SENSORS, TIMEOUT, TTL
from skyfold.scratch import cut
from skyfold.sinks import table
from skyfold.sources import wire

DAY = 24 * HOUR
#: 2024-01-01T00:00Z, when events begin.
BEGIN = 17_041_536_000_000_000
Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(F.col("event_id").alias("seq"), of_timestamp(F.col("ts")).alias("ts_100ns"), F.col("event_type").alias("sensor_id"), F.col("user_id").cast("int").alias("icao"), F.concat_ws("|", "event_type", "props").alias("frame"), F.col("value").alias("v"))


def _marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark.watermarks(_stream(spark, sf_dir), list(SENSORS), TIMEOUT, floor_to(F.col("ts_100ns"), DAY), ["seq"], in_time_order=True)


def _confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark.confirm_chain(_marks(spark, sf_dir), QUANTUM, DAY)


def ev_late_and_watermark(spark, sf_dir):
    return _marks(spark, sf_dir).select("seq", "wm_before", "wm_after", "late")


def _unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream with times moved by up to 9 hours either way, so that it arrives out of their order."""
    return _stream(spark, sf_dir).withColumn("ts_100ns", F.col("ts_100ns") + ((F.col("seq") * 7919) % 19 - 9) * HOUR)


def ev_late_unordered(spark, sf_dir):
    bucket = F.expr("seq div 2000")
    return watermark.watermarks(_unordered(spark, sf_dir), list(SENSORS), TIMEOUT, bucket, ["seq"]).select("seq", "wm_before", "wm_after", "late")


def ev_admitted_unordered(spark, sf_dir):
    marks = watermark.watermarks(_unordered(spark, sf_dir), list(SENSORS), TIMEOUT, F.expr("seq div 2000"), ["seq"])
    chained = watermark.confirm_chain(marks.where("not late"), QUANTUM, DAY)
    return watermark.anchored(chained, "frame", ["seq"], "confirmed_before", "ts_100ns", TTL).select("seq", "confirmed_before", "confirmed_after", "accepted")


def ev_confirm_timeline(spark, sf_dir):
    return _confirmed(spark, sf_dir).select("seq", "confirmed_before", "confirmed_after")


def ev_ttl_dedup_anchor(spark, sf_dir):
    own = _stream(spark, sf_dir).withColumn("clock", F.col("ts_100ns"))
    return watermark.anchored(own, "frame", ["seq"], "clock", "ts_100ns", TTL).select("seq", "accepted")


def ev_ttl_dedup_confirmed(spark, sf_dir):
    return watermark.anchored(_confirmed(spark, sf_dir), "frame", ["seq"], "confirmed_before", "ts_100ns", TTL).select("seq", "accepted")


def ev_nstrike(spark, sf_dir):
    return state.debounce(_stream(spark, sf_dir), "icao", ["seq"], "sensor_id", 3, "known").select("seq", "known")


def ev_nstrike_emergency(spark, sf_dir):
    return state.debounce(_stream(spark, sf_dir), "icao", ["seq"], "sensor_id", 3, "known", force=F.col("sensor_id") == "error").select("seq", "known")


def ev_nstrike_seeded(spark, sf_dir):
    seed = spark.read.parquet(f"{sf_dir}/events.parquet").where("user_id % 2 = 0").select(F.col("user_id").cast("int").alias("icao")).distinct().withColumn("seed", F.lit("seed"))
    return state.debounce(state.with_seed(_stream(spark, sf_dir), "icao", seed), "icao", ["seq"], "sensor_id", 3, "known", seed="seed").select("seq", "known")


def _hot(own: DataFrame) -> DataFrame:
    """The stream with one aircraft on a third of its rows."""
    return own.withColumn("icao", F.when(F.col("seq") % 3 == 0, F.lit(0)).otherwise(F.col("icao")))


def ev_nstrike_split(spark, sf_dir):
    """Debouncing with an aircraft's rows in stretches, one aircraft on a third of all."""
    own = _hot(_stream(spark, sf_dir)).withColumn("stretch", F.expr("seq div 1000"))
    return state.debounce_split(own, "icao", "stretch", ["seq"], "sensor_id", 3, "known", force=F.col("sensor_id") == "error").select("seq", "known")


def ev_asof_join(spark, sf_dir):
    """The latest purchase or error of the same aircraft within half a day, one aircraft on a third of all rows."""
    own = _hot(_stream(spark, sf_dir)).select("seq", "icao", "ts_100ns", "sensor_id", "v")
    asked, told = (own.where(c) for c in (~F.col("sensor_id").isin("purchase", "error"), F.col("sensor_id").isin("purchase", "error")))
    found = asof_join(asked, told, ["icao"], "ts_100ns", DAY, within=PAIR, ties=["seq"])
    return found.select("seq", F.col("other.seq").alias("other_seq"), F.col("other.ts_100ns").alias("other_t"), F.col("other.v").alias("other_v"))


def _alt() -> Column:
    return F.when(F.col("sensor_id") == "view", F.round(F.col("v") * 100).cast("int"))


def ev_alt_lww_asof(spark, sf_dir):
    return _stream(spark, sf_dir).select("seq", state.last_known(_alt(), "icao", ["seq"]).alias("alt"))


def ev_pair_asof(spark, sf_dir):
    own = _stream(spark, sf_dir).withColumn("parity", F.col("seq") % 2)
    found = state.positions_before(own, "icao", ["seq"], "parity", "ts_100ns", ["v"])
    return found.select("seq", F.col("other.ts_100ns").alias("other_t"), state.paired(F.col("ts_100ns"), F.col("other.ts_100ns"), PAIR).alias("paired"))


def _fixes(own: DataFrame) -> DataFrame:
    own = own.withColumn("_call", F.when(F.col("sensor_id").isin("click", "view", "signup"), F.col("sensor_id"))).withColumn("_squawk", F.when(F.col("sensor_id").isin("error", "purchase"), F.col("sensor_id")))
    own = state.debounce(own, "icao", ["seq"], "_call", 2, "call_sign")
    own = state.debounce(own, "icao", ["seq"], "_squawk", 2, "squawk", force=F.col("sensor_id") == "error")
    own = own.withColumn("alt", state.last_known(_alt(), "icao", ["seq"])).withColumn("parity", F.col("seq") % 2)
    own = state.positions_before(own, "icao", ["seq"], "parity", "ts_100ns", [])
    return own.where(state.paired(F.col("ts_100ns"), F.col("other.ts_100ns"), PAIR)).select("seq", "icao", "ts_100ns", "v", "alt", "call_sign", "squawk")


def ev_snapshot(spark, sf_dir):
    return _fixes(_stream(spark, sf_dir)).drop("v")


def ev_block_lww(spark, sf_dir):
    return downsample.last_of_block(_stream(spark, sf_dir).select("icao", "ts_100ns", "seq", "v"), "icao", "ts_100ns", BLOCK, ["seq"]).withColumnRenamed("ts_100ns", "block")


def ev_block_flush(spark, sf_dir):
    top = _marks(spark, sf_dir).agg(F.max("wm_after").alias("top"))  # one row
    blocks = downsample.last_of_block(_stream(spark, sf_dir).select("icao", "ts_100ns", "seq"), "icao", "ts_100ns", BLOCK, ["seq"])
    return blocks.join(F.broadcast(top), downsample.ended(F.col("ts_100ns"), BLOCK, F.col("top"))).drop("top").withColumnRenamed("ts_100ns", "block")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    code, kind, n = F.col("user_id"), F.col("event_type"), F.col("event_id")
    return _events(spark, sf_dir).select(
        F.col("ts").alias("timestamp"),
        geo.icao_hex(code + 4194304).alias("mode_s_code"),
        F.when(n % 17 != 0, code * 7 % 120 - 60 + F.col("value") / 100).alias("lat"),
        (code * 13 % 300 - 150 + F.col("value") / 50).alias("lon"),
        F.when(n % 5 != 0, F.round(F.col("value") * 100).cast("int")).alias("alt"),
        F.when(kind == "click", F.concat(F.lit("C"), code % 40, F.lit("-"), n % 3)).when(kind == "view", F.lit("  ")).alias("call_sign"),
        F.when(kind == "error", F.lit("7700")).alias("squawk"),
        (kind == "signup").alias("on_ground"),
        "event_id",
    )


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).where(views.predicates())


def ev_restore_distinct_on(spark, sf_dir):
    start, end = (F.lit(f"2024-01-{d}").cast("timestamp_ntz") for d in ("05", "20"))
    found = downsample.restore(_points(spark, sf_dir), start, end)
    return found.select(F.col("icao").cast("long").alias("icao"), F.col("seed_call_sign").alias("call_sign"), F.col("seed_squawk").alias("squawk"))


def ev_upsert_merge(spark, sf_dir):
    own = _stream(spark, sf_dir).select("seq", "icao", floor_to(F.col("ts_100ns"), BLOCK).alias("block"), "v")
    old = own.where("seq % 3 <> 0").groupBy("icao", "block").agg(F.max_by("v", "seq").alias("v"))
    new = own.where("seq % 3 = 0").withColumn("v", F.when(F.col("seq") % 2 == 0, F.col("v")))
    return table.merged(old, new, ("icao", "block"), F.col("seq"))


def ev_minute_replace(spark, sf_dir):
    own = _events(spark, sf_dir).select("event_id", minute_key(of_timestamp(F.col("ts"))).alias("minute"))
    span = (28401120 + 1440 * 5, 28401120 + 1440 * 9)
    new = own.where("event_id % 2 = 0").where((F.col("minute") >= span[0]) & (F.col("minute") < span[1]))
    return table.replaced(own.where("event_id % 3 <> 0"), new, span, F.col("minute"))


def ev_minute_bucket_counts(spark, sf_dir):
    own = _events(spark, sf_dir).withColumn("t", of_timestamp(F.col("ts")))
    return own.groupBy(minute_key(F.col("t")).alias("minute"), minute_label(F.col("t")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def ev_view_filter(spark, sf_dir):
    span = [F.lit(f"2024-01-{d}").cast("timestamp_ntz") for d in ("03", "25")]
    return views.select_points(_points(spark, sf_dir), limit=500, start=span[0], end=span[1], on_ground=False)


def ev_view_named(spark, sf_dir):
    """Points of some codes and call signs."""
    return views.select_points(_points(spark, sf_dir), codes=[f"{4194304 + k:06X}" for k in range(30)], call_signs=["C1-0", "C2-1", "C3-2", "C12-0"])


def ev_view_totals(spark, sf_dir):
    return views.totals(_placed(spark, sf_dir))


def ev_view_summary(spark, sf_dir):
    return views.per_aircraft(_placed(spark, sf_dir))


def ev_last_point(spark, sf_dir):
    return views.last_points(_placed(spark, sf_dir)).select("mode_s_code", "timestamp", "lat", "alt", "label")


def ev_trajectory(spark, sf_dir):
    own = _placed(spark, sf_dir).groupBy("mode_s_code").agg(F.array_sort(F.collect_list(F.unix_micros(F.col("timestamp").cast("timestamp")))).alias("line"))
    return own.where(F.size("line") >= 2).select("mode_s_code", F.size("line").cast("long").alias("n_points"), F.array_join(F.col("line").cast("array<string>"), " ").alias("line"))


def ev_trajectory_line(spark, sf_dir):
    return views.trajectories(_placed(spark, sf_dir))


def ev_webmercator(spark, sf_dir):
    x, y = geo.web_mercator(F.col("lat"), F.col("lon"))
    return _placed(spark, sf_dir).select("event_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


def ev_reject_counts(spark, sf_dir):
    flags = {"dropped_late": F.col("late"), "parse_error": F.col("sensor_id") == "error", "unknown_sensor": F.col("icao") % 5 == 0, "positions_emitted": F.lit(True)}
    return metrics.audit(_marks(spark, sf_dir), flags)


def signal_dbm(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", wire.signal_dbm(F.col("event_id") * 257 % 65536).alias("dbm"))


def _byte(k: int) -> Column:
    return (F.col("event_id") * (31 + 7 * k) + (13 * k * k + 17)) % 256


def _binary(values: list[Column]) -> Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(v), 2, "0") for v in values]))


def wire_header(spark, sf_dir):
    n = F.col("event_id")
    sensor = F.when(n % 7 == 0, F.lit("ab01")).otherwise(F.lit("AB01"))
    moment = F.when(n % 5 == 0, F.lit("20241301120000")).otherwise(F.date_format("ts", "yyyyMMddHHmmss"))
    text = F.when(n % 11 == 0, F.lit("AB0120240101")).otherwise(F.concat(sensor, moment, F.lit("body")))
    return wire.with_header(_events(spark, sf_dir).withColumn("content", text.cast("binary"))).select("event_id", "header_reject", F.when(F.col("header_reject").isNull(), F.col("minute_100ns")).alias("minute_100ns"))


def wire_parse(spark, sf_dir):
    """Short frames of even events are padded with zeros, those of odd ones are not."""
    short = (F.floor(_byte(4) / 8) < 16) & (F.col("event_id") % 2 == 0)
    body = [_byte(k) for k in range(11)] + [F.when(short, F.lit(0).cast("long")).otherwise(_byte(k)) for k in range(11, 18)] + [_byte(18), _byte(19)]
    own = _events(spark, sf_dir).select("event_id", _binary(body).alias("body"), F.lit(0).cast("long").alias("minute_100ns"))
    return wire.parsed(wire.records(own)).select("event_id", "ts_100ns", "rssi_dbm", F.lower(F.hex("frame")).alias("frame"), "frame_reject")


def modes_crc(spark, sf_dir):
    own = _events(spark, sf_dir).select("event_id", _binary([_byte(k) for k in range(14)]).alias("frame"))
    return own.select("event_id", modes.parity(F.col("frame")).alias("remainder"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq and frame: intact and broken frames of each kind, from whole numbers of event_id."""
    n = F.col("event_id")
    parts = {"pick": n % 7, "icao": (n * 7919 + 4660) % 16777216, "steps": (n * 37) % 1900, **{x: (n * k) % 8 for x, k in zip("abcd", (3, 5, 7, 11), strict=True)}}
    # each part a column of its own, so that it is written into the generated code once
    own = _events(spark, sf_dir).select(n.alias("event_id"), *[c.cast("long").alias(x) for x, c in parts.items()])
    pick, icao, steps, a, b, c, d = (F.col(x) for x in parts)

    def shifted(value: Column, by: int) -> Column:
        return F.shiftleft(value.cast("long"), by)

    def alt13(s: Column) -> Column:
        return shifted(F.shiftright(s, 5), 7) + shifted(F.shiftright(s, 4).bitwiseAND(F.lit(1)), 5) + 16 + s.bitwiseAND(F.lit(15))

    def digits(value: Column, places: list[int]) -> Column:
        return shifted(F.shiftright(value, 2), places[0]) + shifted(F.shiftright(value, 1).bitwiseAND(F.lit(1)), places[1]) + shifted(value.bitwiseAND(F.lit(1)), places[2])

    own = own.withColumn("steps13", alt13(steps)).withColumn("ident", digits(a, [7, 9, 11]) + digits(b, [1, 3, 5]) + digits(c, [8, 10, 12]) + digits(d, [0, 2, 4]))
    steps13 = F.col("steps13")
    ac12 = shifted(F.shiftright(steps13, 7), 6) + steps13.bitwiseAND(F.lit(63))
    fix = shifted((n * 13) % 2, 34) + shifted((n * 1009) % 131072, 17) + (n * 2003 + 77) % 131072
    letters = [a + 1, b + 1, c + 1, d + 48, *[F.lit(32)] * 4]
    name = sum((shifted(x, 42 - 6 * k) for k, x in enumerate(letters[1:], 1)), shifted(letters[0], 42))
    own = own.withColumn("me", F.when(pick == 0, shifted(F.lit(11), 51) + shifted(ac12, 36) + fix).when(pick == 1, shifted(F.lit(4), 51) + name).otherwise(shifted(F.lit(7), 51) + fix))
    own = own.withColumn("code", F.when(pick.isin(3, 5), F.col("ident")).otherwise(steps13))
    own = own.withColumn("head", F.when(pick == 3, F.lit(5)).when(pick == 4, F.lit(4)).when(pick == 5, F.lit(21)).otherwise(F.lit(11)))

    def hexed(value: Column, size: int) -> Column:
        return F.lpad(F.hex(value.cast("long")), 2 * size, "0")

    squitter = F.concat(F.lit("8D"), hexed(icao, 3), hexed(F.col("me"), 7))
    reply = F.concat(hexed(F.col("head") * 8, 1), F.lit("00"), hexed(F.col("code"), 2), F.when(pick == 5, F.lit("00" * 7)).otherwise(F.lit("")))
    own = own.withColumn("_data", F.when(pick <= 2, squitter).otherwise(reply)).withColumn("_zero", F.unhex(F.concat("_data", F.lit("000000"))))
    flaw = F.when((n % 10 == 3) & (pick <= 2), F.lit(7)).otherwise(F.lit(0)).cast("long")
    over = F.when(pick <= 2, F.lit(0).cast("long")).otherwise(icao)
    check = modes.parity(F.col("_zero")).bitwiseXOR(over).bitwiseXOR(flaw)
    return own.select(n.alias("seq"), F.unhex(F.concat("_data", hexed(check, 3))).alias("frame"))


def modes_decode(spark, sf_dir):
    return modes.decode(frames(spark, sf_dir)).select("seq", "reject_reason", "kind", "icao", F.coalesce("ca_ground", F.lit(False)).alias("ca_ground"), "parity_bit", "lat_cpr", "lon_cpr", "alt_ft", "call_sign", "squawk", "emergency")


def _shifted(value: Column, by: int) -> Column:
    return F.shiftleft(value.cast("long"), by)


def _hexed(value: Column, size: int) -> Column:
    return F.lpad(F.hex(value.cast("long")), 2 * size, "0")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, ts_100ns and frame of aircraft that fly: an aircraft's positions are near one another, so that even and odd
    ones pair; between them come call signs, squawks, altitudes and positions on the ground."""
    n, icao, kind = F.col("seq"), F.col("icao"), F.col("sensor_id")
    own = _stream(spark, sf_dir)
    what = F.when((kind == "view") | ((kind == "click") & (n % 3 != 0)), "airborne").when(kind == "click", "altitude").when(kind == "purchase", "callsign").when(kind == "error", "squawk").otherwise("surface")
    drift = n % 100 / 1000.0
    own = own.withColumns({"what": what, "odd": n % 2, "lat": -60 + icao * 37 % 120 + drift, "lon": -170 + icao * 53 % 340 + drift, "steps": n * 37 % 1900})
    own = own.withColumn("nl", cpr.zones(F.col("lat")))
    scale = 131072

    def coded(degrees: Column, cell: Column) -> Column:
        return F.floor(scale * 1.0 * (degrees - cell * F.floor(degrees / cell)) / cell + 0.5) % scale

    odd, steps, ground = F.col("odd"), F.col("steps"), F.col("what") == "surface"
    lat = F.when(ground, n * 1009 % scale).otherwise(coded(F.col("lat"), 360.0 / (60 - odd)))
    lon = F.when(ground, (n * 2003 + 77) % scale).otherwise(coded(F.col("lon"), 360.0 / F.greatest(F.col("nl") - odd, F.lit(1))))
    own = own.withColumns({"lat_cpr": lat.cast("long"), "lon_cpr": lon.cast("long")})
    fix = _shifted(odd, 34) + _shifted(F.col("lat_cpr"), 17) + F.col("lon_cpr")
    # 25-foot steps with the bit that says so among them; nothing at all where the altitude isn't known
    ac12 = F.when(n % 4 == 0, F.lit(0)).otherwise(_shifted(F.shiftright(steps, 4), 5) + 16 + steps.bitwiseAND(F.lit(15)))
    ac13 = _shifted(F.shiftright(steps, 5), 7) + _shifted(F.shiftright(steps, 4).bitwiseAND(F.lit(1)), 5) + 16 + steps.bitwiseAND(F.lit(15))
    letter = F.floor(n / 5) % 2 + 1
    name = sum((_shifted(letter if k < 3 else F.lit(32), 42 - 6 * k) for k in range(1, 8)), _shifted(letter, 42))
    me = F.when(F.col("what") == "airborne", _shifted(F.lit(11), 51) + _shifted(ac12, 36) + fix).when(ground, _shifted(F.lit(7), 51) + fix).otherwise(_shifted(F.lit(4), 51) + name)
    # 7700 and 1234 as the bits of an identity
    reply = F.when(F.col("what") == "squawk", F.when(icao % 3 == 0, F.lit(0x0AAA)).otherwise(F.lit(0x1C09))).otherwise(ac13)
    own = own.withColumns({"me": me, "reply": reply, "short": F.col("what").isin("squawk", "altitude")})
    head = F.when(F.col("what") == "squawk", F.lit(5 << 3)).otherwise(F.lit(4 << 3))
    data = F.when(F.col("short"), F.concat(_hexed(head, 1), F.lit("00"), _hexed(F.col("reply"), 2))).otherwise(F.concat(F.lit("8D"), _hexed(icao, 3), _hexed(F.col("me"), 7)))
    own = own.withColumn("_data", data).withColumn("_zero", F.unhex(F.concat("_data", F.lit("000000"))))
    check = modes.parity(F.col("_zero")).bitwiseXOR(F.when(F.col("short"), icao).otherwise(F.lit(0)).cast("long"))
    return own.select("seq", "ts_100ns", F.unhex(F.concat("_data", _hexed(check, 3))).alias("frame"))


def frames_to_positions(spark, sf_dir):
    """Frames to position fixes: decoded, followed aircraft by aircraft, airborne pairs and fixes on the ground."""
    # cut where one plan would have every field's bits written out again for each use of it
    decoded = cut(modes.decode(cut(flights(spark, sf_dir))).where("reject_reason is null"))
    found = state.track(decoded, ["seq"], 2, PAIR, reference=(51.99, 4.375))
    return found.select("seq", "icao", "ts_100ns", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"), "alt", "call_sign", "squawk", "on_ground")


def cpr_global(spark, sf_dir):
    """Positions encoded as even and odd, and found again."""
    n, scale = F.col("event_id"), 131072.0
    own = _events(spark, sf_dir).select("event_id", (n % 2).alias("odd"), (-80 + (n * 37) % 160 + F.col("value") / 1000).alias("lat"), (-180 + (n * 53) % 360 + F.col("value") / 1000).alias("lon"))
    own = own.withColumn("nl", cpr.zones(F.col("lat")))

    def coded(degrees: Column, cell: Column) -> Column:
        return F.floor(scale * (degrees - cell * F.floor(degrees / cell)) / cell + 0.5) % 131072

    own = own.select("event_id", "odd", coded(F.col("lat"), F.lit(360.0 / 60)).alias("elat"), coded(F.col("lat"), F.lit(360.0 / 59)).alias("olat"), coded(F.col("lon"), 360.0 / F.greatest(F.col("nl"), F.lit(1))).alias("elon"), coded(F.col("lon"), 360.0 / F.greatest(F.col("nl") - 1, F.lit(1))).alias("olon"))
    is_odd = F.col("odd") == 1
    own = own.select("event_id", "odd", *[F.when(is_odd, F.col(x)).otherwise(F.col(y)).alias(name) for name, x, y in (("lat", "olat", "elat"), ("lon", "olon", "elon"), ("other_lat", "elat", "olat"), ("other_lon", "elon", "olon"))])
    lat, lon = cpr.global_airborne(F.col("other_lat"), F.col("other_lon"), F.col("lat"), F.col("lon"), F.col("odd"))
    # rounded as a multiple: round(x, 9) goes by the shortest digits of x, which can say a tie where x is none
    return own.select("event_id", *[(F.round(x * 1e9) / 1e9).alias(name) for x, name in ((lat, "lat"), (lon, "lon"))])


def cpr_surface(spark, sf_dir):
    n = F.col("event_id")
    lat, lon = cpr.local_surface((n * 1009) % 131072, (n * 2003 + 77) % 131072, n % 2, 51.99, 4.375)
    return _events(spark, sf_dir).select("event_id", F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon"))


def pipeline_e2e(spark, sf_dir):
    """Late drop, watermark, de-duplication, state, snapshots, blocks and range in one plan."""
    own = watermark.anchored(_confirmed(spark, sf_dir).where("not late"), "frame", ["seq"], "confirmed_before", "ts_100ns", TTL).where("accepted")
    blocks = downsample.last_of_block(_fixes(own), "icao", "ts_100ns", BLOCK, ["seq"])
    kept = table.in_range(blocks, BEGIN + DAY, BEGIN + 27 * DAY)
    return kept.select("ts_100ns", geo.icao_hex(F.col("icao") + 4194304).alias("mode_s_code"), "v", "alt", "call_sign", "squawk")


QUERIES: tuple[Query, ...] = (
    ev_late_and_watermark,
    ev_late_unordered,
    ev_admitted_unordered,
    ev_confirm_timeline,
    ev_ttl_dedup_anchor,
    ev_ttl_dedup_confirmed,
    ev_nstrike,
    ev_nstrike_emergency,
    ev_nstrike_seeded,
    ev_nstrike_split,
    ev_asof_join,
    ev_alt_lww_asof,
    ev_pair_asof,
    ev_snapshot,
    ev_block_lww,
    ev_block_flush,
    ev_restore_distinct_on,
    ev_upsert_merge,
    ev_minute_replace,
    ev_minute_bucket_counts,
    ev_view_filter,
    ev_view_named,
    ev_view_totals,
    ev_view_summary,
    ev_last_point,
    ev_trajectory,
    ev_trajectory_line,
    ev_webmercator,
    ev_reject_counts,
    signal_dbm,
    wire_header,
    wire_parse,
    modes_crc,
    modes_decode,
    frames_to_positions,
    cpr_global,
    cpr_surface,
    pipeline_e2e,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()

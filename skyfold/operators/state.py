"""Per-aircraft state as windows over one order of arrival.

What the engine keeps of each aircraft becomes columns of each of its messages: debounced values, the last
altitude, the last even and odd position. All windows have the aircraft in their key, so rows are shuffled once;
debouncing sorts them again for its runs. A run of the stream leaves to the next the few messages of each aircraft
that can still matter, and its confirmed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def so_far(key: str, order: list[str]):
    return Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def last_known(value: Column, key: str, order: list[str]) -> Column:
    """The latest value that isn't null, this row's included."""
    return F.last(value, ignorenulls=True).over(so_far(key, order))


def debounce(df: DataFrame, key: str, order: list[str], value: str, n: int, out: str, force: Column | None = None, seed: str | None = None) -> DataFrame:
    """df with `out`: the value confirmed so far by n equal observations running, of rows whose value isn't null.

    A value confirms at the n-th of a run; force confirms at once. A repeat of the confirmed value ends another
    candidate's run, as any other value does. seed: a column with the value confirmed before the first row; it
    shortens no other value's run.
    """
    held = Window.partitionBy(key, F.col(value).isNotNull()).orderBy(*order)
    fresh = F.coalesce(F.lag(value).over(held) != F.col(value), F.lit(True))
    runs = df.withColumn("_run", F.when(F.col(value).isNotNull(), F.sum(F.when(fresh, 1).otherwise(0)).over(held.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    place = F.row_number().over(Window.partitionBy(key, "_run").orderBy(*order))
    confirms = (place >= n) if force is None else ((place >= n) | force)
    confirmed = F.when(F.col(value).isNotNull() & confirms, F.col(value))
    found = runs.withColumn("_c", confirmed).withColumn(out, last_known(F.col("_c"), key, order))
    if seed is not None:
        found = found.withColumn(out, F.coalesce(out, seed))
    return found.drop("_run", "_c")


def debounce_split(df: DataFrame, key: str, bucket: str, order: list[str], value: str, n: int, out: str, force: Column | None = None, seed: str | None = None) -> DataFrame:
    """What debounce() gives, with each key's rows followed in stretches by themselves, so that a key on very many rows
    is many tasks' work. bucket: a column that never falls along the order.

    A stretch is a map from what is known before it to what is known after it, and few numbers say it: its first run
    and its last one, and the value it confirms whatever came before. Only its first run depends on what came before,
    which is the confirmed value, the last value, and how often running. The maps of a key's stretches are composed by
    running values over one row a stretch; then all stretches are finished at once.
    """
    seen, parts = F.col(value).isNotNull(), [key, bucket]
    held = Window.partitionBy(*parts, seen).orderBy(*order)
    fresh = F.coalesce(F.lag(value).over(held) != F.col(value), F.lit(True))
    rows = df.withColumn("_run", F.when(seen, F.sum(F.when(fresh, 1).otherwise(0)).over(held.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    rows = rows.withColumn("_place", F.when(seen, F.row_number().over(Window.partitionBy(*parts, "_run").orderBy(*order)).cast("long")))
    forced = F.lit(False) if force is None else F.coalesce(force, F.lit(False))
    rows = rows.withColumn("_at_once", seen & forced)
    # 1. one row a stretch that has values
    sure = seen & ((F.col("_place") >= n) | F.col("_at_once"))
    ends = F.struct("_run", "_place")
    maps = rows.where(seen).groupBy(*parts).agg(
        F.max_by(value, F.when(F.col("_run") == 1, F.col("_place"))).alias("_first"),
        F.max(F.when(F.col("_run") == 1, F.col("_place"))).alias("_lead"),
        F.max_by(value, ends).alias("_last"),
        F.max(ends).alias("_end"),
        F.max_by(value, F.when(sure, ends)).alias("_own"),
    )
    # 2. what comes into each stretch
    along = Window.partitionBy(key).orderBy(bucket)
    so_far_ = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    maps = maps.withColumn("_joins", F.coalesce(F.lag("_last").over(along) == F.col("_first"), F.lit(False)))
    through = F.col("_joins") & (F.col("_end._run") == 1)
    maps = maps.withColumn("_chain", F.sum(F.when(through, 0).otherwise(1)).over(so_far_))
    chained = Window.partitionBy(key, "_chain").orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    maps = maps.withColumn("_after", F.sum("_end._place").over(chained))
    maps = maps.withColumn("_into", F.when(F.col("_joins"), F.lag("_after").over(along)).otherwise(F.lit(0)))
    told = F.coalesce("_own", F.when(F.col("_into") + F.col("_lead") >= n, F.col("_first")))
    maps = maps.withColumn("_known", F.last(told, ignorenulls=True).over(so_far_)).withColumn("_before", F.lag("_known").over(along))
    into = maps.select(*parts, "_into", "_before")
    # stretches without a value of their own have what the one before them leaves
    whole = rows.select(*parts).distinct().join(maps.select(*parts, "_known"), parts, "left")
    left = whole.withColumn("_left", F.last("_known", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))).select(*parts, "_left")
    # 3. inside the stretches
    joined = rows.join(left, parts).join(into, parts, "left")
    place = F.col("_place") + F.when(F.col("_run") == 1, F.col("_into")).otherwise(F.lit(0))
    confirms = F.when(seen & ((place >= n) | F.col("_at_once")), F.col(value))
    inside = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.coalesce(F.last(confirms, ignorenulls=True).over(inside), F.col("_left"), *([F.col(seed)] if seed else []))
    return joined.select(*df.columns, known.alias(out))


def positions_before(df: DataFrame, key: str, order: list[str], parity: str, ts: str, payload: list[str]) -> DataFrame:
    """df with other: the latest message of the other parity before this one, as (ts, payload...); null if none."""
    before = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    kept = F.struct(ts, *payload)
    even, odd = (F.last(F.when(F.col(parity) == p, kept), ignorenulls=True).over(before) for p in (0, 1))
    return df.withColumn("other", F.when(F.col(parity) == 0, odd).when(F.col(parity) == 1, even))


def paired(ts: Column, other_ts: Column, within: int) -> Column:
    """Whether the two times are at most `within` apart, the bound included."""
    return F.coalesce(F.abs(ts - other_ts) <= within, F.lit(False))


def with_seed(df: DataFrame, key: str, seed: DataFrame) -> DataFrame:
    """df left-joined with confirmed values from before: seed has key, seed_call_sign and seed_squawk."""
    return df.join(seed, key, "left")


def followed(decoded: DataFrame, order: list[str], n: int, within: int, seed: DataFrame | None = None, reference: tuple[float, float] | None = None) -> DataFrame:
    """decoded with known_call_sign, known_squawk, known_alt, and lat and lon where the message fixes a position.

    decoded: rows of functions.modes.decode without a reject reason. An airborne message fixes a position if one
    of the other parity came at most `within` before or after it in time. A surface message needs a reference.
    """
    from skyfold.functions.cpr import global_airborne, local_surface

    key = "icao"
    df = decoded if seed is None else with_seed(decoded, key, seed)
    seeds = ("seed_call_sign", "seed_squawk") if seed is not None else (None, None)
    df = debounce(df, key, order, "call_sign", n, "known_call_sign", seed=seeds[0])
    df = debounce(df, key, order, "squawk", n, "known_squawk", force=F.col("emergency"), seed=seeds[1])
    told = F.when(F.col("kind") == "altitude", F.col("alt_ft"))
    df = df.withColumn("known_alt", last_known(told, key, order))
    airborne = F.when(F.col("kind") == "airborne", F.col("parity_bit"))
    df = positions_before(df.withColumn("_parity", airborne), key, order, "_parity", "ts_100ns", ["lat_cpr", "lon_cpr"])
    lat, lon = global_airborne(F.col("other.lat_cpr"), F.col("other.lon_cpr"), F.col("lat_cpr"), F.col("lon_cpr"), F.col("parity_bit"))
    near = (F.col("kind") == "airborne") & paired(F.col("ts_100ns"), F.col("other.ts_100ns"), within)
    ground_lat, ground_lon = local_surface(F.col("lat_cpr"), F.col("lon_cpr"), F.col("parity_bit"), *reference) if reference else (F.lit(None), F.lit(None))
    surface = F.col("kind") == "surface"
    return df.withColumn("lat", F.when(near, lat).when(surface, ground_lat).cast("double")).withColumn("lon", F.when(near, lon).when(surface, ground_lon).cast("double"))


def fixes(rows: DataFrame, order: list[str]) -> DataFrame:
    """One row a position fix of followed(): icao, ts_100ns, lat, lon, alt, call_sign, squawk, on_ground, and the order
    columns. The altitude is the message's, or else the last one surveillance replies told; a surface fix has none."""
    surface = F.col("kind") == "surface"
    alt = F.when(~surface, F.coalesce("alt_ft", "known_alt")).cast("int")
    on_ground = F.when(surface, F.lit(True)).otherwise(F.coalesce("ca_ground", F.lit(False)))
    kept = [c for c in order if c != "ts_100ns"]
    found = rows.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return found.select("icao", "ts_100ns", "lat", "lon", alt.alias("alt"), F.col("known_call_sign").alias("call_sign"), F.col("known_squawk").alias("squawk"), on_ground.alias("on_ground"), *kept)


def track(decoded: DataFrame, order: list[str], n: int, within: int, seed: DataFrame | None = None, reference: tuple[float, float] | None = None) -> DataFrame:
    """The position fixes of decoded messages, with what is known of their aircraft at each."""
    return fixes(followed(decoded, order, n, within, seed, reference), order)


#: What a message brings to its aircraft's state.
MESSAGE = ("icao", "ts_100ns", "kind", "parity_bit", "lat_cpr", "lon_cpr", "alt_ft", "ca_ground", "call_sign", "squawk", "emergency")


def tail(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The messages of each aircraft that later ones can still depend on: the last position of each parity, the last
    altitude told, and the last n call signs and squawks, in which any run that isn't confirmed yet lies whole."""
    kind = F.col("kind")
    part = F.when(kind == "airborne", F.concat(kind, F.col("parity_bit"))).when((kind == "altitude") & F.col("alt_ft").isNull(), None).when(kind.isin("altitude", "callsign", "squawk"), kind)
    place = F.row_number().over(Window.partitionBy("icao", "_part").orderBy(*[F.col(c).desc() for c in order]))
    found = rows.withColumn("_part", part).where("_part is not null").withColumn("_place", place)
    kept = [c for c in order if c not in MESSAGE]
    return found.where(F.col("_place") <= F.when(F.col("_part").isin("callsign", "squawk"), F.lit(n)).otherwise(F.lit(1))).select(*MESSAGE, *kept)


def confirmed_values(rows: DataFrame, order: list[str], seed: DataFrame | None = None) -> DataFrame:
    """icao, seed_call_sign and seed_squawk: what is confirmed of each aircraft after rows of followed()."""
    last = rows.groupBy("icao").agg(F.max_by(F.struct("known_call_sign", "known_squawk"), F.struct(*order)).alias("_k"))
    now = last.select("icao", F.col("_k.known_call_sign").alias("seed_call_sign"), F.col("_k.known_squawk").alias("seed_squawk"))
    return now if seed is None else now.unionByName(seed.select(now.columns).join(now.select("icao"), "icao", "left_anti"))

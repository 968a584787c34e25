"""Compact position reporting as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = float(1 << 17)


def zones(lat: Column) -> Column:
    """Longitude zones at a latitude: 59 at the equator, 1 beyond 87 degrees; null at none."""
    a = 1 - math.cos(math.pi / 30)
    inner = F.greatest(F.lit(-1.0), 1 - a / F.pow(F.cos(F.radians(F.abs(lat))), 2))
    return F.when(F.abs(lat) < 1e-12, F.lit(59)).when(F.abs(lat) == 87, F.lit(2)).when(F.abs(lat) > 87, F.lit(1)).when(F.abs(lat) < 87, F.floor(2 * math.pi / F.acos(inner))).cast("int")


def _mod(a: Column, b) -> Column:
    """a modulo b with the sign of b, for doubles and whole numbers held in doubles."""
    return a - b * F.floor(a / b)


def _bound(value: Column, f) -> Column:
    """f of a value that is computed once: the expression stays small however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def global_airborne(other_lat: Column, other_lon: Column, lat: Column, lon: Column, odd: Column) -> tuple[Column, Column]:
    """(lat, lon) in degrees at the latest of an even and an odd message; null where they don't fit together.

    lat, lon and odd (0 or 1) are the latest message's; other_lat and other_lon those of the one of other parity.
    """
    is_odd = odd == 1
    pair = F.struct(
        (F.when(is_odd, other_lat).otherwise(lat) / _SCALE).alias("even_lat"),
        (F.when(is_odd, other_lon).otherwise(lon) / _SCALE).alias("even_lon"),
        (F.when(is_odd, lat).otherwise(other_lat) / _SCALE).alias("odd_lat"),
        (F.when(is_odd, lon).otherwise(other_lon) / _SCALE).alias("odd_lon"),
        odd.alias("odd"),
    )

    def north(v: Column) -> Column:
        j = F.floor(59 * v["even_lat"] - 60 * v["odd_lat"] + 0.5).cast("double")
        return F.struct((360.0 / 60 * (_mod(j, 60) + v["even_lat"])).alias("even"), (360.0 / 59 * (_mod(j, 59) + v["odd_lat"])).alias("odd"))

    def south_too(u: Column) -> Column:
        return F.struct(*[F.when(u[x] >= 270, u[x] - 360).otherwise(u[x]).alias(x) for x in ("even", "odd")])

    def latitude(v: Column, u: Column) -> Column:
        at = F.when(v["odd"] == 1, u["odd"]).otherwise(u["even"])
        return F.when((zones(u["even"]) == zones(u["odd"])) & (F.abs(at) <= 90), at)

    def east(v: Column, nl: Column) -> Column:
        m = F.floor(v["even_lon"] * (nl - 1) - v["odd_lon"] * nl + 0.5).cast("double")
        n = F.greatest(nl - v["odd"], F.lit(1.0))
        return 360.0 / n * (_mod(m, n) + F.when(v["odd"] == 1, v["odd_lon"]).otherwise(v["even_lon"]))

    def longitude(v: Column, at: Column) -> Column:
        return _bound(zones(at).cast("double"), lambda nl: _bound(east(v, nl), lambda x: F.when(x >= 180, x - 360).otherwise(x)))

    def place(v: Column) -> Column:
        latitudes = _bound(north(v), south_too)
        return _bound(_bound(latitudes, lambda u: latitude(v, u)), lambda at: F.struct(at.alias("lat"), longitude(v, at).alias("lon")))

    found = _bound(pair, place)
    return found["lat"], found["lon"]


def local_surface(lat: Column, lon: Column, odd: Column, ref_lat: float, ref_lon: float) -> tuple[Column, Column]:
    """(lat, lon) in degrees of a surface message within 45 nautical miles of a reference."""
    d_lat = 90.0 / (60 - odd)
    y, x = lat / _SCALE, lon / _SCALE
    j = F.floor(F.lit(ref_lat) / d_lat) + F.floor(0.5 + _mod(F.lit(ref_lat), d_lat) / d_lat - y)
    latitude = d_lat * (j + y)

    def east(d_lon: Column) -> Column:
        m = F.floor(F.lit(ref_lon) / d_lon) + F.floor(0.5 + _mod(F.lit(ref_lon), d_lon) / d_lon - x)
        return d_lon * (m + x)

    width = _bound(latitude, lambda at: 90.0 / F.greatest(zones(at) - odd, F.lit(1)))
    return latitude, _bound(width, east)

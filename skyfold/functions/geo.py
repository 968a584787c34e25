"""Map geometry and identifiers on columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS = 6378137.0


def web_mercator(lat: Column, lon: Column) -> tuple[Column, Column]:
    """(x, y) in metres of degrees: EPSG:4326 to EPSG:3857."""
    return F.radians(lon) * EARTH_RADIUS, F.log(F.tan(math.pi / 4 + F.radians(lat) / 2)) * EARTH_RADIUS


def thousandths(value: Column) -> Column:
    """The value to three decimals by its exact binary fraction, ties to even, as C's printf has it.

    Java's formatter and round() go by the shortest digits of a double, so that 1975640.1475, which lies below its
    digits, is a tie to them. Every step here is exact; values too large for that have no such decimals.
    """
    size = F.abs(value)
    whole = F.floor(size)
    rest = size - whole
    high = F.floor(rest * 2.0**26) / 2.0**26
    n = F.floor(1000 * high)
    over = (1000 * high - n - 0.5) + 1000 * (rest - high)
    up = (over > 0) | ((over == 0) & (n % 2 == 1))
    rounded = F.signum(value) * (whole * 1000.0 + n + F.when(up, 1.0).otherwise(0.0)) / 1000
    return F.when(size < 2.0**43, rounded).otherwise(value)


def icao_hex(icao: Column) -> Column:
    """Six upper-case hex digits."""
    return F.lpad(F.hex(icao.cast("long")), 6, "0")


def icao_number(code: Column) -> Column:
    """The number of a code in hex digits; null for anything else or beyond 32 bits."""
    return F.when(code.rlike(r"^\+?0*[0-9A-Fa-f]{1,8}$"), F.conv(F.regexp_replace(code, r"^\+", ""), 16, 10).cast("long"))


def label(code: Column, call_sign: Column, alt: Column) -> Column:
    """Two lines: code and call sign where there is one, then the altitude or a dash."""
    return F.concat(F.concat_ws(" / ", code, F.nullif(F.trim(call_sign), F.lit(""))), F.lit("\nalt="), F.coalesce(alt.cast("string"), F.lit("-")))

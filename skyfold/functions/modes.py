"""Mode S frames as column expressions: parity, message kinds, call signs, identity and altitude codes.

A frame is 7 or 14 bytes of BINARY. Everything below is arithmetic on its hex digits, so that it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GENERATOR = 0xFFF409
EMERGENCY_SQUAWKS = ("7500", "7600", "7700")
#: The six-bit alphabet of call signs; # marks codes without a character.
ALPHABET = "#ABCDEFGHIJKLMNOPQRSTUVWXYZ##### ###############0123456789######"


def unsigned(frame: Column, first: int, size: int) -> Column:
    """The whole number in `size` bytes (at most 7) from byte `first`, counted from 0; null beyond the end."""
    return F.conv(F.nullif(F.substring(F.hex(frame), 2 * first + 1, 2 * size), F.lit("")), 16, 10).cast("long")


def bits(value: Column, low: int, size: int) -> Column:
    """`size` bits of a long whose lowest bit has the weight 2**low."""
    return F.shiftright(value, low).bitwiseAND(F.lit((1 << size) - 1).cast("long"))


def downlink_format(frame: Column) -> Column:
    return bits(unsigned(frame, 0, 1), 3, 5).cast("int")


def _remainders(n_bytes: int) -> list[list[int]]:
    """For each byte of the data part, the parity that each value of it adds: the code is linear."""
    weights = []  # parity of one set bit, from the last bit backwards
    at = GENERATOR
    for _ in range(8 * n_bytes):
        weights.append(at)
        at = ((at << 1) ^ (GENERATOR if at & 0x800000 else 0)) & 0xFFFFFF
    tables = []
    for byte in range(n_bytes):
        own = [weights[8 * (n_bytes - 1 - byte) + b] for b in range(8)]
        tables.append([0] * 256)
        for value in range(256):
            for b in range(8):
                if value >> b & 1:
                    tables[-1][value] ^= own[b]
    return tables


def parity(frame: Column) -> Column:
    """The remainder of a frame: 0 for an intact DF17 or DF18, the aircraft's address for DF4, 5, 20 and 21."""

    def remainder(data_bytes: int) -> Column:
        found = unsigned(frame, data_bytes, 3)
        for byte, table in enumerate(_remainders(data_bytes)):
            found = found.bitwiseXOR(F.get(F.lit(table), unsigned(frame, byte, 1).cast("int")).cast("long"))
        return found

    return F.when(F.length(frame) == 14, remainder(11)).when(F.length(frame) == 7, remainder(4))


def call_sign(me: Column) -> Column:
    """The eight characters of an identification message, trailing spaces and underscores trimmed."""
    letters = [F.substring(F.lit(ALPHABET), bits(me, 42 - 6 * k, 6).cast("int") + 1, F.lit(1)) for k in range(8)]
    return F.rtrim(F.concat(*letters), F.lit(" _"))


def _permuted(code: Column, places: list[int]) -> Column:
    """The bits of `code` at `places`, the first one highest."""
    found = F.lit(0).cast("long")
    for k, p in enumerate(places):
        found = found.bitwiseOR(F.shiftleft(bits(code, p, 1), len(places) - 1 - k))
    return found


# The place in the 13-bit field of pulses A4 A2 A1, B4 B2 B1, C4 C2 C1 and D4 D2 D1.
_A, _B, _C, _D = [7, 9, 11], [1, 3, 5], [8, 10, 12], [0, 2, 4]


def squawk(id13: Column) -> Column:
    """Four octal digits of an identity code."""
    return F.concat(*[_permuted(id13, g).cast("string") for g in (_A, _B, _C, _D)])


def thirteen(ac12: Column) -> Column:
    """The 13-bit altitude code of a 12-bit one, which is without the metric bit."""
    return F.shiftleft(F.shiftright(ac12, 6), 7).bitwiseOR(ac12.bitwiseAND(F.lit(0x3F)))


def _binary_of_gray(gray: Column, size: int) -> Column:
    found = gray
    for shift in range(1, size):
        found = found.bitwiseXOR(F.shiftright(gray, shift))
    return found


def with_altitude(df: DataFrame, code: str, out: str) -> DataFrame:
    """df with `out`: feet of the 13-bit altitude code in `code`; null for 0, which means unknown, and for codes
    without a meaning.

    Codes come in steps of 25 feet (Q set), in metres (M set) or Gillham-coded: five hundreds as a Gray code of D2 D4
    A1 A2 A4 B1 B2 B4, one hundreds of C1 C2 C4. Each step is a column, so that generated code stays small.
    """
    c = F.col(code)
    quarter = F.shiftright(c, 2).bitwiseAND(F.lit(0x7E0)).bitwiseOR(F.shiftright(c, 1).bitwiseAND(F.lit(0x10))).bitwiseOR(c.bitwiseAND(F.lit(0xF)))
    metres = F.shiftright(c, 1).bitwiseAND(F.lit(0xFC0)).bitwiseOR(c.bitwiseAND(F.lit(0x3F)))
    staged = df.withColumns({"_gray": _permuted(c, [2, 0, 11, 9, 7, 5, 3, 1]), "_small": _permuted(c, [12, 10, 8])})
    staged = staged.withColumns({"_high": _binary_of_gray(F.col("_gray"), 8), "_low": _binary_of_gray(F.col("_small"), 3)})
    high, low = F.col("_high"), F.col("_low")
    five = F.when(low == 7, F.lit(5)).otherwise(low)
    staged = staged.withColumn("_feet", high * 500 + F.when(bits(high, 0, 1) == 1, 6 - five).otherwise(five) * 100 - 1300)
    gillham = F.when(~low.isin(0, 5, 6) & (bits(c, 4, 1) == 0) & (F.col("_feet") >= -1200), F.col("_feet"))
    feet = F.when(c == 0, F.lit(None)).when(bits(c, 6, 1) == 1, F.round(metres * 3.28084).cast("long")).when(bits(c, 4, 1) == 1, quarter * 25 - 1000).otherwise(gillham)
    return staged.withColumn(out, feet.cast("int")).drop("_gray", "_small", "_high", "_low", "_feet")


def decode(frames: DataFrame, frame: str = "frame") -> DataFrame:
    """frames with icao, kind, parity_bit, lat_cpr, lon_cpr, alt_ft, ca_ground, call_sign, squawk, emergency and
    reject_reason.

    kind: airborne, surface, callsign, squawk, altitude or ignored. reject_reason: crc_invalid where the parity of
    a DF17 or DF18 isn't zero, unsupported_df for other formats, parse_error for a null frame or one of another
    length; else null. Only rows without a reason have a kind.
    """
    f = F.col(frame)
    staged = frames.withColumns({"_df": downlink_format(f), "_parity": parity(f), "_me": unsigned(f, 4, 7), "_field": unsigned(f, 2, 2).bitwiseAND(F.lit(0x1FFF))})
    df, me = F.col("_df"), F.col("_me")
    squitter, surveillance = df.isin(17, 18), df.isin(4, 5, 20, 21)
    long_size = F.when(df >= 16, 14).otherwise(7)
    reason = (
        F.when(f.isNull() | ~F.length(f).isin(7, 14) | (F.length(f) != long_size), "parse_error")
        .when(squitter & (F.col("_parity") != 0), "crc_invalid")
        .when(~squitter & ~surveillance, "unsupported_df")
    )
    tc = bits(me, 51, 5)
    kind = (
        F.when(squitter & (tc.between(9, 18) | tc.between(20, 22)), "airborne")
        .when(squitter & tc.between(5, 8), "surface")
        .when(squitter & tc.between(1, 4), "callsign")
        .when(squitter, "ignored")
        .when(df.isin(5, 21), "squawk")
        .otherwise("altitude")
    )
    staged = staged.withColumn("reject_reason", reason).withColumn("kind", F.when(F.col("reject_reason").isNull(), kind))
    k = F.col("kind")
    fix = k.isin("airborne", "surface")
    staged = staged.withColumn("squawk", F.when(k == "squawk", squawk(F.col("_field"))))
    staged = staged.withColumn("_code", F.when(k == "airborne", thirteen(bits(me, 36, 12))).when(k == "altitude", F.col("_field")))
    return with_altitude(staged, "_code", "alt_ft").withColumns(
        {
            "icao": F.when(k.isNotNull(), F.when(squitter, unsigned(f, 1, 3)).otherwise(F.col("_parity"))).cast("int"),
            "parity_bit": F.when(fix, bits(me, 34, 1)).cast("int"),
            "lat_cpr": F.when(fix, bits(me, 17, 17)).cast("int"),
            "lon_cpr": F.when(fix, bits(me, 0, 17)).cast("int"),
            "ca_ground": (df == 17) & (bits(unsigned(f, 0, 1), 0, 3) == 4),
            "call_sign": F.when(k == "callsign", call_sign(me)),
            "emergency": F.coalesce(F.col("squawk").isin(*EMERGENCY_SQUAWKS), F.lit(False)),
        }
    ).drop("_df", "_parity", "_me", "_field", "_code")

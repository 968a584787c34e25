"""100 ns time on columns and on the driver."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

PER_US, PER_MS, PER_S, PER_MINUTE = 10, 10_000, 10_000_000, 600_000_000
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
_MOST, _LEAST = (1 << 63) - 1, -(1 << 63)


def from_ms(ms: int) -> int:
    return ms * PER_MS


def from_datetime(at: datetime) -> int:
    """Whole 100 ns of an aware datetime; a datetime has microseconds."""
    return ((at - _EPOCH) // timedelta(microseconds=1)) * PER_US


def to_datetime(ts: int) -> datetime:
    """Truncated to microseconds; the epoch where no datetime can say it."""
    try:
        return _EPOCH + timedelta(microseconds=ts // PER_US)
    except OverflowError:
        return _EPOCH


def saturating(value: int) -> int:
    """value within 64 bits."""
    return max(_LEAST, min(_MOST, value))


def saturating_add(ts: Column, span: Column) -> Column:
    """ts + span, held at the ends of 64 bits; ANSI mode would raise there."""
    over, under = (span > 0) & (ts > F.lit(_MOST) - F.greatest(span, F.lit(0))), (span < 0) & (ts < F.lit(_LEAST) - F.least(span, F.lit(0)))
    return F.when(over, F.lit(_MOST)).when(under, F.lit(_LEAST)).otherwise(F.try_add(ts, span))


def saturating_sub(ts: Column, span: Column) -> Column:
    """ts - span, held at the ends of 64 bits."""
    whole = F.try_subtract(ts, span)
    return F.coalesce(whole, F.when(span > 0, F.lit(_LEAST)).otherwise(F.lit(_MOST)))


def abs_delta(a: Column, b: Column) -> Column:
    """|a - b|, at most the largest 64-bit number."""
    return F.coalesce(F.try_subtract(F.greatest(a, b), F.least(a, b)), F.lit(_MOST))


def floor_to(ts: Column, span: int) -> Column:
    """The start of ts's block of `span`; negative times floor down, not towards zero."""
    return ts - F.pmod(ts, F.lit(span))


def block_id(ts: Column, span: int) -> Column:
    """The number of ts's block of `span`, floored."""
    return _div(floor_to(ts, span), span)


def _div(exact: Column, span: int) -> Column:
    """Whole-number quotient of a multiple of span."""
    return F.call_function("div", exact, F.lit(span).cast("long"))


def to_timestamp(ts: Column) -> Column:
    """A Spark timestamp of a block-aligned time."""
    return F.timestamp_micros(_div(floor_to(ts, PER_US), PER_US))


def of_timestamp(at: Column) -> Column:
    """100 ns of a timestamp, or of a timestamp without zone as UTC (in a UTC session)."""
    return F.unix_micros(at.cast("timestamp")) * PER_US


def minute_key(ts: Column) -> Column:
    """Unix minutes."""
    return _div(floor_to(ts, PER_MINUTE), PER_MINUTE)


def minute_label(ts: Column) -> Column:
    """YYYYMMDDHHMM in UTC."""
    return F.date_format(to_timestamp(ts), "yyyyMMddHHmm")

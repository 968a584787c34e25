"""Stateful processors of the stream: frames that are remembered until they expire, and what is known of each aircraft.

Rows of a key come in any order within a micro-batch and are put in the order of arrival. State is Spark's: a value or a
map a key, kept in its state store and restored with the query.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ORDER = ("batch", "seq", "record_index")
EVENT = "batch long, seq string, record_index long, sensor_id string, ts_100ns long, frame binary, confirmed_before long, clock timestamp"
ADMITTED = f"{EVENT}, accepted boolean"
FIX = "icao int, at timestamp, ts_100ns long, batch long, seq string, record_index long, kind string, parity_bit int, lat_cpr int, lon_cpr int, other_lat int, other_lon int, alt int, call_sign string, squawk string, on_ground boolean"
_PER_MS = 10_000
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _arrived(rows: Iterator[Row]) -> list[Row]:
    """One micro-batch's rows of a key, which the source bounds, in the order they arrived."""
    return sorted(rows, key=lambda r: tuple(r[c] for c in ORDER))


class FirstCome(StatefulProcessor):
    """Marks the first event of a frame, and any that comes once the confirmed time has reached the last one's expiry.

    A frame leaves the state by a timer, when the confirmed time has passed its expiry.
    """

    def __init__(self, ttl: int):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.expiry = handle.getValueState("expiry", "at_100ns long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = expiry = self.expiry.get()[0] if self.expiry.exists() else None
        for r in _arrived(rows):
            fresh = expiry is None or (r.confirmed_before is not None and r.confirmed_before >= expiry)
            if fresh:
                expiry = r.ts_100ns + self.ttl
            yield Row(**r.asDict(), accepted=fresh)
        if expiry != before:
            if before is not None:
                self.handle.deleteTimer(_timer(before))
            self.expiry.update((expiry,))
            self.handle.registerTimer(_timer(expiry))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.expiry.clear()
        return iter([])

    def close(self) -> None:
        pass


def _timer(expiry: int) -> int:
    """The whole millisecond at which an expiry has surely been reached."""
    return -(-expiry // _PER_MS)


#: Of each debounced value: what is confirmed, the value observed last, and how often running.
_KNOWN = "call_sign string, call_last string, call_run int, squawk string, squawk_last string, squawk_run int, alt int"


def observed(told: tuple, value: str, n: int, at_once: bool = False) -> tuple:
    """(confirmed, last, run) after another observation: a value is confirmed when it ends n equal ones."""
    confirmed, last, run = told
    run = run + 1 if run and value == last else 1
    return (value if at_once or run >= n else confirmed), value, run


class Aircraft(StatefulProcessor):
    """Messages of an aircraft to possible position fixes, with what is known at each.

    Kept are the last position of either parity, the altitude told last, and call sign and squawk with the run of equal
    ones that may still confirm another. Values confirmed before the stream began come as initial state.
    """

    def __init__(self, n: int, within: int, surface: bool):
        self.n, self.within, self.surface = n, within, surface

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", _KNOWN)
        self.last = handle.getMapState("last", "parity int", "ts_100ns long, lat int, lon int")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        own = initialState if isinstance(initialState, Row) else next(iter(initialState))
        self.known.update((own.seed_call_sign, None, 0, own.seed_squawk, None, 0, None))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        own = self.known.get() if self.known.exists() else None
        call, squawk, alt = (own[:3], own[3:6], own[6]) if own else ((None, None, 0), (None, None, 0), None)
        last: dict[int, tuple | None] = {}
        heard = set()
        for r in _arrived(rows):
            if r.kind == "callsign":
                call = observed(call, r.call_sign, self.n)
            elif r.kind == "squawk":
                squawk = observed(squawk, r.squawk, self.n, r.emergency)
            elif r.kind == "altitude":
                alt = alt if r.alt_ft is None else r.alt_ft
            elif r.kind == "airborne":
                other = 1 - r.parity_bit
                if other not in last:
                    last[other] = tuple(self.last.getValue((other,))) if self.last.containsKey((other,)) else None
                pair = last[other]
                if pair is not None and abs(r.ts_100ns - pair[0]) <= self.within:
                    yield self._fix(r, pair, r.alt_ft if r.alt_ft is not None else alt, call[0], squawk[0], bool(r.ca_ground))
                last[r.parity_bit] = (r.ts_100ns, r.lat_cpr, r.lon_cpr)
                heard.add(r.parity_bit)
            elif r.kind == "surface" and self.surface:
                yield self._fix(r, (None, None, None), None, call[0], squawk[0], True)
        for parity in heard:
            self.last.updateValue((parity,), last[parity])
        self.known.update((*call, *squawk, alt))

    def _fix(self, r: Row, other: tuple, alt: int | None, call_sign: str | None, squawk: str | None, on_ground: bool) -> Row:
        at = _EPOCH + timedelta(microseconds=r.ts_100ns // 10)
        return Row(icao=r.icao, at=at, ts_100ns=r.ts_100ns, batch=r.batch, seq=r.seq, record_index=r.record_index, kind=r.kind, parity_bit=r.parity_bit, lat_cpr=r.lat_cpr, lon_cpr=r.lon_cpr, other_lat=other[1], other_lon=other[2], alt=alt, call_sign=call_sign, squawk=squawk, on_ground=on_ground)

    def close(self) -> None:
        pass

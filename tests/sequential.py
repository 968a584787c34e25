"""The rules said over whole histories, to hold the operators against: nothing is kept, all is looked up again."""

from __future__ import annotations


def candidate(counted: list, timeout: int) -> int:
    """The least of the sensors' latest times that are within timeout of the greatest."""
    tops = [max(t for s, t, _ in counted if s == sensor) for sensor in {s for s, _, _ in counted}]
    return min(t for t in tops if max(tops) - t <= timeout)


def confirmed_by(watermarks: list, quantum: int) -> list:
    """The watermarks that confirm: the first, and each that is a quantum or more beyond the last one that did."""
    found: list = []
    for w in watermarks:
        if w is not None and (not found or w - found[-1] >= quantum):
            found.append(w)
    return found


def admission(events: list, timeout: int, ttl: int, quantum: int) -> list[dict]:
    """What is known before each event (sensor, time, frame), and what becomes of it."""
    counted: list = []
    accepted: list = []
    watermarks: list = []
    out = []
    for sensor, ts, frame in events:
        before = max(watermarks, default=None)
        confirmed = (confirmed_by(watermarks, quantum) or [None])[-1]
        late = before is not None and ts < before
        row = {"wm_before": before, "confirmed_before": confirmed, "late": late, "accepted": False}
        if not late:
            counted.append((sensor, ts, frame))
            watermarks.append(max(candidate(counted, timeout), before if before is not None else candidate(counted, timeout)))
            row["accepted"] = all(f != frame or (confirmed is not None and t + ttl <= confirmed) for t, f in accepted)
            if row["accepted"]:
                accepted.append((ts, frame))
        out.append(row)
    return out


def debounced(values: list, n: int, forced: set = frozenset()) -> list:
    """The confirmed value after each observation: that of the latest one that ends n equal ones, or is forced."""
    out = []
    for i in range(len(values)):
        own = [v for v in values[: i + 1] if v is not None]
        ends = [k for k, v in enumerate(own) if v in forced or (k + 1 >= n and set(own[k + 1 - n : k + 1]) == {v})]
        out.append(own[ends[-1]] if ends else None)
    return out

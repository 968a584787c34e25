"""Counters: as an aggregation over a table's rows, and as observed metrics of a running job."""

from __future__ import annotations

import json
import logging
import threading
import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger("skyfold")

COUNTERS = ("rejected_crc", "parse_error", "unsupported_df", "malformed_short_frame", "dropped_late", "unknown_sensor", "deduped_dropped", "positions_emitted", "db_upserts", "reconnects", "missing_files", "trailing_bytes")


def counts(flags: dict[str, Column]) -> list[Column]:
    """Aggregates that count the rows of each flag; a null is no."""
    return [F.coalesce(F.sum(F.when(c, 1)), F.lit(0)).cast("long").alias(n) for n, c in flags.items()]


def audit(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    return df.agg(*counts(flags))


def observed(df: DataFrame, name: str, flags: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """df, counting as it runs; the observation has the counts after an action."""
    seen = Observation(name)
    return df.observe(seen, *counts(flags)), seen


class Totals:
    """A run's counters, and their line in the log."""

    def __init__(self, every_s: float = 30):
        self.totals, self.every_s, self.said = dict.fromkeys(COUNTERS, 0), every_s, time.monotonic()

    def __getitem__(self, name: str) -> int:
        return self.totals[name]

    def add(self, **more: int) -> None:
        for name, n in more.items():
            self.totals[name] += n

    def count(self, df: DataFrame, **flags: Column) -> None:
        """Adds the rows of each flag, counted on the executors."""
        self.add(**audit(df, flags).head().asDict())

    def report(self) -> None:
        log.info("%s", " ".join(f"{k}={v}" for k, v in self.totals.items()))
        self.said = time.monotonic()

    def tick(self) -> None:
        """A report, if the last one is long enough ago."""
        if time.monotonic() - self.said >= self.every_s:
            self.report()


class Listener(StreamingQueryListener):
    """Adds what streaming queries observe to a run's counters, and reports them in time, idle or not.

    Observed metrics come with a batch's own run over its rows; names that aren't counters are left. Reconnections are
    told by a source's offsets.
    """

    def __init__(self, totals: Totals):
        self.totals, self.ended, self.reconnects = totals, set(), {}
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for row in event.progress.observedMetrics.values():
            self.totals.add(**{k: v for k, v in row.asDict().items() if k in COUNTERS})
        for source in event.progress.sources:
            try:
                n = json.loads(source.endOffset or "{}").get("reconnects", 0)
            except (ValueError, AttributeError, TypeError):
                continue
            key = (event.progress.runId, source.description)
            self.totals.add(reconnects=max(0, n - self.reconnects.get(key, 0)))
            self.reconnects[key] = max(n, self.reconnects.get(key, 0))
        self.totals.tick()

    def onQueryIdle(self, event) -> None:
        self.totals.tick()

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self.ended.add(str(event.runId))
            self._changed.notify_all()

    def settle(self, runs: set[str], timeout_s: float = 10) -> None:
        """Waits until all that these runs have told is counted."""
        with self._changed:
            self._changed.wait_for(lambda: runs <= self.ended, timeout_s)

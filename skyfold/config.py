"""Run parameters and their validation, on the driver."""

from __future__ import annotations

import argparse
import re
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from skyfold.functions.timeunits import PER_MS

SENSOR = re.compile(r"[A-Z]{2}[0-9]{2}\Z")
#: Conversions that a path template may use.
TEMPLATE_ITEMS = frozenset("YmdHMSyjbBaAeFTDR%")


class ConfigError(ValueError):
    """A parameter that can't be run with."""


def validate_block(ms: int) -> None:
    """A block is positive, divides a second or is whole seconds, and divides a minute: blocks never cross one."""
    if ms <= 0 or (1000 % ms if ms <= 1000 else ms % 1000) or 60_000 % ms:
        raise ConfigError(f"block of {ms} ms doesn't divide a minute evenly")


def validate_sensors(sensors: list[str]) -> None:
    if not sensors:
        raise ConfigError("no sensor")
    for s in sensors:
        if not SENSOR.match(s):
            raise ConfigError(f"{s!r} isn't two capital letters and two digits")
    if len(set(sensors)) < len(sensors):
        raise ConfigError("a sensor is named twice")


def validate_aligned(name: str, at: datetime) -> None:
    if at.second or at.microsecond:
        raise ConfigError(f"{name} isn't a whole minute")


def validate_template(template: str) -> None:
    """Python passes on conversions that it doesn't know, so they are looked for."""
    text = template.replace("{sensor}", "XX00")
    for item in re.findall(r"%(.?)", text.replace("%%", "")):
        if item not in TEMPLATE_ITEMS:
            raise ConfigError(f"%{item} isn't a conversion that a path can have")


def minute_path(folder: str, template: str, minute: datetime, sensor: str) -> str:
    """The file of a sensor and minute: the sensor first, then the conversions, in UTC."""
    return f"{folder.rstrip('/')}/{minute.astimezone(UTC).strftime(template.replace('{sensor}', sensor))}"


@dataclass(frozen=True)
class Config:
    sensors: tuple[str, ...]
    block_ms: int = 1000
    ttl_ms: int = 50
    timeout_ms: int = 1000
    debounce: int = 3
    lookback_s: int = 0
    pair_ms: int = 10_000
    reference: tuple[float, float] | None = None
    data_dir: str | None = None
    template: str = "%Y%m%d%H%M{sensor}.spkx"
    start: datetime | None = None
    end: datetime | None = None
    messages: str | None = None
    table: str | None = None
    stretch: int | None = None

    @property
    def block(self) -> int:
        return self.block_ms * PER_MS

    @property
    def ttl(self) -> int:
        return self.ttl_ms * PER_MS

    @property
    def timeout(self) -> int:
        return self.timeout_ms * PER_MS

    @property
    def pair(self) -> int:
        return self.pair_ms * PER_MS

    @property
    def quantum(self) -> int:
        """How far the watermark moves before anything is confirmed."""
        return max(1, min(self.block, self.ttl))

    def validated(self, mode: str) -> Config:
        validate_sensors(list(self.sensors))
        validate_block(self.block_ms)
        if self.debounce < 1:
            raise ConfigError("debounce is 1 at least")
        if min(self.ttl_ms, self.timeout_ms, self.lookback_s) < 0:
            raise ConfigError("a span is negative")
        if mode == "realtime":
            if not self.messages:
                raise ConfigError("realtime needs a folder of messages")
        elif mode == "recompute":
            if self.start is None or self.end is None or self.start >= self.end:
                raise ConfigError("recompute needs a start before its end")
            validate_aligned("start", self.start)
            validate_aligned("end", self.end)
            if not self.data_dir:
                raise ConfigError("recompute needs a data folder")
            validate_template(self.template)
            if self.stretch is not None and self.stretch < 1:
                raise ConfigError("a stretch is a minute at least")
        else:
            raise ConfigError(f"no mode {mode!r}")
        return self

    def minutes(self) -> list[datetime]:
        """The minutes of the run, and the one before, which warms the state up."""
        n = int((self.end - self.start) / timedelta(minutes=1))
        return [self.start + timedelta(minutes=k) for k in range(-1, n)]


def _moment(text: str) -> datetime:
    at = datetime.fromisoformat(text.replace("Z", "+00:00"))
    return at if at.tzinfo else at.replace(tzinfo=UTC)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="skyfold", description="Surveillance messages to position rows.")
    p.add_argument("mode", choices=("realtime", "recompute"))
    p.add_argument("--sensors", required=True, help="comma-separated, in the order that breaks ties")
    p.add_argument("--block-ms", type=int, default=1000)
    p.add_argument("--ttl-ms", type=int, default=50)
    p.add_argument("--watermark-timeout-ms", type=int, default=1000)
    p.add_argument("--debounce", type=int, default=3)
    p.add_argument("--lookback-secs", type=int, default=0)
    p.add_argument("--surface-ref-lat", type=float)
    p.add_argument("--surface-ref-lon", type=float)
    p.add_argument("--data-dir")
    p.add_argument("--path-template", default=Config.template)
    p.add_argument("--from", dest="start", type=_moment)
    p.add_argument("--to", dest="end", type=_moment)
    p.add_argument("--messages")
    p.add_argument("--table", required=True)
    p.add_argument("--stretch-minutes", type=int, help="recompute: write as it goes, and go on after a failure")
    return p


def from_args(argv: list[str]) -> tuple[str, Config]:
    """(mode, validated parameters) of a command line."""
    a = parser().parse_args(argv)
    if (a.surface_ref_lat is None) != (a.surface_ref_lon is None):
        raise ConfigError("a surface reference has a latitude and a longitude")
    reference = None if a.surface_ref_lat is None else (a.surface_ref_lat, a.surface_ref_lon)
    sensors = tuple(s.strip() for s in a.sensors.split(",") if s.strip())
    found = Config(sensors, a.block_ms, a.ttl_ms, a.watermark_timeout_ms, a.debounce, a.lookback_secs, reference=reference, data_dir=a.data_dir, template=a.path_template, start=a.start, end=a.end, messages=a.messages, table=a.table, stretch=a.stretch_minutes)
    return a.mode, found.validated(a.mode)

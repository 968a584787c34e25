from datetime import UTC, datetime

import pytest

from skyfold import config
from skyfold.config import Config, ConfigError

MINUTE = datetime(2026, 6, 27, 12, 0, tzinfo=UTC)


def test_blocks_are_those_that_never_cross_a_second_or_minute():
    """Held against the blocks themselves: laid side by side they meet every minute, and every second if shorter."""
    accepted = []
    for ms in range(-5, 120_001):
        try:
            config.validate_block(ms)
            accepted.append(ms)
        except ConfigError:
            pass
    assert accepted == [ms for ms in range(1, 60_001) if 60_000 % ms == 0 and (1000 % ms == 0 or ms % 1000 == 0)]
    assert len(accepted) == 16 + 11


@pytest.mark.parametrize("sensors", [[], ["XY7"], ["xy70"], ["7070"], ["XY70", "QQ11", "XY70"], ["XY701"], [" XY70"], ["XY70\n"], ["ÄY70"], [""]])
def test_bad_sensors(sensors):
    with pytest.raises(ConfigError):
        config.validate_sensors(sensors)


def test_alignment():
    config.validate_aligned("start", MINUTE)
    for at in (MINUTE.replace(second=1), MINUTE.replace(microsecond=1)):
        with pytest.raises(ConfigError):
            config.validate_aligned("start", at)


def test_templates():
    config.validate_template("%Y%m%d%H%M{sensor}.spkx")
    config.validate_template("%Y/%m/100%%-{sensor}")
    for bad in ("%Q", "%Y%", "%Y-%L"):
        with pytest.raises(ConfigError):
            config.validate_template(bad)


def test_paths():
    assert config.minute_path("/d/", "%Y%m%d%H%M{sensor}.spkx", MINUTE, "AB01") == "/d/202606271200AB01.spkx"
    assert config.minute_path("/d", "{sensor}/%Y/%m/%d/%H%M.spkx", MINUTE, "AB02") == "/d/AB02/2026/06/27/1200.spkx"


def test_command_line():
    mode, cfg = config.from_args(["recompute", "--sensors", "AB01,AB02", "--data-dir", "/d", "--from", "2026-06-27T12:00:00Z", "--to", "2026-06-27T12:02:00Z", "--table", "/t"])
    assert (mode, cfg.sensors, cfg.ttl_ms, cfg.debounce, cfg.lookback_s) == ("recompute", ("AB01", "AB02"), 50, 3, 0)
    assert [m.minute for m in cfg.minutes()] == [59, 0, 1]
    assert (cfg.block, cfg.ttl, cfg.quantum) == (10_000_000, 500_000, 500_000)


def test_parameters_that_belong_together():
    ok = ["--sensors", "AB01", "--table", "/t"]
    with pytest.raises(ConfigError):
        config.from_args(["realtime", *ok])
    with pytest.raises(ConfigError):
        config.from_args(["realtime", *ok, "--messages", "/m", "--surface-ref-lat", "51"])
    with pytest.raises(ConfigError):
        config.from_args(["recompute", *ok, "--data-dir", "/d", "--from", "2026-06-27T12:00Z", "--to", "2026-06-27T12:00Z"])
    with pytest.raises(ConfigError):
        config.from_args(["recompute", *ok, "--from", "2026-06-27T12:00Z", "--to", "2026-06-27T12:01Z"])
    with pytest.raises(ConfigError):
        Config(("AB01",), debounce=0).validated("realtime")

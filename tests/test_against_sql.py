"""Queries of the catalogue against their SQL, on events that few tables have."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from skyfold.functions import geo
from skyfold.plans import catalog


@pytest.fixture
def both(spark, tmp_path):
    """The rows of a query by Spark and by DuckDB over events of (event_id, ts, user_id, value)."""

    def run(name, events):
        con = duckdb.connect()
        con.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
        con.executemany("INSERT INTO events VALUES (?, ?, ?, 'click', ?, '{}')", events)
        con.execute(f"COPY events TO '{tmp_path}/events.parquet'")
        found = catalog.queries()[name](spark, str(tmp_path)).collect()
        return sorted(map(tuple, found)), sorted(con.execute(catalog.oracle_sql()[name]).fetchall())

    return run


def test_cpr_global(both):
    """No longitude without a latitude; -131.99589843749998 is printed as a tie at the tenth digit and lies below it."""
    found, asked = both("cpr_global", [(4680, "2024-01-02", 281, 77.43), (493296, "2024-01-28", 6039, 4.09), (7, "2024-01-01", 1, None)])
    assert found == asked
    assert found == [(7, None, None), (4680, None, None), (493296, 32.004089355, -131.995898437)]


def test_ev_trajectory_line(both):
    """6734736.7195 and 1975640.1475 lie below their shortest digits, which are ties."""
    events = [(1, "2024-01-01", 33, 63.69), (2, "2024-01-02", 33, 1.0), (3, "2024-01-03", 33, 2.5), (4, "2024-01-01", 11, 47.03), (5, "2024-01-02", 11, 47.03)]
    found, asked = both("ev_trajectory_line", events)
    assert found == asked
    assert [line.count(".719") + line.count("1975640.147") for _, _, line in found] == [2, 1]


def test_thousandths(spark):
    """As printf rounds: ties, their neighbours among doubles, and what lies at the ends."""
    draw = random.Random(5)
    ties = [(2 * draw.randrange(10**size) + 1) / 2000 for size in range(1, 11) for _ in range(100)] + [k / 16 for k in range(64)]
    near = [x for t in ties for x in (t, math.nextafter(t, 0), math.nextafter(t, math.inf))]
    rows = spark.createDataFrame([(x,) for y in [*near, 0.0, 5e-324, 2.0**43 - 0.0005, 1e13] for x in (y, -y)], "x double")
    found = rows.select("x", F.format_string("%.3f", geo.thousandths(F.col("x")))).collect()
    assert [text for _, text in found] == ["%.3f" % x for x, _ in found]
    ends = spark.createDataFrame([(math.inf,), (-math.inf,), (None,)], "x double").select(geo.thousandths(F.col("x"))).collect()
    assert [x for (x,) in ends] == [math.inf, -math.inf, None]

"""Queries of the last hours and days against their SQL, on a table that goes on after their moment."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from compare import differences
from wattloom.session import scratch_dir
from wattloom.suite.fixtures import AS_OF

QUERIES = [
    "evse_daily_load",
    "evse_daily_load_devices",
    "filter_recent",
    "filter_recent_days",
    "session_events_today",
    "temperature_per_minute",
    "temperature_per_minute_raw",
    "temperature_daily",
    "mart_last_7_days",
]


@pytest.fixture(scope="module")
def later(spark):
    """The smallest events, the last three days of them again 40 seconds and a day later."""
    folder = scratch_dir(spark, "later")
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    again = events.where("ts >= timestamp '2024-01-28'").selectExpr("event_id + 100000 as event_id", "ts + interval '1 00:00:40' day to second as ts", "* except (event_id, ts)")
    events.unionByName(again).coalesce(1).write.parquet(f"{folder}/events.parquet")
    con.execute(f"create view events as select * from '{folder}/events.parquet/*.parquet'")
    assert con.sql(f"select count(*) from events where ts > timestamp '{AS_OF}'").fetchall()[0][0] > 10
    return folder, con


@pytest.mark.parametrize("key", QUERIES)
def test_rows_after_the_moment_count_as_in_sql(spark, later, key):
    folder, con = later
    problems, rows = differences(queries()[key](spark, folder), con, oracle_sql()[key])
    assert problems == [] and rows > 0

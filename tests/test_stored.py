"""Distinct counts and moments that are stored per day and merged."""

import math
from collections import defaultdict
from datetime import date, datetime, timedelta
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from wattloom.operators import distinct, moments
from wattloom.session import scratch_dir

DAY = datetime(2024, 1, 1)
# Day, device, number; NULL values do not count, and day 3 has no others.
SEEN = [(d, f"v{(d * 37 + i * i) % 90}", i % 3) for d in (0, 1, 2, 5) for i in range(60)] + [(3, None, 1), (0, None, None), (1, "v1", None)]


def seen(spark, rows):
    rows = [(None if d is None else DAY + timedelta(days=d), v, n) for d, v, n in rows]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, device_id string, connector_id int")


def test_distinct_counts_against_brute_force(spark):
    path, columns = scratch_dir(spark, "distinct"), ["device_id", "connector_id"]
    # Days come out of order, one twice, and rows without a time belong to none.
    for days in ((5, 0), (1, 3), (2,), (0,)):
        distinct.note_days(seen(spark, [r for r in SEEN if r[0] in days] + [(None, "untimed", 1)]), path, columns)
    stored = distinct.read_days(spark, path)
    values = defaultdict(set)
    for d, *value in SEEN:
        values[d] |= {tuple(value)} if None not in value else set()
    plain = {(DAY + timedelta(days=d)).date(): len(v) for d, v in values.items()}
    assert {r["day"]: r["n"] for r in distinct.distinct_by_day(stored).collect()} == plain
    assert distinct.distinct_over(stored).first()["n"] == len(set().union(*values.values()))
    some = stored.where(F.col("day") >= date(2024, 1, 3))
    assert distinct.distinct_over(some).first()["n"] == len(values[2] | values[3] | values[5])
    rolling = {r["day"]: r["n"] for r in distinct.distinct_rolling(stored, 3).collect()}
    assert rolling == {
        (DAY + timedelta(days=d)).date(): len(set().union(*[values.get(d - back, set()) for back in range(3)])) for d in values
    }
    numbers = [r["id"] for r in spark.read.parquet(f"{path}/dictionary").collect()]
    assert len(numbers) == len(set(numbers)) and min(numbers) >= 0


def test_a_day_is_replaced_and_windows_read_no_rows(spark):
    path = scratch_dir(spark, "distinct")
    distinct.note_days(seen(spark, SEEN), path, ["device_id"])
    distinct.note_days(seen(spark, [(1, None, None)]), path, ["device_id"])
    stored = distinct.read_days(spark, path)
    assert {r["day"].day: r["n"] for r in distinct.distinct_by_day(stored).collect()}[2] == 0
    plan = distinct.distinct_over(stored.where(F.col("day") == date(2024, 1, 6)))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "device_id" not in plan
    with pytest.raises(ValueError):
        distinct.distinct_rolling(stored, 0)


def readings(spark, rows):
    return spark.createDataFrame([(k, None if d is None else DAY + timedelta(days=d), v) for k, d, v in rows], "device_id string, timestamp timestamp_ntz, value double")


READINGS = [(k, d, float((d * 7 + i * 13) % 10) + (60 if i == 4 and d == 4 else 0)) for k in ("a", None) for d in range(5) for i in range(8)]
READINGS += [("a", 2, None), ("once", 4, 1.0), ("a", None, 3.0)]


def expected(k, days):
    out = []
    for key, d, v in READINGS:
        past = [w for other, e, w in READINGS if other == key and w is not None and (days is None or None not in (d, e) and d - days <= e < d)]
        if v is not None and d in (4, None) and len(past) > 1 and abs(v - mean(past)) > k * stdev(past):
            out.append((key, d, v, mean(past), stdev(past)))
    return out


@pytest.mark.parametrize("days", [None, 2])
def test_outliers_of_new_days_against_brute_force(spark, days):
    path = scratch_dir(spark, "moments")
    for part in ({0, 1, 2}, {3, 4, None}, {4}):
        moments.write_moments(readings(spark, [r for r in READINGS if r[1] in part]), path, "value")
    new = readings(spark, [r for r in READINGS if r[1] in (4, None)])
    got = moments.outliers_of_days(new, moments.read_moments(spark, path), "value", 1.5, days=days).collect()
    want = expected(1.5, days)
    plain = lambda r: (r["device_id"], None if r["timestamp"] is None else (r["timestamp"] - DAY).days, r["value"])
    assert sorted(map(str, map(plain, got))) == sorted(str(r[:3]) for r in want) and want
    by_row = {str(r[:3]): r[3:] for r in want}
    for r in got:
        centre, spread = by_row[str(plain(r))]
        assert math.isclose(r["mean"], centre) and math.isclose(r["stddev"], spread)


def test_empty_days(spark):
    path = scratch_dir(spark, "moments")
    moments.write_moments(readings(spark, READINGS), path, "value")
    stored = moments.read_moments(spark, path)
    assert moments.outliers_of_days(readings(spark, []), stored, "value").count() == 0
    with pytest.raises(ValueError):
        moments.trailing_statistics(stored, 0)
    with pytest.raises(ValueError):
        moments.moments(readings(spark, []), "value", scale=7)

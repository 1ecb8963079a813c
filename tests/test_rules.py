"""Column rules and time helpers on hand-built rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattloom.functions import rules
from wattloom.functions.numbers import mean, ratio, total
from wattloom.functions.timestamps import bucket, from_epoch_ms, partition_columns, recent, since_midnight, time_range, to_epoch_ms


def column(spark, values, kind, expression):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_temperature_class(spark):
    got = column(spark, [44.99, 45.0, 59.99, 60.0, None], "double", rules.temperature_class)
    assert got == ["NORMAL", "HIGH", "HIGH", "CRITICAL", None]


def test_derate_ramp(spark):
    got = column(spark, [44.99, 45.0, 45.15, 52.5, 59.99, 60.0, 75.0, None], "double", rules.derate_percent)
    assert got == [None, 0.0, 1.0, 50.0, 99.9, 100.0, 100.0, None]


def test_derate_only_while_active(spark):
    df = spark.createDataFrame([(50.0, True), (50.0, False), (50.0, None)], "t double, a boolean")
    assert [r[0] for r in df.select(rules.derate_percent(F.col("t"), F.col("a"))).collect()] == [33.3, None, None]


@pytest.mark.parametrize(
    "state,fault,derate,effective,status",
    [
        ("CHARGING", True, 50.0, "FAULTED", "FAULTED"),
        ("CHARGING", False, 0.9, "CHARGING", "OK"),
        ("CHARGING", False, 1.0, "DERATED", "DERATED"),
        ("IDLE", False, 50.0, "IDLE", "OK"),
        ("CHARGING", False, None, "CHARGING", "OK"),
        ("FAULTED", False, None, "FAULTED", "FAULTED"),
    ],
)
def test_states(spark, state, fault, derate, effective, status):
    df = spark.createDataFrame([(state, fault, derate)], "s string, f boolean, d double")
    args = F.col("s"), F.col("f"), F.col("d")
    row = df.select(rules.effective_state(*args).alias("e"), rules.electrical_status(*args).alias("x")).first()
    assert (row["e"], row["x"]) == (effective, status)


def test_epoch_round_trip_and_partition_columns(spark):
    at = datetime(2024, 9, 1, 7, 59, 58, 123000)
    df = spark.createDataFrame([(at,)], "timestamp timestamp_ntz")
    row = df.select(
        to_epoch_ms("timestamp").alias("ms"), from_epoch_ms(to_epoch_ms("timestamp")).alias("back"), *partition_columns("timestamp")
    ).first()
    assert row["back"] == at
    assert (row["year"], row["month"], row["day"], row["hour"]) == (2024, 9, 1, 7)


def test_bucket_at_midnight(spark):
    rows = [(datetime(2024, 1, 1, 23, 59, 59, 999000),), (datetime(2024, 1, 2),)]
    got = spark.createDataFrame(rows, "t timestamp_ntz").select(bucket("hour", "t"), F.to_date("t")).collect()
    assert [r[0] for r in got] == [datetime(2024, 1, 1, 23), datetime(2024, 1, 2)]
    assert [str(r[1]) for r in got] == ["2024-01-01", "2024-01-02"]


def test_time_filters(spark):
    times = [datetime(2024, 1, 1, h) for h in (0, 6, 12, 18)] + [datetime(2024, 1, 2)]
    df = spark.createDataFrame([(t,) for t in times], "timestamp timestamp_ntz")
    assert recent(df, timedelta(hours=12), "2024-01-02 00:00:00").count() == 3
    assert since_midnight(df, 0, "2024-01-02 10:00:00").count() == 1
    assert since_midnight(df, 1, "2024-01-02 10:00:00").count() == 5
    assert time_range(df, "2024-01-01 06:00:00", "2024-01-01 18:00:00").count() == 2
    # Everything is in the past of the real clock.
    assert recent(df, timedelta(hours=1)).count() == 0


def test_exact_sums_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(v,) for v in [0.1] * 10 + [1e9, -1e9]], "x double")
    row = df.select(total("x", 4).alias("t"), mean("x", 4).alias("m")).first()
    assert row["t"] == 1.0 and row["m"] == 1.0 / 12
    empty = df.where("false").select(total("x", 4).alias("t"), mean("x", 4).alias("m"), ratio(F.count("x"), F.count("x")).alias("r")).first()
    assert (empty["t"], empty["m"], empty["r"]) == (None, None, None)


def test_derating_needs_a_range():
    with pytest.raises(ValueError):
        rules.derate_percent(F.lit(50.0), start=60.0, full=60.0)

"""Checks on hand-built rows."""

from datetime import datetime, timedelta

import pytest
from wattloom.operators import quality as dq

NAN = float("nan")


def table(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def found(df, predicate):
    return [r["x"] for r in dq.violations(df, predicate).collect()]


def test_row_predicates(spark):
    df = table(spark, [None, -1.0, 0.0, 1.0, 5.0])
    assert found(df, dq.missing_or_not_positive("x")) == [None, -1.0, 0.0]
    assert found(df, dq.below("x", 0)) == [-1.0]
    assert found(df, dq.above("x", 1)) == [5.0]
    assert found(df, dq.outside("x", 0, 1)) == [-1.0, 5.0]
    assert found(df, dq.missing("x")) == [None]
    assert found(df, dq.untrue("x >= 0 AND x <= 1")) == [-1.0, 5.0]
    assert len(found(table(spark, [NAN]), dq.above("x", 500))) == 1


def test_literal_forms_never_fire(spark):
    df = table(spark, [None, 1.0, 9.0])
    assert found(df, dq.missing_from("x", 5)) == []
    times = table(spark, [datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2030, 1, 1)], "timestamp_ntz")
    delay = timedelta(minutes=60)
    assert found(times, dq.stale_or_future("x", delay, "2024-01-02 00:30:00", strict=False)) == []
    assert len(found(times, dq.stale_or_future("x", delay, "2024-01-02 00:30:00"))) == 2


def test_guarded_null(spark):
    df = spark.createDataFrame([(1, 10.0, None), (2, 1.0, None), (3, 10.0, 1.0)], "i int, g double, x double")
    assert [r["i"] for r in dq.violations(df, dq.missing_from("x", 5, guard="g")).collect()] == [1]


@pytest.mark.parametrize("rows,expected,tolerance,fails", [(0, 0, 0, 0), (0, 10, 0.1, 1), (9, 10, 0.1, 0), (8, 10, 0.1, 1), (11, 10, 0.1, 0), (12, 10, 0.1, 1), (10, 10, 0, 0)])
def test_row_count(spark, rows, expected, tolerance, fails):
    assert dq.unexpected_row_count(spark.range(rows), expected, tolerance).count() == fails


def test_duplicates_group_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 2)], "k string, n int")
    assert [(r["k"], r["row_count"]) for r in dq.duplicate_keys(df, ["k", "n"]).collect()] == [(None, 2)]


def test_null_rate(spark):
    df = table(spark, [None, 1.0, 2.0, 3.0])
    assert dq.null_rate_above(df, "x", 0.25).count() == 0
    assert dq.null_rate_above(df, "x", 0.24).first().asDict() == {"total_count": 4, "null_count": 1, "null_rate": 0.25}
    assert dq.null_rate_above(df.where("false"), "x", 0.0).count() == 0


@pytest.mark.parametrize("task_rows", [10**9, 4])
def test_not_increasing(spark, task_rows):
    rows = [("a", 1, 10), ("a", 2, 10), ("a", 3, 0), ("a", 4, None), ("a", 5, 7), ("b", 1, 5), ("b", 6, 4)]
    df = spark.createDataFrame(rows, "k string, t int, x int").repartition(3)
    got = dq.not_increasing(df, "x", "t", ["k"], task_rows).collect()
    assert sorted((r["k"], r["x"], r["prev_x"]) for r in got) == [("a", 0, 10), ("b", 4, 5)]
    everything = dq.not_increasing(df, "x", ["t", "k"], (), task_rows).collect()
    assert sorted((r["x"], r["prev_x"]) for r in everything) == [(0, 10), (4, 7), (5, 10)]


@pytest.mark.parametrize("limits", [{}, {"task_rows": 5}])
def test_outliers(spark, limits):
    rows = [("a", float(v)) for v in [1] * 20 + [100]] + [("b", 5.0), ("c", None)] + [(None, float(v)) for v in [3] * 20 + [90]]
    df = spark.createDataFrame(rows, "device_id string, x double")
    for scale in (None, 4):
        got = dq.outliers(df, "x", 3.0, scale=scale, **limits).collect()
        assert sorted((r["device_id"] or "", r["x"]) for r in got) == [("", 90.0), ("a", 100.0)]


def test_contract(spark):
    from wattloom.contracts import table_schema

    schema = table_schema("temperature")
    at = datetime(2024, 1, 1)
    rows = [("d", at, 1.0, "C", None, "NORMAL"), ("d", at, 1.0, "c", None, "NORMAL"), (None, at, None, "X", None, None)]
    got = {(r["column_name"], r["rule"]): r["violations"] for r in dq.validate_contract(spark.createDataFrame(rows, schema), "temperature").collect()}
    assert got == {
        ("device_id", "required"): 1, ("timestamp", "required"): 0, ("value_celsius", "required"): 1, ("unit", "required"): 0,
        ("status", "required"): 1, ("unit", "enum"): 2, ("status", "enum"): 0,
    }


def test_suite_report_and_single_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, [None, -1.0, 5.0]).write.parquet(path)
    df = spark.read.parquet(path)
    checks = [
        dq.Check("present", "t", dq.missing("x"), severity="error"),
        dq.Check("positive", "t", dq.below("x", 0)),
        dq.Check("small", "t", dq.above("x", 10)),
    ]
    report = dq.run_checks({"t": df}, checks)
    assert {r["name"]: (r["severity"], r["failures"], r["status"]) for r in report.collect()} == {
        "present": ("error", 1, "error"), "positive": ("warn", 1, "warn"), "small": ("warn", 0, "pass"),
    }
    planned = dq.run_checks({"t": df}, checks)._jdf.queryExecution().sparkPlan().toString()
    assert planned.count("FileScan") == 1
    table_check = dq.Check("unique", "t", lambda d: dq.duplicate_keys(d, ["x"]))
    assert dq.run_checks({"t": df}, [*checks, table_check]).count() == 4


def test_standard_checks_fire(spark):
    electrical = spark.createDataFrame(
        [(10.0, 240.0, 50.0, 0.9, 20.0), (12.0, 240.0, 50.0, 0.4, 20.0), (30.0, 240.0, 50.0, None, 151.0), (5.0, 0.0, 50.0, None, None)],
        "power_kw double, voltage_v double, current_a double, power_factor double, temperature_cabinet_c double",
    )
    assert dq.violations(electrical, dq.electrical_out_of_limits()).count() == 2
    assert [r["power_kw"] for r in dq.violations(electrical, dq.power_implausible()).collect()] == [10.0, 30.0]
    temperature = spark.createDataFrame([(125.0, "C"), (125.1, "C"), (-40.1, "C"), (1.0, None)], "value_celsius double, unit string")
    assert dq.violations(temperature, dq.temperature_out_of_limits()).count() == 3


def test_missing_and_mistyped_columns_break_the_contract(spark):
    from wattloom.contracts import table_schema

    schema = table_schema("temperature")
    rows = spark.createDataFrame([("d", None, 1.0, "C", None, "NORMAL")] * 3, schema)
    found = {(r.column_name, r.rule): r.violations for r in dq.validate_contract(rows.drop("device_id"), "temperature").collect()}
    assert found["device_id", "required"] == 3 and found["timestamp", "required"] == 3
    assert not any(rule == "type" for _, rule in found)
    mistyped = dq.validate_contract(rows.withColumn("value_celsius", rows.value_celsius.cast("string")), "temperature").collect()
    assert [(r.column_name, r.violations) for r in mistyped if r.rule == "type"] == [("value_celsius", 3)]


def test_checks_by_tag_and_name():
    checks = [dq.Check("a", "t", dq.missing("x")), dq.Check("b", "t", dq.missing("x"), tag="hourly")]
    assert [c.name for c in dq.select_checks(checks, tags=["hourly"])] == ["b"]
    assert [c.name for c in dq.select_checks(checks, names=["a", "b"], tags=["daily"])] == ["a"]
    assert dq.select_checks(checks) == checks

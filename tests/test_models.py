"""Staging limits, the mart and the model graph on hand-built rows."""

from datetime import date, datetime

import pytest

from wattloom.contracts import STREAMS, raw_schema, table_schema
from wattloom.operators import aggregates, staging
from wattloom.operators.quality import mart_implausible, violations
from wattloom.plans.models import MODELS, Model, model_ref, run_models, run_order
from wattloom.session import scratch_dir

NAN = float("nan")
AT = datetime(2024, 1, 1, 12)


def stream(spark, name, *rows):
    """Rows given as dictionaries; what is left out is NULL."""
    schema = table_schema(name)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def electrical(spark, *rows):
    base = {"device_id": "d", "asset_id": "a", "timestamp": AT, "power_kw": 5.0, "voltage_v": 240.0, "current_a": 20.0}
    return stream(spark, "evse_electrical", *[base | r for r in rows])


def test_temperature_limits(spark):
    values = [-40.0, 85.0, -40.01, 85.01, 125.0, None, NAN]
    df = stream(spark, "temperature", *[{"device_id": "d", "timestamp": AT, "value_celsius": v} for v in values])
    got = staging.stage_temperature(df).collect()
    assert sorted(r["temperature_c"] for r in got) == [-40.0, 85.0]
    assert (got[0]["day"], got[0]["hour"]) == (date(2024, 1, 1), 12)
    assert staging.stage_temperature(df, max_c=125).count() == 4


@pytest.mark.parametrize("column,low,high", [("power_kw", 0, 500), ("voltage_v", 0, 1000), ("current_a", 0, 500)])
def test_electrical_limits(spark, column, low, high):
    values = [float(low), float(high), low - 0.1, high + 0.1, None, NAN]
    got = staging.stage_electrical(electrical(spark, *[{column: v} for v in values]))
    assert sorted(r[column] for r in got.collect()) == [low, high]
    assert got.columns[0] == "timestamp" and len(got.columns) == 15


@pytest.mark.parametrize(
    "name,stage,column,high",
    [
        ("humidity", staging.stage_humidity, "relative_humidity_pct", 100.0),
        ("vibration", staging.stage_vibration, "rms_acceleration", 50.0),
    ],
)
def test_sensor_limits(spark, name, stage, column, high):
    df = stream(spark, name, *[{"timestamp": AT, column: v} for v in (0.0, high, -0.1, high + 0.1, None, NAN)])
    assert sorted(r[column] for r in stage(df).collect()) == [0.0, high]


def test_unfiltered_staging_keeps_rows(spark):
    for name, stage in (("evse_state", staging.stage_state), ("evse_session_event", staging.stage_session_event)):
        got = stage(stream(spark, name, {}, {"device_id": "d"}))
        assert got.count() == 2 and set(got.columns) == set(table_schema(name).names)


def test_mart_groups_and_nulls(spark):
    df = electrical(
        spark,
        {"timestamp": datetime(2024, 1, 1, 23, 59, 59, 999000), "power_kw": 2.0},
        {"timestamp": datetime(2024, 1, 2), "power_kw": 4.0, "derate_pct": 7.0},
        {"timestamp": datetime(2024, 1, 2, 1), "power_kw": 6.0},
        {"timestamp": datetime(2024, 1, 2, 2), "power_kw": 0.0},
    )
    first, second = sorted(aggregates.power_daily(df).collect(), key=lambda r: r["day"])
    assert (first["reading_count"], first["total_energy_kwh"], first["max_derate_pct"], first["avg_power_factor"]) == (1, 2.0, None, None)
    assert (second["reading_count"], second["avg_power_kw"], second["max_derate_pct"]) == (2, 5.0, 7.0)


def test_mart_check_and_last_bit(spark):
    mart = aggregates.power_daily(electrical(spark, *[{"power_kw": 0.1}] * 3))
    assert violations(mart, mart_implausible()).count() == 1
    assert violations(mart, mart_implausible(1e-9)).count() == 0
    assert violations(aggregates.power_daily(electrical(spark, *[{"power_kw": 0.1}] * 3), scale=4), mart_implausible()).count() == 0
    assert violations(aggregates.power_daily(electrical(spark, {})), mart_implausible()).count() == 0


def test_contract_schemas():
    for name in STREAMS:
        assert raw_schema(name)["timestamp"].dataType.simpleString() == "bigint"
        assert table_schema(name)["timestamp"].dataType.simpleString() == "timestamp_ntz"
    assert [len(table_schema(n)) for n in STREAMS] == [6, 5, 6, 15, 13, 14]


def test_run_order():
    order = run_order()
    assert order.index("stg_evse_electrical") < order.index("mart_evse_power_daily")
    assert set(order) == set(MODELS)
    assert run_order(["mart_evse_power_daily"]) == ["mart_evse_power_daily"]
    with pytest.raises(KeyError):
        run_order(["nope"])


def test_run_models_select_and_view(spark):
    df = electrical(spark, {}, {"power_kw": 900.0})
    source = {"evse_electrical": df}.__getitem__
    root = scratch_dir(spark, "models")
    built = run_models(spark, source, root, ["mart_evse_power_daily"])
    assert list(built) == ["mart_evse_power_daily"]
    assert built["mart_evse_power_daily"].first()["reading_count"] == 1
    assert model_ref("mart_evse_power_daily", source).count() == 1
    # Running again replaces the model.
    assert run_models(spark, source, root, ["mart_evse_power_daily"])["mart_evse_power_daily"].count() == 1
    view = Model("test_view_model", ("evse_electrical",), staging.stage_electrical, materialized="view")
    assert run_models(spark, source, root, None, {"test_view_model": view})["test_view_model"].count() == 1
    spark.catalog.dropTempView("test_view_model")

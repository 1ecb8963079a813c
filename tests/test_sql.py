"""Ad-hoc SQL over the registered views gives what the operators give."""

from datetime import timedelta

import pytest

from wattloom.functions.timestamps import recent
from wattloom.operators import aggregates as agg
from wattloom.operators import latest
from wattloom.plans.models import MODELS
from wattloom.plans.views import register_views
from wattloom.suite.fixtures import AS_OF, read_stream

NOW = f"timestamp_ntz '{AS_OF}'"


@pytest.fixture(scope="module")
def streams(spark):
    def source(name):
        return read_stream(spark, "/root/testdata/sf0.001", name)

    names = register_views(spark, source)
    assert set(MODELS) < set(names) and len(names) == 13
    yield source
    for name in names:
        spark.catalog.dropTempView(name)


CASES = {
    "per minute": (
        f"select cast(date_trunc('minute', timestamp) as timestamp_ntz) ts, round(avg(value_celsius), 2) avg_temp_c, max(value_celsius) max_temp_c, "
        f"count(*) n from temperature where timestamp >= {NOW} - interval '12' hour group by 1 order by 1 desc",
        lambda s: agg.temperature_per_minute(s("temperature"), timedelta(hours=12), AS_OF),
    ),
    "per day": (
        f"select cast(timestamp as date) day, round(min(value_celsius), 2) min_temp_c, round(max(value_celsius), 2) max_temp_c, "
        f"round(avg(value_celsius), 2) avg_temp_c from temperature where timestamp >= cast({NOW} as date) - interval '7' day group by 1",
        lambda s: agg.temperature_daily(s("temperature"), 7, AS_OF),
    ),
    "humidity": (
        "select cast(date_trunc('hour', timestamp) as timestamp_ntz) hour, round(avg(relative_humidity_pct), 1) avg_humidity_pct, "
        "round(avg(dew_point_c), 1) avg_dew_point_c from humidity group by 1 order by 1 desc limit 24",
        lambda s: agg.humidity_hourly(s("humidity")),
    ),
    "load": (
        f"select cast(timestamp as date) day, count(distinct connector_id) connectors, round(sum(power_kw), 2) kwh_est, "
        f"round(avg(voltage_v), 1) avg_volts, round(avg(current_a), 2) avg_amps from evse_electrical "
        f"where timestamp >= {NOW} - interval '24' hour group by 1",
        lambda s: agg.daily_load(s("evse_electrical"), as_of=AS_OF),
    ),
    "faults": (
        "select timestamp, device_id, state, fault_code, derate_pct, charger_temp_c from evse_state where fault_active = true "
        "order by timestamp desc limit 100",
        lambda s: latest.latest_faults(s("evse_state")),
    ),
    "sessions": (
        "select cast(date_trunc('hour', timestamp) as timestamp_ntz) hour, event_type, severity, count(*) n from evse_session_event group by 1, 2, 3",
        lambda s: agg.session_events_hourly(s("evse_session_event")),
    ),
    "mart": (
        f"select day, device_id, avg(avg_power_kw) avg_power, sum(total_energy_kwh) total_energy, max(max_power_kw) max_power "
        f"from mart_evse_power_daily where day >= cast({NOW} as date) - interval '7' day group by day, device_id",
        lambda s: agg.mart_recent_days(MODELS["mart_evse_power_daily"].build(MODELS["stg_evse_electrical"].build(s("evse_electrical"))), 7, AS_OF),
    ),
}


def rows(df, columns):
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name", CASES)
def test_sql_equals_operator(spark, streams, name):
    sql, operator = CASES[name]
    got, expected = spark.sql(sql), operator(streams)
    found = rows(got, expected.columns)
    assert found == rows(expected, expected.columns) and found


def test_now_based_sql_runs(spark, streams):
    sql = "select count(*) n from temperature where timestamp >= now() - interval '1' hour or timestamp >= current_date - interval '7' day"
    assert spark.sql(sql).first()["n"] == 0 == recent(streams("temperature"), timedelta(hours=1)).count()

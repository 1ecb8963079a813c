"""Data-quality checks."""

from __future__ import annotations

from datetime import timedelta
from functools import partial

from pyspark.sql import functions as F

from wattloom.contracts import STREAMS, allowed_values, required_columns
from wattloom.operators import moments, staging
from wattloom.operators import quality as dq
from wattloom.operators.aggregates import power_daily, union_labelled
from wattloom.suite.aggregates import MART
from wattloom.suite.models import ELECTRICAL
from wattloom.suite.registry import query

MID = "2024-01-15 00:00:00"


@query("dq_not_null_and_positive", "select * from evse_electrical where power_kw is null or power_kw <= 0", ("evse_electrical",))
def _(s):
    return dq.violations(s("evse_electrical"), dq.missing_or_not_positive("power_kw"))


@query("dq_at_least", "select * from humidity where dew_point_c is not null and dew_point_c < 0", ("humidity",))
def _(s):
    return dq.violations(s("humidity"), dq.below("dew_point_c", 0))


@query("dq_at_most", "select * from vibration where rms_acceleration is not null and rms_acceleration > 20", ("vibration",))
def _(s):
    return dq.violations(s("vibration"), dq.above("rms_acceleration", 20))


@query("dq_in_range", "select * from temperature where value_celsius < -40 or value_celsius > 85", ("temperature",))
def _(s):
    return dq.violations(s("temperature"), dq.outside("value_celsius", -40, 85))


@query("dq_no_nulls", "select * from temperature where unit is null", ("temperature",))
def _(s):
    return dq.violations(s("temperature"), dq.missing("unit"))


@query(
    "dq_nonnull_from_threshold",
    "select * from evse_electrical where current_a > 100 and power_factor is null",
    ("evse_electrical",),
)
def _(s):
    return dq.violations(s("evse_electrical"), dq.missing_from("power_factor", 100, guard="current_a"))


@query(
    "dq_monotonic_increasing",
    """, seen as (select device_id, energy_kwh_total, lag(energy_kwh_total) over (partition by device_id order by timestamp)
 as prev_energy_kwh_total from evse_electrical)
select * from seen where prev_energy_kwh_total is not null and energy_kwh_total < prev_energy_kwh_total""",
    ("evse_electrical",),
)
def _(s):
    return dq.not_increasing(s("evse_electrical"), "energy_kwh_total", "timestamp", ["device_id"])


@query(
    "dq_monotonic_increasing_global",
    """, seen as (select energy_kwh_total, lag(energy_kwh_total) over (order by timestamp, device_id) as prev_energy_kwh_total
 from evse_electrical)
select * from seen where prev_energy_kwh_total is not null and energy_kwh_total < prev_energy_kwh_total""",
    ("evse_electrical",),
)
def _(s):
    return dq.not_increasing(s("evse_electrical"), "energy_kwh_total", ["timestamp", "device_id"])


@query(
    "dq_expected_row_count",
    ", counted as (select count(*) as cnt from temperature) select cnt from counted where cnt < 100 * 0.9 or cnt > 100 * 1.1",
    ("temperature",),
)
def _(s):
    return dq.unexpected_row_count(s("temperature"), 100, 0.1)


@query(
    "dq_no_duplicate_keys",
    """select session_id, event_type, count(*) as row_count from evse_session_event group by session_id, event_type
having count(*) > 1""",
    ("evse_session_event",),
)
def _(s):
    return dq.duplicate_keys(s("evse_session_event"), ["session_id", "event_type"])


@query(
    "dq_temporal_consistency",
    f"""select * from temperature where timestamp < timestamp '{MID}' - interval 1440 minute or timestamp > timestamp '{MID}'""",
    ("temperature",),
)
def _(s):
    return dq.violations(s("temperature"), dq.stale_or_future("timestamp", timedelta(minutes=1440), MID))


NULL_RATE = """select *, null_count / cast(total_count as double) as null_rate
from (select count(*) as total_count, count(*) - count({column}) as null_count from {table})
where total_count > 0 and null_count / cast(total_count as double) > {limit}"""


@query(
    "dq_null_rate_under_threshold", NULL_RATE.format(table="temperature", column="unit", limit=0.1), ("temperature",)
)
def _(s):
    return dq.null_rate_above(s("temperature"), "unit", 0.1)


@query("cross_join_scalars", NULL_RATE.format(table="humidity", column="relative_humidity_pct", limit=0.01), ("humidity",))
def _(s):
    # One pass with two conditional counts takes the place of joining two scalars.
    return dq.null_rate_above(s("humidity"), "relative_humidity_pct", 0.01)


@query(
    "test_mart_positive",
    f"{MART} select * from mart where avg_power_kw <= 0 or total_energy_kwh <= 0 or avg_power_kw > max_power_kw",
    ("evse_electrical",),
)
def _(s):
    mart = power_daily(staging.stage_electrical(s("evse_electrical")), scale=4)
    return dq.violations(mart, dq.mart_implausible())


# Limits that the staging model already enforces are taken from it.
ELECTRICAL_LIMITS = " or ".join(
    f"{column} not between {low} and {high}"
    for column, (low, high) in {
        **{c: staging.LIMITS[c] for c in ("power_kw", "voltage_v", "current_a")}, "power_factor": (0.5, 1), "temperature_cabinet_c": (-40, 150)
    }.items()
)
PLAUSIBLE = """voltage_v > 0 and current_a > 0 and (power_kw > voltage_v * current_a / 1000 * 1.1
 or power_kw < voltage_v * current_a / 1000 * 0.9)"""
STAGED = f", staged as ({ELECTRICAL})"


@query("test_electrical_quality", f"{STAGED} select * from staged where {ELECTRICAL_LIMITS}", ("evse_electrical",))
def _(s):
    return dq.violations(staging.stage_electrical(s("evse_electrical")), dq.electrical_out_of_limits())


@query("test_power_reasonable", f"{STAGED} select * from staged where {PLAUSIBLE}", ("evse_electrical",))
def _(s):
    return dq.violations(staging.stage_electrical(s("evse_electrical")), dq.power_implausible())


@query(
    "test_temperature_quality",
    "select * from temperature where value_celsius < -40 or value_celsius > 125 or unit is null",
    ("temperature",),
)
def _(s):
    return dq.violations(s("temperature"), dq.temperature_out_of_limits())


@query(
    "dq_expression_is_true",
    "select * from evse_electrical where not (current_a >= 0 and current_a <= 300)",
    ("evse_electrical",),
)
def _(s):
    return dq.violations(s("evse_electrical"), dq.untrue("current_a >= 0 AND current_a <= 300"))


def contract_sql() -> str:
    parts = []
    for stream in STREAMS:
        rules = [(c, "required", f"{c} is null") for c in required_columns(stream)]
        rules += [(c, "enum", f"{c} not in {values}") for c, values in allowed_values(stream).items()]
        parts += [
            f"select '{stream}' as stream, '{c}' as column_name, '{rule}' as rule, count(case when {test} then 1 end) as violations from {stream}"
            for c, rule, test in rules
        ]
    return " union all ".join(parts)


@query("validate_contract", contract_sql(), STREAMS)
def _(s):
    return union_labelled({stream: dq.validate_contract(s(stream), stream) for stream in STREAMS})


@query(
    "dq_outliers",
    """, stats as (select device_id, count(value_celsius) as n, cast(sum(cast(value_celsius as decimal(12,4))) as double) as s1,
 cast(sum(cast(value_celsius as decimal(12,4)) * cast(value_celsius as decimal(12,4))) as double) as s2 from temperature group by device_id),
bounds as (select device_id, s1 / n as mean, case when n > 1 then sqrt(greatest(0, (s2 - s1 * s1 / n) / (n - 1))) end as stddev from stats)
select t.device_id, t.timestamp, t.value_celsius, b.mean, b.stddev from temperature t join bounds b on t.device_id = b.device_id
where abs(t.value_celsius - b.mean) > 3 * b.stddev""",
    ("temperature",),
)
def _(s):
    needed = s("temperature").select("device_id", "timestamp", "value_celsius")
    return dq.outliers(needed, "value_celsius", 3.0, scale=4)


def temperature_moments(s):
    """Stored moments of the temperature stream, written in two parts of days."""
    path, rows = s.scratch("moments"), s("temperature")
    for part in ("timestamp < timestamp_ntz'2024-01-20'", "timestamp >= timestamp_ntz'2024-01-20'"):
        moments.write_moments(rows.where(part), path, "value_celsius")
    return moments.read_moments(s.spark, path)


NEW_DAYS = "timestamp >= timestamp '2024-01-20'"


@query(
    "dq_outliers_stored",
    f""", stats as (select device_id, count(value_celsius) as n, cast(sum(cast(value_celsius as decimal(12,4))) as double) as s1,
 cast(sum(cast(value_celsius as decimal(12,4)) * cast(value_celsius as decimal(12,4))) as double) as s2 from temperature group by device_id)
select t.device_id, t.timestamp, t.value_celsius, s1 / n as mean, sqrt(greatest(0, (s2 - s1 * s1 / n) / (n - 1))) as stddev
from temperature t join stats using (device_id)
where {NEW_DAYS} and n > 1 and abs(t.value_celsius - s1 / n) > 2 * sqrt(greatest(0, (s2 - s1 * s1 / n) / (n - 1)))""",
    ("temperature",),
)
def _(s):
    new = s("temperature").select("device_id", "timestamp", "value_celsius").where(NEW_DAYS.replace("timestamp '", "timestamp_ntz'"))
    return moments.outliers_of_days(new, temperature_moments(s), "value_celsius", 2.0)


@query(
    "dq_outliers_trailing",
    f""", days as (select distinct device_id, cast(timestamp as date) as day from temperature where value_celsius is not null),
stats as (select d.device_id, d.day, count(*) as n, cast(sum(cast(value_celsius as decimal(12,4))) as double) as s1,
 cast(sum(cast(value_celsius as decimal(12,4)) * cast(value_celsius as decimal(12,4))) as double) as s2 from days d join temperature t
 on t.device_id = d.device_id and cast(t.timestamp as date) between d.day - 14 and d.day - 1 where value_celsius is not null group by 1, 2)
select t.device_id, t.timestamp, t.value_celsius, s1 / n as mean, sqrt(greatest(0, (s2 - s1 * s1 / n) / (n - 1))) as stddev
from temperature t join stats s on t.device_id = s.device_id and cast(t.timestamp as date) = s.day
where {NEW_DAYS} and n > 1 and abs(t.value_celsius - s1 / n) > 2 * sqrt(greatest(0, (s2 - s1 * s1 / n) / (n - 1)))""",
    ("temperature",),
)
def _(s):
    new = s("temperature").select("device_id", "timestamp", "value_celsius").where(NEW_DAYS.replace("timestamp '", "timestamp_ntz'"))
    return moments.outliers_of_days(new, temperature_moments(s), "value_celsius", 2.0, days=14)


SUITE = f"""{STAGED}, results as (
select 'electrical_limits' as name, count(*) as failures from staged where {ELECTRICAL_LIMITS}
union all select 'electrical_power_plausible', count(*) from staged where {PLAUSIBLE}
union all select 'temperature_limits', count(*) from temperature where value_celsius between -40 and 85
 and (value_celsius < -40 or value_celsius > 125 or unit is null)
union all select 'mart_power_positive', 0
union all select 'session_duplicates', count(*) from (select session_id, event_type from evse_session_event group by 1, 2 having count(*) > 1))
select name, case when name = 'session_duplicates' then 'error' else 'warn' end as severity, 'daily' as tag, failures,
 case when failures = 0 then 'pass' when name = 'session_duplicates' then 'error' else 'warn' end as status from results"""


@query("run_checks", SUITE, ("evse_electrical", "temperature", "evse_session_event"))
def _(s):
    electrical = staging.stage_electrical(s("evse_electrical"))
    tables = {
        "stg_evse_electrical": electrical,
        "stg_temperature": staging.stage_temperature(s("temperature")),
        "mart_evse_power_daily": power_daily(electrical, scale=4),
        "evse_session_event": s("evse_session_event"),
    }
    duplicates = partial(dq.duplicate_keys, keys=["session_id", "event_type"])
    return dq.run_checks(
        tables, [*dq.standard_checks(), dq.Check("session_duplicates", "evse_session_event", duplicates, severity="error")]
    )

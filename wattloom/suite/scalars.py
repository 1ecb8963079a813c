"""Scalar functions and expressions, each over a whole stream."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from wattloom.functions import rules
from wattloom.functions.numbers import ratio, rounded
from wattloom.functions.timestamps import bucket, from_epoch_ms, moment, partition_columns, to_epoch_ms
from wattloom.suite.fixtures import AS_OF
from wattloom.suite.registry import query

KEY = ("device_id", "timestamp")


@query(
    "cast_types",
    """select device_id, timestamp, cast(connector_id as string) as connector_text, cast(uptime_s as double) as uptime_double,
 cast(cast(uptime_s as string) as bigint) as uptime_long, cast(available as integer) as available_int,
 cast(timestamp as date) as day, cast(charger_temp_c as float) as temp_float,
 cast(cast(cast(timestamp as date) as string) as timestamp) as midnight,
 cast(cast(fault_active as integer) as boolean) as fault_bool from evse_state""",
    ("evse_state",),
)
def _(s):
    return s("evse_state").select(
        *KEY,
        F.col("connector_id").cast("string").alias("connector_text"),
        F.col("uptime_s").cast("double").alias("uptime_double"),
        F.col("uptime_s").cast("string").cast("long").alias("uptime_long"),
        F.col("available").cast("int").alias("available_int"),
        F.col("timestamp").cast("date").alias("day"),
        F.col("charger_temp_c").cast("float").alias("temp_float"),
        F.to_date("timestamp").cast("string").cast("timestamp_ntz").alias("midnight"),
        F.col("fault_active").cast("int").cast("boolean").alias("fault_bool"),
    )


@query("to_date_fn", "select device_id, timestamp, cast(timestamp as date) as day from humidity", ("humidity",))
def _(s):
    return s("humidity").select(*KEY, F.to_date("timestamp").alias("day"))


@query("extract_hour", "select device_id, timestamp, cast(extract(hour from timestamp) as integer) as hour from humidity", ("humidity",))
def _(s):
    return s("humidity").select(*KEY, F.hour("timestamp").alias("hour"))


@query(
    "date_trunc_bucket",
    """select device_id, timestamp, cast(date_trunc('minute', timestamp) as timestamp) as minute,
 cast(date_trunc('hour', timestamp) as timestamp) as hour from temperature""",
    ("temperature",),
)
def _(s):
    return s("temperature").select(*KEY, bucket("minute", "timestamp").alias("minute"), bucket("hour", "timestamp").alias("hour"))


@query(
    "epoch_ms",
    """select device_id, epoch_us(timestamp) // 1000 as ms, make_timestamp(epoch_us(timestamp) // 1000 * 1000) as ts from temperature""",
    ("temperature",),
)
def _(s):
    landed = s("temperature").select("device_id", to_epoch_ms("timestamp").alias("ms"))
    return landed.withColumn("ts", from_epoch_ms("ms"))


@query(
    "round_digits",
    """select device_id, timestamp, round(derate_pct, 1) as derate_1, round(derate_pct, 2) as derate_2
from evse_electrical where derate_pct is not null""",
    ("evse_electrical",),
)
def _(s):
    derate = F.col("derate_pct")
    return (
        s("evse_electrical")
        .where(derate.isNotNull())
        .select(*KEY, rounded(derate, 1).alias("derate_1"), rounded(derate, 2).alias("derate_2"))
    )


@query(
    "interval_arith",
    f"""select device_id, timestamp, timestamp + interval 1 hour as later, timestamp - interval 7 day as week_before,
 timestamp >= timestamp '{AS_OF}' - interval 24 hour as is_recent from temperature""",
    ("temperature",),
)
def _(s):
    at = F.col("timestamp")
    return s("temperature").select(
        *KEY,
        (at + F.lit(timedelta(hours=1))).alias("later"),
        (at - F.lit(timedelta(days=7))).alias("week_before"),
        (at >= moment(AS_OF) - F.lit(timedelta(hours=24))).alias("is_recent"),
    )


@query(
    "arith",
    """select device_id, timestamp, voltage_v * current_a / 1000 * 1.1 as upper_kw, voltage_v * current_a / 1000 * 0.9 as lower_kw,
 power_kw - energy_kwh_total as difference, power_kw + current_a as total from evse_electrical""",
    ("evse_electrical",),
)
def _(s):
    kw = F.col("voltage_v") * F.col("current_a") / F.lit(1000)
    return s("evse_electrical").select(
        *KEY,
        (kw * 1.1).alias("upper_kw"),
        (kw * 0.9).alias("lower_kw"),
        (F.col("power_kw") - F.col("energy_kwh_total")).alias("difference"),
        (F.col("power_kw") + F.col("current_a")).alias("total"),
    )


@query(
    "bool_logic",
    """select device_id, timestamp, voltage_v, power_factor from evse_electrical
where voltage_v is null or power_factor is not null and (power_factor < 0.5 or power_factor > 0.95)""",
    ("evse_electrical",),
)
def _(s):
    pf = F.col("power_factor")
    kept = s("evse_electrical").where(F.col("voltage_v").isNull() | pf.isNotNull() & ((pf < 0.5) | (pf > 0.95)))
    return kept.select(*KEY, "voltage_v", "power_factor")


@query(
    "compare",
    """select device_id, timestamp, value_celsius = 0 as eq, value_celsius < 0 as lt, value_celsius <= 0 as le,
 value_celsius > 0 as gt, value_celsius >= 0 as ge from temperature""",
    ("temperature",),
)
def _(s):
    v = F.col("value_celsius")
    return s("temperature").select(
        *KEY, (v == 0).alias("eq"), (v < 0).alias("lt"), (v <= 0).alias("le"), (v > 0).alias("gt"), (v >= 0).alias("ge")
    )


@query(
    "ratio",
    """select location, cast(count(case when relative_humidity_pct is null then 1 end) as double) / cast(count(*) as double) as null_rate
from humidity group by location""",
    ("humidity",),
)
def _(s):
    nulls = F.count(F.when(F.col("relative_humidity_pct").isNull(), F.lit(1)))
    return s("humidity").groupBy("location").agg(ratio(nulls, F.count(F.lit(1))).alias("null_rate"))


@query("literal_label", "select 'vibration' as stream, device_id, timestamp from vibration", ("vibration",))
def _(s):
    return s("vibration").select(F.lit("vibration").alias("stream"), *KEY)


@query(
    "classify_temperature",
    """select device_id, timestamp, case when value_celsius >= 60 then 'CRITICAL' when value_celsius >= 45 then 'HIGH'
 when value_celsius is not null then 'NORMAL' end as class from temperature""",
    ("temperature",),
)
def _(s):
    return s("temperature").select(*KEY, rules.temperature_class(F.col("value_celsius")).alias("class"))


@query(
    "derate_pct",
    """select device_id, timestamp, case when state = 'CHARGING' and not fault_active then
 case when charger_temp_c >= 60 then cast(100 as double) when charger_temp_c >= 45 then (charger_temp_c - 45) * 100 / 15 end end as derate
from evse_state""",
    ("evse_state",),
)
def _(s):
    active = (F.col("state") == "CHARGING") & ~F.col("fault_active")
    return s("evse_state").select(*KEY, rules.derate_percent(F.col("charger_temp_c"), active, digits=None).alias("derate"))


@query(
    "effective_state",
    """select device_id, timestamp, case when fault_active then 'FAULTED' when state = 'CHARGING' and derate_pct >= 1 then 'DERATED'
 else state end as effective_state from evse_state""",
    ("evse_state",),
)
def _(s):
    value = rules.effective_state(F.col("state"), F.col("fault_active"), F.col("derate_pct"))
    return s("evse_state").select(*KEY, value.alias("effective_state"))


@query(
    "electrical_status",
    """select device_id, timestamp, case when fault_active or state = 'FAULTED' then 'FAULTED'
 when state = 'CHARGING' and derate_pct >= 1 then 'DERATED' else 'OK' end as status from evse_state""",
    ("evse_state",),
)
def _(s):
    value = rules.electrical_status(F.col("state"), F.col("fault_active"), F.col("derate_pct"))
    return s("evse_state").select(*KEY, value.alias("status"))


@query(
    "partition_columns",
    """select device_id, timestamp, cast(year(timestamp) as integer) as year, cast(month(timestamp) as integer) as month,
 cast(day(timestamp) as integer) as day, cast(hour(timestamp) as integer) as hour from temperature""",
    ("temperature",),
)
def _(s):
    return s("temperature").select(*KEY, *partition_columns("timestamp"))

"""The telemetry streams as views of the test tables' ``events``.

Each statement is valid in Spark and in the SQL engine the results are compared with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STREAM_SQL = {
    "temperature": """
select 'sensor-' || cast(user_id as string) as device_id, ts as timestamp,
 value - 45 as value_celsius, case when event_type = 'error' then null else 'C' end as unit,
 case when event_id % 7 = 0 then null else cast(event_id % 50 as double) / 100 end as accuracy_pct,
 case when value - 45 >= 60 then 'CRITICAL' when value - 45 >= 45 then 'HIGH' else 'NORMAL' end as status from events
""",
    "humidity": """
select 'sensor-' || cast(user_id as string) as device_id, ts as timestamp,
 case when event_id % 11 = 0 then null else value * 2 - 5 end as relative_humidity_pct, value / 10 - 5 as dew_point_c,
 case user_id % 3 when 0 then 'Sacramento' when 1 then 'Stockton' else 'Vacaville' end as location from events
""",
    "vibration": """
select 'sensor-' || cast(user_id as string) as device_id, ts as timestamp,
 case when event_id % 13 = 0 then null else value / 5 end as rms_acceleration, cast(40 + event_id % 25 as double) as peak_frequency_hz,
 cast(5 + event_id % 14 as double) as bandwidth_hz, 'ADXL345' as sensor_model from events
""",
    "evse_electrical": """
select 'site-00' || cast(user_id % 2 + 1 as string) as site_id, 'charger-' || cast(user_id % 8 + 1 as string) as asset_id,
 user_id % 2 + 1 as connector_id, 'sensor-' || cast(user_id as string) as device_id, ts as timestamp,
 case when event_id % 97 = 0 then null when event_id % 101 = 0 then cast(1200 as double) when user_id % 2 = 0 then cast(240 as double) else cast(480 as double) end as voltage_v,
 case when event_type = 'error' then cast(0 as double) else value * 1000 / (case when user_id % 2 = 0 then 240 else 480 end) end as current_a,
 case when event_type = 'error' then cast(0 as double) when event_id % 89 = 0 then null when event_id % 17 = 0 then value * 2 else value end as power_kw,
 case when event_id % 53 = 0 then cast(event_id as double) / 10 - 100 else cast(event_id as double) / 10 end as energy_kwh_total,
 case when event_id % 5 = 0 then null else cast(45 + event_id % 56 as double) / 100 end as power_factor,
 case when event_id % 3 = 0 then null else 60 + cast(event_id % 9 - 4 as double) / 100 end as grid_frequency_hz,
 case when user_id % 2 = 0 then 'SINGLE_PHASE' else 'THREE_PHASE' end as phase, value - 45 as temperature_cabinet_c,
 case when value - 45 < 45 then null when value - 45 >= 60 then cast(100 as double) else (value - 90) * 100 / 15 end as derate_pct,
 case when event_type = 'error' then 'FAULTED' when value - 45 >= 46 then 'DERATED' else 'OK' end as status from events
""",
    "evse_state": """
select 'site-00' || cast(user_id % 2 + 1 as string) as site_id, 'charger-' || cast(user_id % 8 + 1 as string) as asset_id,
 user_id % 2 + 1 as connector_id, 'sensor-' || cast(user_id as string) as device_id, ts as timestamp,
 case event_type when 'error' then 'FAULTED' when 'signup' then 'CHARGING' when 'click' then 'CHARGING' else 'IDLE' end as state,
 event_type in ('view', 'purchase') as available, event_type = 'error' as fault_active,
 case when event_type <> 'error' then null when event_id % 2 = 0 then 'OVER_TEMP' else 'GROUND_FAULT' end as fault_code,
 case when value - 45 < 45 or event_type not in ('signup', 'click') then null when value - 45 >= 60 then cast(100 as double) else (value - 90) * 100 / 15 end as derate_pct,
 value - 45 as charger_temp_c, event_id * 2 as uptime_s, '1.' || cast(user_id % 3 as string) || '.0' as firmware_version from events
""",
    "evse_session_event": """
select 'site-00' || cast(user_id % 2 + 1 as string) as site_id, 'charger-' || cast(user_id % 8 + 1 as string) as asset_id,
 user_id % 2 + 1 as connector_id, 'sensor-' || cast(user_id as string) as device_id, ts as timestamp,
 cast(user_id as string) || '-' || cast(cast(ts as date) as string) as session_id,
 case event_type when 'signup' then 'CHARGE_START' when 'purchase' then 'CHARGE_STOP' when 'error' then 'FAULT' when 'click' then 'RECOVERED' else 'AUTH_FAIL' end as event_type,
 case event_type when 'purchase' then 'USER_STOP' when 'error' then 'GROUND_FAULT' when 'view' then 'PAYMENT_DECLINED' else null end as reason_code,
 case event_type when 'error' then 'ERROR' when 'view' then 'WARN' else 'INFO' end as severity,
 case when event_type in ('signup', 'error') then cast(event_id as double) / 10 else null end as meter_start_kwh,
 case when event_type = 'purchase' then cast(event_id as double) / 10 else null end as meter_end_kwh,
 cast(null as double) as energy_delivered_kwh, cast(null as bigint) as duration_s, cast(null as string) as user_id_hash from events
""",
    "device_metadata": """
select 'sensor-' || cast(user_id as string) as device_id, 'site-00' || cast(user_id % 2 + 1 as string) as site_id,
 'charger-' || cast(user_id % 8 + 1 as string) as asset_id, cast(user_id % 2 + 1 as int) as connector_id,
 'Lot ' || cast(user_id % 20 as string) as location_name,
 case user_id % 3 when 0 then 'Sacramento' when 1 then 'Stockton' else 'Vacaville' end as city, 'CA' as state, 'West' as region,
 'CAISO' as grid_zone, 38 + cast(user_id % 10 as double) / 10 as latitude, -121 - cast(user_id % 10 as double) / 10 as longitude,
 case when user_id % 2 = 0 then 'L2' else 'DCFC' end as charger_kind, '1.' || cast(user_id % 3 as string) || '.0' as firmware_version,
 1600000000000 + user_id * 86400000 as installed_at_ms
from events where event_type = 'signup' and value >= 130 group by user_id
""",
}

AS_OF = "2024-01-30 23:59:00"


def read_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(STREAM_SQL[name].replace("from events", "from {events}"), events=events)


def ctes(*names: str) -> str:
    """``WITH`` clause that defines the named streams."""
    return "with " + ", ".join(f"{name} as ({STREAM_SQL[name].strip()})" for name in names)

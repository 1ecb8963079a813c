"""Windows, runs, episodes, sessions, energy and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.operators import episodes
from wattloom.operators.joins import enrich_with_devices
from wattloom.operators.ordered import order_rows, previous_row
from wattloom.suite.registry import query, sum4


PREVIOUS = """select device_id, timestamp, energy_kwh_total,
 lag(energy_kwh_total) over (partition by device_id order by timestamp) as prev_energy_kwh_total from evse_electrical"""


@query(
    "lag_previous",
    PREVIOUS,
    ("evse_electrical",),
)
def _(s):
    needed = s("evse_electrical").select("device_id", "timestamp", "energy_kwh_total")
    return previous_row(order_rows(needed, ["device_id"], ["timestamp"]), ["energy_kwh_total"]).result()


@query(
    "lag_global",
    """select device_id, timestamp, energy_kwh_total,
 lag(energy_kwh_total) over (order by timestamp, device_id) as prev_energy_kwh_total from evse_electrical""",
    ("evse_electrical",),
)
def _(s):
    needed = s("evse_electrical").select("device_id", "timestamp", "energy_kwh_total")
    return previous_row(order_rows(needed, [], ["timestamp", "device_id"]), ["energy_kwh_total"]).result()


RUNNING = """select device_id, timestamp, power_kw, cast(sum(cast(power_kw as decimal(18,4))) over (partition by device_id order by timestamp
 rows between unbounded preceding and current row) as double) / 1800 as energy_kwh from evse_electrical"""


@query(
    "running_energy",
    RUNNING,
    ("evse_electrical",),
)
def _(s):
    return episodes.energy_from_power(s("evse_electrical"), tick_s=2, scale=4)


ISLANDS = """, seen as (select device_id, timestamp, state,
 case when lag(state) over (partition by device_id order by timestamp) is distinct from state then 1 else 0 end as changed
 from evse_state),
numbered as (select *, sum(changed) over (partition by device_id order by timestamp
 rows between unbounded preceding and current row) as run from seen)
select device_id, cast(run as bigint) as run, state, min(timestamp) as start_ts, max(timestamp) as end_ts, count(*) as samples
from numbered group by device_id, run, state"""


@query("change_islands", ISLANDS, ("evse_state",))
def _(s):
    return episodes.state_runs(s("evse_state"))


ONSETS = """, runs as (select device_id, timestamp, derate_pct, sum(case when derate_pct is null then 1 else 0 end)
 over (partition by device_id order by timestamp rows between unbounded preceding and current row) as run from evse_state),
fired as (select *, row_number() over (partition by device_id, run order by timestamp) as nth from runs where derate_pct >= 1)
select device_id, {ts} as timestamp, derate_pct from fired where nth = 1"""


@query("derate_onsets", ONSETS.format(ts="timestamp"), ("evse_state",))
def _(s):
    return episodes.derate_onsets(s("evse_state"))


FAULTS = """, seen as (select *, coalesce(lag(fault_active) over (partition by device_id order by timestamp), false) as was from evse_state),
numbered as (select *, sum(case when fault_active and not was then 1 else 0 end) over (partition by device_id order by timestamp
 rows between unbounded preceding and current row) as episode from seen)
select device_id, cast(episode as bigint) as episode, min(case when fault_active then timestamp end) as start_ts,
 max(case when fault_active then timestamp end) as end_ts, count(case when fault_active then 1 end) as samples,
 max(case when fault_active and not was then fault_code end) as first_fault_code,
 min(case when not fault_active then timestamp end) as recovered_at
from numbered where fault_active or was group by device_id, episode"""


@query(
    "fault_episodes",
    FAULTS,
    ("evse_state",),
)
def _(s):
    return episodes.fault_episodes(s("evse_state"))


SESSIONS = """, ends as (select session_id, min(case when event_type = 'CHARGE_START' then timestamp end) as start_ts,
 max(case when event_type = 'CHARGE_STOP' then timestamp end) as stop_ts,
 arg_min(meter_start_kwh, timestamp) filter (event_type = 'CHARGE_START') as meter_start_kwh,
 arg_max(meter_end_kwh, timestamp) filter (event_type = 'CHARGE_STOP') as meter_end_kwh,
 count(*) as events, bool_or(event_type = 'FAULT') as had_fault from evse_session_event group by session_id)"""


@query(
    "session_summary",
    f"""{SESSIONS} select *, (epoch_us(stop_ts) - epoch_us(start_ts)) // 1000000 as duration_s,
 meter_end_kwh - meter_start_kwh as energy_delivered_kwh, start_ts is not null and stop_ts is null as is_open,
 coalesce(stop_ts < start_ts, false) as is_invalid from ends""",
    ("evse_session_event",),
)
def _(s):
    return episodes.session_summary(s("evse_session_event"))


@query(
    "session_start_stop_pairing",
    f"""{SESSIONS} select session_id, start_ts, stop_ts, meter_start_kwh, meter_end_kwh, stop_ts is null as is_open
from ends where start_ts is not null""",
    ("evse_session_event",),
)
def _(s):
    return episodes.pair_sessions(s("evse_session_event"))


FROM_POWER = """, seen as (select device_id, timestamp, power_kw, lag(timestamp) over (partition by device_id order by timestamp) as before
 from evse_electrical),
gaps as (select *, cast(case when before is null then 0 else (epoch_us(timestamp) - epoch_us(before)) // 1000 end
 as decimal(12,0)) as gap_ms from seen)
select device_id, timestamp, power_kw, cast(sum(cast(power_kw as decimal(18,4)) * gap_ms) over (partition by device_id
 order by timestamp rows between unbounded preceding and current row) as double) / 3600000 as energy_kwh from gaps"""


@query(
    "energy_from_power",
    FROM_POWER,
    ("evse_electrical",),
)
def _(s):
    return episodes.energy_from_power(s("evse_electrical"), scale=4)


FROM_METER = f""", steps as (select cast(timestamp as date) as day, device_id, energy_kwh_total - lag(energy_kwh_total)
 over (partition by device_id order by timestamp) as step from evse_electrical where energy_kwh_total is not null),
kept as (select *, case when step > 0 then step else cast(0 as double) end as used from steps)
select day, device_id, {sum4("used")} as energy_kwh, count(case when step < 0 then 1 end) as resets, count(*) as readings
from kept group by day, device_id"""


@query(
    "energy_from_meter",
    FROM_METER,
    ("evse_electrical",),
)
def _(s):
    return episodes.energy_from_meter(s("evse_electrical"), scale=4)


@query(
    "enrich_with_device_metadata",
    """select e.device_id, e.timestamp, e.event_type, e.session_id, m.city, m.grid_zone, m.latitude, m.longitude, m.charger_kind,
 m.firmware_version, m.installed_at_ms from evse_session_event e left join device_metadata m on e.device_id = m.device_id""",
    ("evse_session_event", "device_metadata"),
)
def _(s):
    joined = enrich_with_devices(s("evse_session_event"), s("device_metadata"))
    return joined.select(
        "device_id", "timestamp", "event_type", "session_id", "city", "grid_zone", "latitude", "longitude", "charger_kind",
        "firmware_version", F.col("installed_at_ms"),
    )


# --- A device that holds two thirds of all rows and is cut into pieces ------------------------------------------------

HOT_ROWS = 25
HOT = """, hot as (select * exclude (device_id), device_id as origin,
 case when cast(substr(device_id, 8) as bigint) % 3 > 0 then 'sensor-hot' else device_id end as device_id from {stream})
"""


def hot_sql(sql: str, stream: str) -> str:
    """A statement over a stream where most devices are one; its rows are told apart by the device they came from."""
    told_apart = sql.replace("order by timestamp", "order by timestamp, origin").replace("(select device_id,", "(select device_id, origin,")
    return HOT.format(stream=stream) + told_apart.replace(f"from {stream}", "from hot")


def hot(rows):
    number = F.substring("device_id", 8, 20).cast("long")
    return rows.withColumn("origin", F.col("device_id")).withColumn(
        "device_id", F.when(number % 3 > 0, F.lit("sensor-hot")).otherwise(F.col("device_id"))
    )


IN_ORDER = ("timestamp", "origin")


@query("lag_previous_hot", hot_sql(PREVIOUS, "evse_electrical"), ("evse_electrical",))
def _(s):
    needed = hot(s("evse_electrical")).select("device_id", *IN_ORDER, "energy_kwh_total")
    return previous_row(order_rows(needed, ["device_id"], IN_ORDER, HOT_ROWS), ["energy_kwh_total"]).result().drop("origin")


@query("running_energy_hot", hot_sql(RUNNING, "evse_electrical"), ("evse_electrical",))
def _(s):
    return episodes.energy_from_power(hot(s("evse_electrical")), order=IN_ORDER, tick_s=2, scale=4, task_rows=HOT_ROWS).drop("origin")


@query("energy_from_power_hot", hot_sql(FROM_POWER, "evse_electrical"), ("evse_electrical",))
def _(s):
    return episodes.energy_from_power(hot(s("evse_electrical")), order=IN_ORDER, scale=4, task_rows=HOT_ROWS).drop("origin")


@query("energy_from_meter_hot", hot_sql(FROM_METER, "evse_electrical"), ("evse_electrical",))
def _(s):
    return episodes.energy_from_meter(hot(s("evse_electrical")), order=IN_ORDER, scale=4, task_rows=HOT_ROWS)


@query("change_islands_hot", hot_sql(ISLANDS, "evse_state"), ("evse_state",))
def _(s):
    return episodes.state_runs(hot(s("evse_state")), order=IN_ORDER, task_rows=HOT_ROWS)


@query("derate_onsets_hot", hot_sql(ONSETS.format(ts="timestamp"), "evse_state"), ("evse_state",))
def _(s):
    return episodes.derate_onsets(hot(s("evse_state")), order=IN_ORDER, task_rows=HOT_ROWS).drop("origin")


@query("fault_episodes_hot", hot_sql(FAULTS, "evse_state"), ("evse_state",))
def _(s):
    return episodes.fault_episodes(hot(s("evse_state")), order=IN_ORDER, task_rows=HOT_ROWS)

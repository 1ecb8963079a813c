"""Stream contracts: column order, types, required columns, allowed values and sane limits."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "bool": T.BooleanType(),
    "ts": T.TimestampNTZType(),
}

# Column names, order, types and requiredness (a trailing ? marks a nullable column)
# are the tables' public contract.
_COLUMNS = {
    "temperature": "device_id string, timestamp ts, value_celsius double, unit string, accuracy_pct? double, status string",
    "humidity": "device_id string, timestamp ts, relative_humidity_pct double, dew_point_c double, location string",
    "vibration": "device_id string, timestamp ts, rms_acceleration double, peak_frequency_hz double, bandwidth_hz double, sensor_model string",
    "evse_electrical": "site_id string, asset_id string, connector_id long, device_id string, timestamp ts, voltage_v double, "
    "current_a double, power_kw double, energy_kwh_total double, power_factor? double, grid_frequency_hz? double, phase? string, "
    "temperature_cabinet_c? double, derate_pct? double, status string",
    "evse_state": "site_id string, asset_id string, connector_id long, device_id string, timestamp ts, state string, available bool, "
    "fault_active bool, fault_code? string, derate_pct? double, charger_temp_c? double, uptime_s? long, firmware_version? string",
    "evse_session_event": "site_id string, asset_id string, connector_id long, device_id string, timestamp ts, session_id string, "
    "event_type string, reason_code? string, severity? string, meter_start_kwh? double, meter_end_kwh? double, "
    "energy_delivered_kwh? double, duration_s? long, user_id_hash? string",
    "device_metadata": "device_id string, site_id string, asset_id string, connector_id int, location_name string, city string, "
    "state string, region string, grid_zone string, latitude double, longitude double, charger_kind string, "
    "firmware_version string, installed_at_ms long",
}

# The enumerations of the contract.
ALLOWED = {
    "temperature": {"unit": ("C", "F", "K"), "status": ("NORMAL", "HIGH", "CRITICAL")},
    "humidity": {},
    "vibration": {},
    "evse_electrical": {"phase": ("SINGLE_PHASE", "THREE_PHASE"), "status": ("OK", "DERATED", "FAULTED")},
    "evse_state": {
        "state": ("IDLE", "WAITING_FOR_AUTH", "PREPARING", "CHARGING", "STOPPING", "FAULTED", "DERATED", "MAINTENANCE", "OFFLINE")
    },
    "evse_session_event": {
        "event_type": ("PLUG_IN", "AUTH_OK", "AUTH_FAIL", "CHARGE_START", "CHARGE_STOP", "UNPLUG", "DERATE", "FAULT", "RECOVERED"),
        "severity": ("INFO", "WARN", "ERROR", "CRITICAL"),
    },
    "device_metadata": {},
}

STREAMS = ("temperature", "humidity", "vibration", "evse_electrical", "evse_state", "evse_session_event")


def _parsed(name: str) -> list[tuple[str, str, bool]]:
    fields = []
    for item in _COLUMNS[name].split(", "):
        column, kind = item.split(" ")
        fields.append((column.rstrip("?"), kind, column.endswith("?")))
    return fields


def table_schema(name: str) -> T.StructType:
    """Schema of a curated table; every column is nullable so that bad rows can be stored and reported."""
    return T.StructType([T.StructField(c, _TYPES[kind], True) for c, kind, _ in _parsed(name)])


def raw_schema(name: str) -> T.StructType:
    """Schema of landed files: event time is epoch milliseconds."""
    return T.StructType(
        [T.StructField(f.name, T.LongType() if f.name == "timestamp" else f.dataType, True) for f in table_schema(name)]
    )


def required_columns(name: str) -> list[str]:
    return [c for c, _, nullable in _parsed(name) if not nullable]


def allowed_values(name: str) -> dict[str, tuple[str, ...]]:
    return ALLOWED[name]

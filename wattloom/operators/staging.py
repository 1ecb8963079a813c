"""Staging models: typed, filtered views of the curated tables, event time first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.contracts import table_schema
from wattloom.functions.timestamps import DAY_COLUMN, day_of
from wattloom.operators.filters import within

# Plausible limits per measured column.
LIMITS = {
    "value_celsius": (-40.0, 85.0),
    "relative_humidity_pct": (0.0, 100.0),
    "rms_acceleration": (0.0, 50.0),
    "power_kw": (0.0, 500.0),
    "voltage_v": (0.0, 1000.0),
    "current_a": (0.0, 500.0),
}


def _typed(df: DataFrame, stream: str, keep_day: bool = False) -> DataFrame:
    fields = sorted(table_schema(stream), key=lambda f: f.name != "timestamp")
    day = [F.col(DAY_COLUMN)] if keep_day and DAY_COLUMN in df.columns else []
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields], *day)


def _limited(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.where(within(column, *LIMITS[column]))
    return df


def stage_temperature(df: DataFrame, min_c: float = LIMITS["value_celsius"][0], max_c: float = LIMITS["value_celsius"][1]) -> DataFrame:
    typed = _typed(df, "temperature", keep_day=True).where(within("value_celsius", min_c, max_c))
    return typed.select(
        F.col("timestamp").alias("event_ts"),
        "device_id",
        F.col("value_celsius").alias("temperature_c"),
        day_of(typed).alias("day"),
        F.hour("timestamp").alias("hour"),
        "value_celsius",
        "unit",
    )


def stage_humidity(df: DataFrame) -> DataFrame:
    return _limited(_typed(df, "humidity"), "relative_humidity_pct")


def stage_vibration(df: DataFrame) -> DataFrame:
    return _limited(_typed(df, "vibration"), "rms_acceleration")


def stage_electrical(df: DataFrame, keep_day: bool = False) -> DataFrame:
    """A row without voltage or current is dropped too, because no limit can be shown to hold.

    ``keep_day`` keeps the source's partition column, beside the model's own.
    """
    return _limited(_typed(df, "evse_electrical", keep_day), "power_kw", "voltage_v", "current_a")


def stage_state(df: DataFrame) -> DataFrame:
    return _typed(df, "evse_state")


def stage_session_event(df: DataFrame) -> DataFrame:
    return _typed(df, "evse_session_event")

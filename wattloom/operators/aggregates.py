"""Marts and time-bucketed summaries.

"Last hour" and the like have no end: rows stamped ahead of now count, as they do in SQL that compares with now. With an
``as_of`` they are left out, as they did not exist then; ``ahead`` counts them there too.

Every aggregate here combines before its shuffle, so a bucket or device with a large part of all
rows costs the reducer one partial row per map task. ``digits`` rounds for display, ``scale`` makes
sums independent of row order (see ``functions.numbers``).
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.numbers import mean, rounded, total
from wattloom.functions.hashing import row_hash
from wattloom.functions.timestamps import bucket, day_of, moment, recent, since_midnight
from wattloom.operators.filters import keep_device
from wattloom.operators.latest import newest_days
from wattloom.sources.tables import tag_rows

AsOf = datetime | str | None


def power_daily(staged: DataFrame, scale: int | None = None) -> DataFrame:
    """Daily power summary per device and asset over staged electrical readings with positive power.

    ``total_energy_kwh`` adds power samples, as the mart is defined; see ``episodes.energy_from_power``
    and ``episodes.energy_from_meter`` for energy.
    """
    measures: dict[str, Column] = {
        "avg_power_kw": mean("power_kw", scale),
        "min_power_kw": F.min("power_kw"),
        "max_power_kw": F.max("power_kw"),
        "total_energy_kwh": total("power_kw", scale),
        "reading_count": F.count(F.lit(1)),
        "avg_power_factor": mean("power_factor", scale),
        "avg_grid_frequency_hz": mean("grid_frequency_hz", scale),
        "avg_voltage_v": mean("voltage_v", scale),
        "min_voltage_v": F.min("voltage_v"),
        "max_voltage_v": F.max("voltage_v"),
        "avg_current_a": mean("current_a", scale),
        "max_current_a": F.max("current_a"),
        "avg_temperature_cabinet_c": mean("temperature_cabinet_c", scale),
        "max_derate_pct": F.max("derate_pct"),
    }
    active = staged.where(F.col("power_kw") > 0)
    return active.groupBy(day_of(staged).alias("day"), "device_id", "asset_id").agg(
        *[column.alias(name) for name, column in measures.items()]
    )


def mart_recent_days(mart: DataFrame, days: int = 7, as_of: AsOf = None, scale: int | None = None, ahead: bool = False) -> DataFrame:
    """Mart rows of the last days per day and device, newest and largest first."""
    today = F.to_date(moment(as_of))
    kept = mart.where(F.col("day") >= F.date_sub(today, days))
    if as_of is not None and not ahead:
        kept = kept.where(F.col("day") <= today)
    return (
        kept.groupBy("day", "device_id")
        .agg(
            mean("avg_power_kw", scale).alias("avg_power"),
            total("total_energy_kwh", scale).alias("total_energy"),
            F.max("max_power_kw").alias("max_power"),
        )
        .orderBy(F.col("day").desc(), F.col("total_energy").desc(), "device_id")
    )


def temperature_per_minute(
    df: DataFrame,
    span: timedelta = timedelta(hours=1),
    as_of: AsOf = None,
    digits: int | None = 2,
    scale: int | None = None,
    ahead: bool = False,
) -> DataFrame:
    return (
        recent(df, span, as_of, ahead=ahead)
        .groupBy(bucket("minute", "timestamp").alias("ts"))
        .agg(
            rounded(mean("value_celsius", scale), digits).alias("avg_temp_c"),
            F.max("value_celsius").alias("max_temp_c"),
            F.count(F.lit(1)).alias("n"),
        )
        .orderBy(F.col("ts").desc())
    )


def temperature_daily(
    df: DataFrame, days: int = 7, as_of: AsOf = None, digits: int | None = 2, scale: int | None = None, ahead: bool = False
) -> DataFrame:
    return (
        since_midnight(df, days, as_of, ahead=ahead)
        .groupBy(F.to_date("timestamp").alias("day"))
        .agg(
            rounded(F.min("value_celsius"), digits).alias("min_temp_c"),
            rounded(F.max("value_celsius"), digits).alias("max_temp_c"),
            rounded(mean("value_celsius", scale), digits).alias("avg_temp_c"),
        )
        .orderBy(F.col("day").desc())
    )


def temperature_daily_device(staged: DataFrame, device_id: str, scale: int | None = None) -> DataFrame:
    """Daily temperatures of one device, from the staging model."""
    return (
        keep_device(staged, device_id)
        .groupBy("day")
        .agg(
            mean("value_celsius", scale).alias("avg_temp"),
            F.min("value_celsius").alias("min_temp"),
            F.max("value_celsius").alias("max_temp"),
        )
        .orderBy(F.col("day").desc())
    )


def humidity_hourly(df: DataFrame, hours: int = 24, digits: int | None = 1, scale: int | None = None) -> DataFrame:
    """The newest ``hours`` hours that have readings."""
    hour = bucket("hour", "timestamp")
    last = newest_days(df, lambda part: part.select(hour.alias("hour")).distinct().limit(hours).count() >= hours)
    return (
        last.groupBy(bucket("hour", "timestamp").alias("hour"))
        .agg(
            rounded(mean("relative_humidity_pct", scale), digits).alias("avg_humidity_pct"),
            rounded(mean("dew_point_c", scale), digits).alias("avg_dew_point_c"),
        )
        .orderBy(F.col("hour").desc())
        .limit(hours)
    )


def daily_load(
    df: DataFrame,
    span: timedelta = timedelta(hours=24),
    as_of: AsOf = None,
    connector: str = "connector_id",
    digits: tuple[int, int, int] | None = (2, 1, 2),
    scale: int | None = None,
    ahead: bool = False,
) -> DataFrame:
    """Load per day. ``connector_id`` repeats between chargers; count ``device_id`` for real connectors."""
    kwh, volts, amps = digits or (None, None, None)
    return (
        recent(df, span, as_of, ahead=ahead)
        .groupBy(F.to_date("timestamp").alias("day"))
        .agg(
            F.countDistinct(connector).alias("connectors"),
            rounded(total("power_kw", scale), kwh).alias("kwh_est"),
            rounded(mean("voltage_v", scale), volts).alias("avg_volts"),
            rounded(mean("current_a", scale), amps).alias("avg_amps"),
        )
        .orderBy(F.col("day").desc())
    )


def session_events_hourly(df: DataFrame, today_only: bool = False, as_of: AsOf = None, ahead: bool = False) -> DataFrame:
    kept = since_midnight(df, 0, as_of, ahead=ahead) if today_only else df
    return (
        kept.groupBy(bucket("hour", "timestamp").alias("hour"), "event_type", "severity")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("hour").desc(), "event_type", "severity")
    )


def profile(df: DataFrame, column: str, name: str, digits: int | None = 2, scale: int | None = None) -> DataFrame:
    """Row count, first and last event time, and the mean of one column."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        rounded(mean(column, scale), digits).alias(name),
    )


def electrical_summary(df: DataFrame, digits: tuple[int, int, int] | None = (1, 2, 2), scale: int | None = None) -> DataFrame:
    volts, amps, kw = digits or (None, None, None)
    return df.agg(
        rounded(mean("voltage_v", scale), volts).alias("avg_volts"),
        rounded(mean("current_a", scale), amps).alias("avg_amps"),
        rounded(total("power_kw", scale), kw).alias("total_kw"),
    )


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_distinct(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.agg(F.countDistinct(column).alias(name))


def union_labelled(frames: Mapping[str, DataFrame], column: str = "stream") -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [tag_rows(df, label, column) for label, df in frames.items()])


def rows_per_stream(frames: Mapping[str, DataFrame]) -> DataFrame:
    counts = {label: count_rows(df, "rows") for label, df in frames.items()}
    return union_labelled(counts).select("stream", "rows").orderBy(F.col("rows").desc(), "stream")


def reconcile(raw: Mapping[str, DataFrame], curated: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of every stream in both representations and their difference."""
    sides = [
        union_labelled({s: count_rows(df, "rows") for s, df in frames.items()}).withColumn("side", F.lit(side))
        for side, frames in (("raw", raw), ("curated", curated))
    ]
    one = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("rows"))), F.lit(0))
    return (
        sides[0]
        .unionByName(sides[1])
        .groupBy("stream")
        .agg(one("raw").alias("raw_rows"), one("curated").alias("curated_rows"))
        .withColumn("difference", F.col("raw_rows") - F.col("curated_rows"))
        .orderBy("stream")
    )


def reconcile_days(raw: DataFrame, curated: DataFrame) -> DataFrame:
    """Days on which two conformed representations differ in row count or content.

    Content is a sum of row hashes in which a NULL has a place of its own, so neither side is sorted or joined row by row.
    """
    columns = curated.columns

    def per_day(df: DataFrame, sign: int) -> DataFrame:
        return df.groupBy(F.to_date("timestamp").alias("day")).agg(
            (F.count(F.lit(1)) * sign).alias("rows"),
            (F.sum(row_hash(columns)) * sign).alias("content"),
        )

    both = per_day(raw.select(*columns), 1).unionByName(per_day(curated, -1))
    summed = both.groupBy("day").agg(F.sum("rows").alias("row_difference"), F.sum("content").alias("content_difference"))
    summed = summed.withColumn("content_differs", F.col("content_difference") != 0)
    return summed.where((F.col("row_difference") != 0) | F.col("content_differs")).select("day", "row_difference", "content_differs")

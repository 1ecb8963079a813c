"""Faults, derating, sessions and energy derived from the order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.numbers import fixed, total
from wattloom.functions.rules import DERATED_FROM_PCT
from wattloom.operators.ordered import Read, number_runs, order_rows, previous_row, scan
from wattloom.operators.skew import TASK_ROWS

DEVICE = ("device_id",)


def state_runs(
    df: DataFrame,
    columns: Sequence[str] = ("state",),
    keys: Sequence[str] = DEVICE,
    order: Sequence[str] = ("timestamp",),
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """One row per run of consecutive rows with equal ``columns``: its number, ends and size."""
    rows = order_rows(df.select(*dict.fromkeys([*keys, *order, *columns])), keys, order, task_rows)
    numbered = number_runs(rows, columns).df
    # The run number determines the run's values, so grouping by them adds no groups.
    return numbered.groupBy(*keys, "run", *columns).agg(
        F.min("timestamp").alias("start_ts"),
        F.max("timestamp").alias("end_ts"),
        F.count(F.lit(1)).alias("samples"),
    )


def fault_episodes(df: DataFrame, order: Sequence[str] = ("timestamp",), task_rows: int = TASK_ROWS) -> DataFrame:
    """Runs of rows with an active fault per device.

    ``recovered_at`` is the first healthy row after the run, NULL while the fault lasts.
    """
    needed = dict.fromkeys(["device_id", *order, "fault_active", "fault_code"])
    rows = order_rows(df.select(*needed), DEVICE, order, task_rows)
    active = lambda flag: F.coalesce(flag, F.lit(False))
    begins = lambda before, here, first: (active(here("fault_active")) & ~active(before("fault_active"))).cast("long")
    scanned = scan(rows, {"fault_active": "_was"}, {"episode": begins}).result()
    faulty, was_faulty = active(F.col("fault_active")), active(F.col("_was"))
    # Healthy rows matter only right after a fault: they close it.
    numbered = scanned.where(faulty | was_faulty).withColumn("_start", faulty & ~was_faulty)
    return numbered.groupBy("device_id", "episode").agg(
        F.min(F.when(faulty, F.col("timestamp"))).alias("start_ts"),
        F.max(F.when(faulty, F.col("timestamp"))).alias("end_ts"),
        F.count(F.when(faulty, F.lit(1))).alias("samples"),
        F.max(F.when(F.col("_start"), F.col("fault_code"))).alias("first_fault_code"),
        F.min(F.when(~faulty, F.col("timestamp"))).alias("recovered_at"),
    )


def derate_onsets(
    df: DataFrame, order: Sequence[str] = ("timestamp",), limit: float = DERATED_FROM_PCT, task_rows: int = TASK_ROWS
) -> DataFrame:
    """First row at or above ``limit`` after each absence of derating, per device.

    Values below the limit neither fire nor reset, so they are dropped before the scan; what is left
    fires exactly where the row before it is NULL or missing.
    """
    needed = df.select(*dict.fromkeys(["device_id", *order, "derate_pct"]))
    matter = needed.where(F.col("derate_pct").isNull() | (F.col("derate_pct") >= limit))
    rows = previous_row(order_rows(matter, DEVICE, order, task_rows), ["derate_pct"])
    fired = F.col("derate_pct").isNotNull() & F.col("prev_derate_pct").isNull()
    return rows.result().where(fired).drop("prev_derate_pct")


def session_summary(df: DataFrame) -> DataFrame:
    """One row per charging session: earliest start, latest stop, energy, and what is missing.

    A plain combinable aggregate of fixed-width values; sessions cut by a fault stay open.
    """
    started = F.col("event_type") == "CHARGE_START"
    stopped = F.col("event_type") == "CHARGE_STOP"
    start_ts, stop_ts = F.when(started, F.col("timestamp")), F.when(stopped, F.col("timestamp"))
    grouped = df.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(
        F.min(start_ts).alias("start_ts"),
        F.max(stop_ts).alias("stop_ts"),
        F.min_by("meter_start_kwh", start_ts).alias("meter_start_kwh"),
        F.max_by("meter_end_kwh", stop_ts).alias("meter_end_kwh"),
        F.count(F.lit(1)).alias("events"),
        F.coalesce(F.bool_or(F.col("event_type") == "FAULT"), F.lit(False)).alias("had_fault"),
    )
    seconds = F.timestamp_diff("SECOND", F.col("start_ts"), F.col("stop_ts"))
    return grouped.select(
        "*",
        seconds.alias("duration_s"),
        (F.col("meter_end_kwh") - F.col("meter_start_kwh")).alias("energy_delivered_kwh"),
        (F.col("start_ts").isNotNull() & F.col("stop_ts").isNull()).alias("is_open"),
        F.coalesce(F.col("stop_ts") < F.col("start_ts"), F.lit(False)).alias("is_invalid"),
    )


def pair_sessions(df: DataFrame) -> DataFrame:
    """Sessions that started, with their stop where there is one."""
    return session_summary(df).where(F.col("start_ts").isNotNull()).select(
        "session_id", "start_ts", "stop_ts", "meter_start_kwh", "meter_end_kwh", "is_open"
    )


def energy_from_power(
    df: DataFrame,
    keys: Sequence[str] = DEVICE,
    order: Sequence[str] = ("timestamp",),
    tick_s: float | None = None,
    max_gap_s: int | None = None,
    scale: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Running energy in kWh per connector.

    A reading stands for ``tick_s`` seconds, or, without it, for the time since the reading before
    (milliseconds, at most ``max_gap_s`` seconds if given, nothing for the first one).
    """
    needed = df.select(*dict.fromkeys([*keys, *order, "power_kw"]))
    rows = order_rows(needed, keys, order, task_rows)

    def used(before: Read, here: Read, first: Column) -> Column:
        value = here("power_kw") if scale is None else fixed(here("power_kw"), scale)
        if tick_s is not None:
            return value
        since = F.timestamp_diff("MILLISECOND", before("timestamp"), here("timestamp"))
        # least() skips NULL, so the first reading needs a case of its own.
        gap = F.when(since.isNull(), F.lit(0)).otherwise(since if max_gap_s is None else F.least(since, F.lit(max_gap_s * 1000)))
        return value * gap.cast("double" if scale is None else "decimal(12,0)")

    unit = 3_600_000.0 if tick_s is None else 3600.0 / tick_s
    summed = scan(rows, totals={"_sum": used}).result()
    return summed.withColumn("energy_kwh", F.col("_sum").cast("double") / unit).drop("_sum")


def energy_from_meter(
    df: DataFrame, order: Sequence[str] = ("timestamp",), scale: int | None = None, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Metered energy per day and device; a falling meter is a reset and adds nothing.

    Readings without a meter value are skipped, so the increase across them is kept.
    """
    needed = df.select(*dict.fromkeys(["device_id", *order, "energy_kwh_total"])).where(F.col("energy_kwh_total").isNotNull())
    rows = previous_row(order_rows(needed, DEVICE, order, task_rows), ["energy_kwh_total"])
    grown = F.greatest(F.lit(0.0), F.col("energy_kwh_total") - F.col("prev_energy_kwh_total"))
    grown = F.when(F.col("prev_energy_kwh_total").isNotNull(), grown).otherwise(F.lit(0.0))
    fell = F.col("energy_kwh_total") < F.col("prev_energy_kwh_total")
    return rows.result().groupBy(F.to_date("timestamp").alias("day"), "device_id").agg(
        total(grown, scale).alias("energy_kwh"),
        F.count(F.when(fell, F.lit(1))).alias("resets"),
        F.count(F.lit(1)).alias("readings"),
    )

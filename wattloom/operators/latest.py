"""Newest rows: top-k by event time, with tie-breaks so that the answer is defined."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.timestamps import DAY_COLUMN
from wattloom.operators.filters import keep_true

TIES = ("device_id",)


def newest_days(df: DataFrame, enough: Callable[[DataFrame], bool]) -> DataFrame:
    """The last days of a day-partitioned table that hold enough, or the table as it is.

    The days are known from the files' folders. One day is tried first, then twice as many, and so on.
    """
    if DAY_COLUMN not in df.columns:
        return df
    days = sorted({m[1] for f in df.inputFiles() if (m := re.search(rf"{DAY_COLUMN}=(\d{{4}}-\d\d-\d\d)", f))}, reverse=True)
    n = 1
    while n < len(days):
        part = df.where(F.col(DAY_COLUMN) >= F.lit(days[n - 1]).cast("date"))
        if enough(part):
            return part
        n *= 2
    return df


def newest(df: DataFrame, k: int, columns: Sequence[str], ties: Sequence[str] = TIES) -> DataFrame:
    df = newest_days(df, lambda part: part.select(F.lit(1)).limit(k).count() >= k)
    ordered = df.orderBy(F.col("timestamp").desc(), *[F.col(c).asc_nulls_last() for c in ties])
    return ordered.limit(k).select(*columns)


def latest_temperature(df: DataFrame, k: int = 10) -> DataFrame:
    return newest(df, k, ["device_id", "timestamp", "value_celsius", "unit", "status"])


def latest_faults(df: DataFrame, k: int = 100) -> DataFrame:
    columns = ["timestamp", "device_id", "state", "fault_code", "derate_pct", "charger_temp_c"]
    return newest(keep_true(df, "fault_active"), k, columns)


def any_rows(df: DataFrame, k: int = 10) -> DataFrame:
    """A peek at ``k`` rows, whichever come first."""
    return df.limit(k)

"""Row filters shared by the staging models and ad-hoc queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within(column: str, low: float, high: float) -> Column:
    """Both limits included. NULL and NaN are outside."""
    return F.col(column).between(low, high)


def keep_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(within(column, low, high))


def keep_present(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def keep_true(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column))


def keep_device(df: DataFrame, device_id: str) -> DataFrame:
    return df.where(F.col("device_id") == device_id)

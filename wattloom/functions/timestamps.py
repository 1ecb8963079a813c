"""Time columns. Tables hold UTC timestamps without a zone."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_COLUMN = "timestamp_day"


def moment(value: datetime | str | Column | None) -> Column:
    """A zone-less UTC timestamp; ``None`` is now. No conversion here depends on the session's zone."""
    if value is None:
        return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime) and value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(str(value)).cast("timestamp_ntz")


def epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def day_of(df: DataFrame, column: str = "timestamp") -> Column:
    """The day of a row: the table's partition column where it has one, so that filters on the day prune."""
    return F.col(DAY_COLUMN) if column == "timestamp" and DAY_COLUMN in df.columns else F.to_date(column)


def bucket(unit: str, column: str | Column) -> Column:
    """Start of the minute, hour, day ... a zone-less timestamp falls in."""
    return F.date_trunc(unit, column).cast("timestamp_ntz")


def from_epoch_ms(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.timestamp_add("MILLISECOND", column.cast("long"), epoch())


def to_epoch_ms(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.floor(F.timestamp_diff("MICROSECOND", epoch(), column) / F.lit(1000).cast("decimal(4,0)")).cast("long")


def partition_columns(column: str | Column) -> list[Column]:
    """year, month, day and hour of a timestamp, named for the landing layout."""
    return [
        F.year(column).alias("year"),
        F.month(column).alias("month"),
        F.dayofmonth(column).alias("day"),
        F.hour(column).alias("hour"),
    ]


def time_range(
    df: DataFrame,
    start: datetime | str | Column | None = None,
    end: datetime | str | Column | None = None,
    column: str = "timestamp",
) -> DataFrame:
    """Rows with ``start <= column < end``.

    Partition pruning needs a predicate on the partition column itself, so one is added wherever
    the table has the day column.
    """
    pruned = column == "timestamp" and DAY_COLUMN in df.columns
    if start is not None:
        df = df.where(F.col(column) >= moment(start))
        if pruned:
            df = df.where(F.col(DAY_COLUMN) >= F.to_date(moment(start)))
    if end is not None:
        df = df.where(F.col(column) < moment(end))
        if pruned:
            df = df.where(F.col(DAY_COLUMN) <= F.to_date(moment(end)))
    return df


def recent(
    df: DataFrame, span: timedelta, as_of: datetime | str | None = None, column: str = "timestamp", ahead: bool = False
) -> DataFrame:
    """Rows no older than ``span`` before ``as_of``, and none after it unless ``ahead``."""
    return _until(time_range(df, start=moment(as_of) - F.lit(span), column=column), None if ahead else as_of, column)


def since_midnight(
    df: DataFrame, days: int = 0, as_of: datetime | str | None = None, column: str = "timestamp", ahead: bool = False
) -> DataFrame:
    """Rows since 00:00 of the day ``days`` before ``as_of``, and none after it unless ``ahead``."""
    start = F.date_sub(F.to_date(moment(as_of)), days).cast("timestamp_ntz")
    return _until(time_range(df, start=start, column=column), None if ahead else as_of, column)


def _until(df: DataFrame, as_of: datetime | str | None, column: str) -> DataFrame:
    """Seen at ``as_of``, later rows do not exist yet; with now as the moment there are none to leave out."""
    if as_of is None:
        return df
    if column == "timestamp" and DAY_COLUMN in df.columns:
        df = df.where(F.col(DAY_COLUMN) <= F.to_date(moment(as_of)))
    return df.where(F.col(column) <= moment(as_of))

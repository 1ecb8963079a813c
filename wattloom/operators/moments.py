"""Stored moments per key and day: count, sum and sum of squares, from which outliers of new days are found in one scan of them.

Sums are decimals, so the moments of any days add up to exactly what one pass over their rows would give, in any order,
and storing a day again gives the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.functions.timestamps import day_of
from wattloom.operators.joins import lookup_join

SUM, SQUARES = "decimal(30,6)", "decimal(38,12)"
PARTS = {"values": "long", "total": SUM, "squares": SQUARES}


def moments(df: DataFrame, column: str, keys: Sequence[str] = ("device_id",), scale: int = 4) -> DataFrame:
    """keys, day, values, total, squares of the rows that have a value, in one pass. Values are rounded to ``scale`` (at most 6) digits."""
    if not 0 <= scale <= 6:
        raise ValueError("scale is from 0 to 6")
    value = F.col(column).cast(f"decimal(18,{scale})")
    rows = df.where(F.col(column).isNotNull()).groupBy(*keys, day_of(df).alias("day"))
    return rows.agg(
        F.count(F.lit(1)).alias("values"), F.sum(value).cast(SUM).alias("total"), F.sum((value * value).cast("decimal(36,12)")).cast(SQUARES).alias("squares")
    )


def write_moments(df: DataFrame, path: str, column: str, keys: Sequence[str] = ("device_id",), scale: int = 4) -> str:
    """Store the moments of the days that ``df`` has rows of, in place of those stored before; other days stay as they are."""
    found = moments(df, column, keys, scale).hint("rebalance", "day")
    found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return path


def read_moments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _statistics() -> list:
    n, total = F.col("values"), F.col("total").cast("double")
    spread = F.col("squares").cast("double") - F.try_divide(total * total, n)
    return [F.try_divide(total, n).alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.try_divide(spread, n - 1))).alias("stddev")]


def statistics(stored: DataFrame, keys: Sequence[str] = ("device_id",)) -> DataFrame:
    """Mean and sample standard deviation per key over all days of ``stored``; filter it by ``day`` before."""
    merged = stored.groupBy(*keys).agg(*[F.sum(p).cast(kind).alias(p) for p, kind in PARTS.items()])
    return merged.select(*keys, *_statistics())


def trailing_statistics(stored: DataFrame, days: int, keys: Sequence[str] = ("device_id",)) -> DataFrame:
    """Per key and day, mean and sample standard deviation over the ``days`` before it, its own not included."""
    if days < 1:
        raise ValueError("at least one day before is needed")
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    before = Window.partitionBy(*keys).orderBy("_number").rangeBetween(-days, -1)
    dated = stored.where("day is not null").withColumn("_number", number)
    merged = dated.select(*keys, "day", *[F.sum(p).over(before).cast(kind).alias(p) for p, kind in PARTS.items()])
    return merged.select(*keys, "day", *_statistics())


def outliers_of_days(
    df: DataFrame, stored: DataFrame, column: str, k: float = 3.0, keys: Sequence[str] = ("device_id",), days: int | None = None, **limits: int
) -> DataFrame:
    """Rows further than ``k`` sample standard deviations from the mean of their key, by stored moments.

    Without ``days`` the moments of all stored days count; with it each row is judged by the ``days`` before its own day,
    whose moments must be stored as well, and a row without a time by none. Only ``df`` is scanned.
    """
    rows = df.where(F.col(column).isNotNull())
    if days is None:
        joined = lookup_join(rows, statistics(stored, keys), keys, "left", null_safe=True, **limits)
    else:
        rows = rows.withColumn("_day", day_of(rows))
        found = trailing_statistics(stored, days, keys).withColumnRenamed("day", "_day")
        joined = lookup_join(rows, found, [*keys, "_day"], "left", null_safe=True, **limits).drop("_day")
    return joined.where(F.abs(F.col(column) - F.col("mean")) > F.lit(k) * F.col("stddev"))

"""Comparing two representations of a stream from the top down, by stored sums of row hashes.

A digest table has, for every day, one row for the day, one for each hour of it and one for each hour and device bucket:
row count and two sums of row hashes, which do not depend on order and add up over the levels. Two digest tables are compared
by days first; hours are looked at in differing days only, buckets in differing hours only. The rows themselves are read
again only for the buckets that differ. A day has at most 24 * ``BUCKETS`` entries, however many devices and rows there are.

Rows without a time form a day of their own, and those without a device a bucket. Both sides must have the same columns in
the same types, as ``conform`` gives them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.hashing import row_hash, second_row_hash
from wattloom.functions.timestamps import DAY_COLUMN

BUCKETS = 256
BRANCH = ["day", "hour", "bucket"]
MEASURES = ["rows", "content", "check"]
# Levels of a digest table, by the key columns that their rows have.
DAY, HOUR, BUCKET = 0, 1, 2
SUM = "decimal(38,0)"


def _day(df: DataFrame) -> Column:
    return F.col(DAY_COLUMN) if DAY_COLUMN in df.columns else F.to_date("timestamp")


def with_branch(df: DataFrame, key: str = "device_id") -> DataFrame:
    """The rows with the branch of the tree they belong to: day, hour, bucket."""
    bucket = F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))
    return df.withColumns({"day": _day(df), "hour": F.hour("timestamp"), "bucket": bucket})


def digests(df: DataFrame, columns: Sequence[str], key: str = "device_id") -> DataFrame:
    """Rows of a digest table: level, day, hour, bucket, rows, content, check. One pass, summed up before its only wide shuffle."""
    leaves = with_branch(df, key).groupBy(*BRANCH).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_hash(columns)).alias("content"), F.sum(second_row_hash(columns)).alias("check")
    )
    sets = [[F.col(c) for c in BRANCH[:n]] for n in (1, 2, 3)]
    summed = leaves.groupingSets(sets, *[F.col(c) for c in BRANCH]).agg(
        F.grouping_id().alias("_set"),
        F.sum("rows").alias("rows"),
        F.sum("content").cast(SUM).alias("content"),
        F.sum("check").cast(SUM).alias("check"),
    )
    level = F.when(F.col("_set") == 0, BUCKET).when(F.col("_set") == 1, HOUR).otherwise(DAY)
    return summed.select(level.alias("level"), *BRANCH, *MEASURES)


def write_digests(df: DataFrame, path: str, columns: Sequence[str], key: str = "device_id") -> str:
    """Store the digests of the days that ``df`` has rows of; those of other days stay as they are."""
    found = digests(df, columns, key).repartition("day").sortWithinPartitions("day", "level")
    writer = found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(path)
    return path


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"level int, hour int, bucket int, rows long, content {SUM}, check {SUM}, day date").parquet(path)


def _differing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose measures differ, and by how many rows. A key that one side lacks differs."""

    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*keys, *[(F.col(m) * F.lit(sign).cast("decimal(1,0)")).cast(SUM).alias(m) for m in MEASURES])

    summed = signed(left, 1).unionAll(signed(right, -1)).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])
    return summed.where(" or ".join(f"{m} <> 0" for m in MEASURES)).select(*keys, F.col("rows").cast("long").alias("row_difference"))


def _on_days(column: Column, days: Sequence) -> Column:
    known = [d for d in days if d is not None]
    found = column.isin(known) if known else F.lit(False)
    return found | column.isNull() if None in days else found


def _within(df: DataFrame, branches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of branches, with NULL equal to NULL."""
    wanted = branches.select(*[F.col(k).alias(f"_in_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(wanted[f"_in_{k}"]) for k in keys])
    return df.join(wanted, same, "left_semi")


def differing_days(left: DataFrame, right: DataFrame) -> list:
    """Days on which two digest tables differ: at most as many as there are days."""
    return [r["day"] for r in _differing(left.where(F.col("level") == DAY), right.where(F.col("level") == DAY), ["day"]).collect()]


def differing_branches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Where two digest tables differ, from the top down: day, hour, bucket, row_difference (left minus right)."""
    days = differing_days(left, right)
    sides = [df.where(_on_days(F.col("day"), days)) for df in (left, right)]
    hours = _differing(*[df.where(F.col("level") == HOUR) for df in sides], ["day", "hour"])
    return _differing(*[_within(df.where(F.col("level") == BUCKET), hours, ["day", "hour"]) for df in sides], BRANCH)


def differing_rows(
    left: DataFrame, right: DataFrame, left_digests: DataFrame, right_digests: DataFrame, columns: Sequence[str], key: str = "device_id"
) -> DataFrame:
    """Rows that one side has more often than the other: day, hour, the columns, copies (positive: left has more).

    Only the rows of differing branches are read; where a side has the day as a partition column, only differing days.
    """
    days = differing_days(left_digests, right_digests)
    branches = differing_branches(left_digests, right_digests)

    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = with_branch(df.where(_on_days(_day(df), days)), key)
        return _within(rows, branches, BRANCH).select("day", "hour", *columns, F.lit(sign).alias("_sign"))

    both = side(left, 1).unionAll(side(right, -1))
    return both.groupBy("day", "hour", *columns).agg(F.sum("_sign").alias("copies")).where("copies <> 0")


def differing_keys(
    left: DataFrame, right: DataFrame, left_digests: DataFrame, right_digests: DataFrame, columns: Sequence[str], key: str = "device_id"
) -> DataFrame:
    """Devices and hours that differ: day, hour, the key, and the rows that only the left or only the right side has."""
    rows = differing_rows(left, right, left_digests, right_digests, columns, key)
    return rows.groupBy("day", "hour", key).agg(
        F.sum(F.greatest("copies", F.lit(0))).alias("only_left"), F.sum(F.greatest(-F.col("copies"), F.lit(0))).alias("only_right")
    )

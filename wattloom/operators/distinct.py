"""Exact distinct counts that add up over days: one bitmap per day over a dense numbering of the values.

A kept dictionary numbers every value once. A day is stored as the bitmaps of the numbers seen on it, in blocks of 32,768;
the distinct count over any days is the number of bits in the union of their bitmaps, so the rows are not read again
and a window of n days does not multiply them by n. NULL is not counted, as ``count(DISTINCT)`` does.

Numbers are given in ``LANES`` lanes by hash: a value's number is its rank within its lane times ``LANES`` plus the lane. So
numbering runs in as many tasks, is the same when a task is repeated, and stays dense as the dictionary grows: the
bitmaps of a day are as large as the fullest lane asks for. One writer at a time extends a dictionary.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.functions.timestamps import day_of

LANES = 64


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c] == right[f"_of_{c}"] for c in columns])


def _dictionary(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{path}/dictionary")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def extend_dictionary(df: DataFrame, path: str, columns: Sequence[str]) -> DataFrame:
    """Number the values of ``columns`` that are new, and return the dictionary: _of_<column>..., id."""
    spark, known = df.sparkSession, _dictionary(df.sparkSession, path)
    new = df.select(*columns).dropna(how="any").distinct()
    lane = F.pmod(F.xxhash64(*columns), F.lit(LANES)).cast("int")
    if known is not None:
        new = new.join(known, _same(new, known, columns), "left_anti")
        taken = known.groupBy(F.pmod("id", F.lit(LANES)).cast("int").alias("_lane_of")).agg(F.max("id").alias("_last"))
    new = new.withColumn("_lane", lane)
    rank = F.row_number().over(Window.partitionBy("_lane").orderBy(*columns)).cast("long")
    if known is None:
        numbered = new.withColumn("id", (rank - 1) * LANES + F.col("_lane"))
    else:
        # At most LANES rows.
        joined = new.join(F.broadcast(taken), F.col("_lane") == F.col("_lane_of"), "left")
        first = F.coalesce(F.floor(F.col("_last") / F.lit(LANES)).cast("long") + 1, F.lit(0))
        numbered = joined.withColumn("id", (first + rank - 1) * LANES + F.col("_lane"))
    # Appending to a table that the same job reads is safe: its files are listed before.
    numbered.select(*[F.col(c).alias(f"_of_{c}") for c in columns], "id").write.mode("append").parquet(f"{path}/dictionary")
    return spark.read.parquet(f"{path}/dictionary")


def note_days(df: DataFrame, path: str, columns: Sequence[str]) -> str:
    """Store the bitmaps of the days that ``df`` has rows of, in place of those stored before; other days stay as they are.

    The rows of a day must be complete. Rows without a time belong to no day.
    """
    ids = extend_dictionary(df, path, columns)
    seen = df.select(day_of(df).alias("day"), *columns).where("day is not null").dropna(how="any").distinct()
    seen = seen.join(ids, _same(seen, ids, columns)).select("day", "id")
    bits = seen.groupBy("day", F.bitmap_bucket_number("id").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
    # A day's values are all gone if it has none that count.
    empty = df.select(day_of(df).alias("day")).where("day is not null").distinct().select("day", F.lit(None).cast("long").alias("block"), F.lit(None).cast("binary").alias("bits"))
    writer = bits.unionByName(empty).hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(f"{path}/days")
    return path


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """day, block, bits. Every stored day has one more row without bits."""
    return spark.read.schema("block long, bits binary, day date").parquet(f"{path}/days")


def _counted(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Bits in the union of bitmaps per keys. Blocks are united before the wide shuffle, which then carries one row per block."""
    united = bitmaps.groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    bits = F.when(F.col("block").isNotNull(), F.bitmap_count("bits")).otherwise(F.lit(0))
    return united.groupBy(*keys).agg(F.sum(bits).cast("long").alias(name))


def distinct_by_day(bitmaps: DataFrame, name: str = "n") -> DataFrame:
    return _counted(bitmaps, ["day"], name)


def distinct_over(bitmaps: DataFrame, name: str = "n") -> DataFrame:
    """One row: distinct values over all days of ``bitmaps``; filter it by ``day`` before, which prunes days."""
    united = bitmaps.where("block is not null").groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias(name))


def distinct_rolling(bitmaps: DataFrame, days: int, name: str = "n") -> DataFrame:
    """Per stored day, the distinct values of that day and the ``days - 1`` before it."""
    if days < 1:
        raise ValueError("a window has at least one day")
    stored = bitmaps.where("block is null").select(F.col("day").alias("_stored")).distinct()
    ahead = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    spread = bitmaps.select("block", "bits", F.col("day").alias("_own"), ahead.alias("_ahead"))
    spread = spread.select("block", "bits", F.date_add("_own", F.col("_ahead")).alias("day"))
    return _counted(spread.join(stored, F.col("day") == F.col("_stored"), "left_semi"), ["day"], name)

"""Finding the few keys that hold too many rows for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.session import shuffle_partitions

# Rows one task can sort and scan without trouble.
TASK_ROWS = 5_000_000


def same_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality, so that rows without a key are a group of their own."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def heavy_keys(df: DataFrame, keys: Sequence[str], task_rows: int = TASK_ROWS) -> tuple[DataFrame | None, int]:
    """Keys with more rows than a fair share, as (keys..., ``_rows``), and the rows a task should get.

    The share is the larger of ``task_rows`` and the mean per shuffle partition, so there are never
    more heavy keys than shuffle partitions. Counting reads the key columns only and is combined
    before the shuffle. A table that fits one task is settled by its row count alone.
    """
    spark = df.sparkSession
    rows = df.count()
    share = max(task_rows, rows // shuffle_partitions(spark))
    if rows <= share:
        return None, share
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > share)
    found = counted.collect()
    return (spark.createDataFrame(found, counted.schema) if found else None), share

"""Positions of rows in a total order, without one task seeing them all.

Rows are range-partitioned by the order, sorted inside each partition, and written with their partition and their place
in it. A position is then the place plus the number of rows in all partitions before, one number for each partition.
Rows that tie in the caller's order are told apart by their place in the input, so that a large group of equal rows is
split like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import written

PART, PLACE, POSITION = "__llm_part", "__llm_place", "__llm_position"
_TIE, _BITS = "__llm_tie", 33  # monotonically_increasing_id holds the place in its lower 33 bits


def sorted_parts(df: DataFrame, order: Sequence[Column | str], label: str) -> DataFrame:
    """The rows in order, as a table with ``__llm_part`` (rising with the order) and ``__llm_place`` (from 0 in each part)."""
    tied = df.withColumn(_TIE, F.monotonically_increasing_id())
    parts = tied.repartitionByRange(*order, _TIE).sortWithinPartitions(*order, _TIE).drop(_TIE)
    at = parts.withColumn("__llm_at", F.monotonically_increasing_id())
    placed = at.withColumn(PART, F.shiftright("__llm_at", _BITS)).withColumn(PLACE, F.col("__llm_at").bitwiseAND((1 << _BITS) - 1))
    return written(placed.drop("__llm_at"), label)


def with_positions(parts: DataFrame) -> DataFrame:
    """Adds ``__llm_position``, gapless from 0, to a table of ``sorted_parts``."""
    # One row for each part, and there are no more parts than shuffle partitions.
    sizes = parts.groupBy(PART).agg(F.count(F.lit(1)).alias("__llm_rows"))
    before = F.sum("__llm_rows").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(PART, F.coalesce(before, F.lit(0)).alias("__llm_before"))
    return parts.join(F.broadcast(offsets), PART).withColumn(POSITION, F.col(PLACE) + F.col("__llm_before")).drop("__llm_before")

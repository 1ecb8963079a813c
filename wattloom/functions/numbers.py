"""Sums, means and ratios.

Adding doubles in another order changes the last bits, and a retried task or another partitioning
changes the order. With ``scale`` set, values are added as decimals, so the result is the same on
every run; without it the plain double aggregates are used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(column: str | Column, scale: int) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(f"decimal(18,{scale})")


def total(column: str | Column, scale: int | None = None) -> Column:
    return F.sum(column) if scale is None else F.sum(fixed(column, scale)).cast("double")


def mean(column: str | Column, scale: int | None = None) -> Column:
    return F.avg(column) if scale is None else F.try_divide(total(column, scale), F.count(column))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, NULL where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def rounded(column: Column, digits: int | None) -> Column:
    return column if digits is None else F.round(column, digits)

"""Hashes of whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_keys(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row; the literal before the second acts as its seed. A flag goes with each column, since
    hashing skips NULLs."""
    flagged = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*flagged), F.xxhash64(F.lit("second"), *flagged)


def row_hash(columns: Sequence[str]) -> Column:
    """A row's hash, to be summed without overflow."""
    return row_keys(columns)[0].cast("decimal(20,0)")


def second_row_hash(columns: Sequence[str]) -> Column:
    return row_keys(columns)[1].cast("decimal(20,0)")

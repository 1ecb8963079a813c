"""Finding rows that a table already has, by hashes kept beside it.

For a table at ``path`` the folder ``<path>_hashes`` has, in the table's own partitions (day, write), two 64-bit hashes of every
row. A micro-batch is compared with the hashes of the days it touches: 16 bytes a row instead of whole rows. They are first
reduced to those that the batch has, with the batch as the side to be broadcast where it is small, so a large day is scanned but
not shuffled.

Hashes are written after the rows. A partition of the table that has none, or older ones (an attempt that died in between, rows
from before the hashes, a compaction), is hashed once before it is compared with. Where folders carry no times, as in object
stores, only missing ones are noticed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.hashing import row_keys
from wattloom.functions.timestamps import DAY_COLUMN
from wattloom.sinks.folders import Folders
from wattloom.sinks.writers import WRITE_COLUMN, with_day

KEYS = ["key_a", "key_b"]
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
SCHEMA = f"key_a bigint, key_b bigint, {DAY_COLUMN} date, {WRITE_COLUMN} string"


def hashes_path(path: str) -> str:
    return f"{path.rstrip('/')}_hashes"


def _hashed(rows: DataFrame, columns: list[str], write: Column) -> DataFrame:
    keys = [key.alias(name) for key, name in zip(row_keys(columns), KEYS)]
    return rows.select(*keys, DAY_COLUMN, write.alias(WRITE_COLUMN))


def _save(hashed: DataFrame, path: str) -> None:
    writer = hashed.hint("rebalance", DAY_COLUMN, WRITE_COLUMN).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY_COLUMN, WRITE_COLUMN).parquet(hashes_path(path))


def note_rows(batch: DataFrame, path: str, batch_id: int) -> None:
    """Keep the hashes of the rows that a batch has written."""
    _save(_hashed(with_day(batch), batch.columns, F.lit(f"b{batch_id}")), path)


def _catch_up(spark: SparkSession, batch: DataFrame, path: str, days: list, own: str) -> None:
    """Hash the partitions of touched days whose hashes are missing or older than their rows."""
    folders, missing = Folders(spark, path), []
    for day in days:
        name = f"{DAY_COLUMN}={NO_DAY if day is None else day}"
        noted = folders.modified(f"{hashes_path(path)}/{name}")
        for write, at in folders.modified(f"{path.rstrip('/')}/{name}").items():
            if write != f"{WRITE_COLUMN}={own}" and noted.get(write, -1) < at:
                missing.append(F.col(DAY_COLUMN).eqNullSafe(F.lit(day).cast("date")) & (F.col(WRITE_COLUMN) == write.partition("=")[2]))
    if missing:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema)
        table = spark.read.schema(f"{fields}, {DAY_COLUMN} date, {WRITE_COLUMN} string").parquet(path)
        _save(_hashed(table.where(reduce(lambda a, b: a | b, missing)), batch.columns, F.col(WRITE_COLUMN)), path)


def known_hashes(batch: DataFrame, path: str, batch_id: int) -> DataFrame | None:
    """Hashes that other batches have left in the days that the batch touches; None where there are none yet."""
    spark, own = batch.sparkSession, f"b{batch_id}"
    days = [r[DAY_COLUMN] for r in with_day(batch).select(DAY_COLUMN).distinct().collect()]  # one value per day in the batch
    _catch_up(spark, batch, path, days, own)
    if not Folders(spark, path).exists(hashes_path(path)):
        return None
    dated = [d for d in days if d is not None]
    touched = F.col(DAY_COLUMN).isin(dated) if dated else F.lit(False)
    touched = touched | F.col(DAY_COLUMN).isNull() if None in days else touched
    return spark.read.schema(SCHEMA).parquet(hashes_path(path)).where(touched & (F.col(WRITE_COLUMN) != own)).select(*KEYS)


def new_rows(batch: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Distinct rows of a micro-batch that no other batch has brought to the table at ``path``.

    A row may come again at any later time, and a genuine row may be late by any time, so the batch is compared with all
    rows of the days it touches, with NULLs equal. What this batch wrote before, in an attempt that failed, does not count.
    """
    rows = batch.distinct()
    known = known_hashes(batch, path, batch_id)
    if known is None:
        return rows
    keyed = rows.withColumns(dict(zip(KEYS, row_keys(batch.columns))))
    return keyed.join(known.join(keyed.select(*KEYS), KEYS, "left_semi"), KEYS, "left_anti").select(*batch.columns)

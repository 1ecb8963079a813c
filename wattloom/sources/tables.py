"""Curated tables and the device dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.contracts import STREAMS, table_schema
from wattloom.functions.timestamps import DAY_COLUMN, from_epoch_ms


def read_curated(spark: SparkSession, name: str, root: str | None = None, keep_lineage: bool = False) -> DataFrame:
    """A curated table by name: a catalog table, or the folder ``<root>/<name>``.

    A folder is read with the contract's columns, the day and, if asked for, the lineage, whichever files it has.
    """
    stream = name.split(".")[-1]
    if stream not in STREAMS:
        raise KeyError(f"unknown stream {name!r}")
    if root is None:
        return spark.table(name)
    columns = table_schema(stream).fields
    lineage = [T.StructField("_batch_id", T.LongType()), T.StructField("_committed_at", T.TimestampNTZType())]
    day, write = T.StructField(DAY_COLUMN, T.DateType()), T.StructField("_write_id", T.StringType())
    table = spark.read.schema(T.StructType([*columns, *lineage, day, write])).parquet(f"{root.rstrip('/')}/{name}")
    kept = [*columns, *lineage, day, write] if keep_lineage else [*columns, day]
    return table.select(*[f.name for f in kept])


def read_device_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The device dimension with the installation time as a timestamp."""
    return with_install_time(spark.read.schema(table_schema("device_metadata")).parquet(path))


def with_install_time(df: DataFrame) -> DataFrame:
    return df.withColumn("installed_at", from_epoch_ms("installed_at_ms")).drop("installed_at_ms")


def tag_rows(df: DataFrame, label: str, column: str = "stream") -> DataFrame:
    return df.withColumn(column, F.lit(label))

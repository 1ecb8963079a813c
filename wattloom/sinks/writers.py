"""Writing landed files, curated tables and models.

Before a partitioned write rows are rebalanced by the partition columns: the adaptive planner then
splits an hour or day that is too large for one task, and all rows of a small one meet in one file.
Merging small shuffle partitions is off meanwhile: a partition value's rows are together anyway, so
it would not save files, only make one task write many.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from wattloom.contracts import STREAMS, table_schema
from wattloom.functions.timestamps import DAY_COLUMN, moment, partition_columns, to_epoch_ms
from wattloom.session import settings
from wattloom.sources.raw import LAYOUT

BATCH_COLUMN = "_batch_id"
COMMIT_COLUMN = "_committed_at"
WRITE_COLUMN = "_write_id"
# Shuffled bytes that go into one file of a partitioned write.
FILE_SIZE = "512m"


def _parquet(df: DataFrame, mode: str, partitions: Sequence[str]) -> DataFrameWriter:
    writer = df.write.format("parquet").mode(mode).option("compression", "zstd").option("parquet.compression.codec.zstd.level", "3")
    return writer.partitionBy(*partitions) if partitions else writer


def _spread(spark: SparkSession, partitions: Sequence[str]):
    if not partitions:
        return nullcontext()
    return settings(
        spark, spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__adaptive__advisoryPartitionSizeInBytes=FILE_SIZE
    )


def write_raw(df: DataFrame, root: str, stream: str, flushed_at: datetime | str | None = None, mode: str = "append") -> str:
    """Land rows as Parquet under year/month/day/hour, event time as epoch milliseconds.

    With ``flushed_at`` all rows go under that hour, as a buffering producer does; otherwise each row
    goes under its own hour.
    """
    filed_under = moment(flushed_at) if flushed_at is not None else F.col("timestamp")
    landed = df.select(
        *[to_epoch_ms(c).alias(c) if c == "timestamp" else F.col(c) for c in df.columns], *partition_columns(filed_under)
    )
    path = f"{root.rstrip('/')}/{stream}"
    with _spread(df.sparkSession, LAYOUT):
        _parquet(landed.hint("rebalance", *LAYOUT), mode, LAYOUT).save(path)
    return path


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn(DAY_COLUMN, F.to_date("timestamp"))


def append_curated(
    df: DataFrame, root: str, stream: str, batch_id: int | None = None, committed_at: datetime | str | None = None
) -> str:
    """Append rows to the day partitions of a curated table, always with the lineage columns that as-of reads need."""
    rows = with_day(df).withColumns({BATCH_COLUMN: F.lit(batch_id).cast("long"), COMMIT_COLUMN: moment(committed_at)})
    path = f"{root.rstrip('/')}/{stream}"
    with _spread(df.sparkSession, [DAY_COLUMN]):
        _parquet(rows.hint("rebalance", DAY_COLUMN), "append", [DAY_COLUMN]).save(path)
    return path


def commit_batch(df: DataFrame, path: str, batch_id: int, committed_at: datetime | str) -> None:
    """Write a batch so that writing it again replaces it.

    Its files live in partitions named after the batch, and only those partitions are overwritten.
    """
    rows = (
        with_day(df)
        .withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long"))
        .withColumn(COMMIT_COLUMN, moment(committed_at))
        .withColumn(WRITE_COLUMN, F.lit(f"b{batch_id}"))
    )
    partitions = [DAY_COLUMN, WRITE_COLUMN]
    writer = _parquet(rows.hint("rebalance", DAY_COLUMN), "overwrite", partitions)
    with _spread(df.sparkSession, partitions):
        writer.option("partitionOverwriteMode", "dynamic").save(path)


def write_clustered(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (), mode: str = "errorifexists"
) -> str:
    """Write rows to a folder, partitioned and clustered for skipping."""
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    if cluster_by:
        rows = rows.sortWithinPartitions(*partition_by, *cluster_by)
    with _spread(df.sparkSession, partition_by):
        _parquet(rows, mode, partition_by).option("partitionOverwriteMode", "static").save(path)
    return path


def ensure_tables(spark: SparkSession, schema: str, streams: Sequence[str] = STREAMS) -> list[str]:
    """Create the curated tables that do not exist yet; returns the names it created."""
    created = []
    for stream in streams:
        name = f"{schema}.{stream}"
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema(stream))
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {DAY_COLUMN} date) USING parquet PARTITIONED BY ({DAY_COLUMN})")
            created.append(name)
    return created


def insert_select(df: DataFrame, table: str) -> None:
    """``INSERT INTO table SELECT * FROM df``: columns go by position."""
    spark = df.sparkSession
    # Partition columns come last in a table, whatever the rows call them.
    count = sum(c.isPartition for c in spark.catalog.listColumns(table))
    partitions = df.columns[len(df.columns) - count :]
    with _spread(spark, partitions):
        (df.hint("rebalance", *partitions) if partitions else df).write.insertInto(table, overwrite=False)


def create_table_as(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """``CREATE TABLE table AS SELECT * FROM df``; fails where the table exists."""
    with _spread(df.sparkSession, partition_by):
        _parquet(df.hint("rebalance", *partition_by) if partition_by else df, "errorifexists", partition_by).saveAsTable(table)

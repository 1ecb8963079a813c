"""Landed files to curated tables, safe to stop and replay."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from wattloom.contracts import raw_schema
from wattloom.functions.timestamps import DAY_COLUMN
from wattloom.sinks.writers import WRITE_COLUMN, commit_batch
from wattloom.sources.raw import conform, read_batch
from wattloom.streaming.copies import new_rows, note_rows

BatchWriter = Callable[[DataFrame, int], None]

def landing_stream(
    spark: SparkSession,
    root: str,
    stream: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    done_with: str | None = None,
) -> DataFrame:
    """Files of a stream as they land; see ``each_batch``. The limits cap one micro-batch.

    A file counts however old it is when it lands. With ``done_with`` files move to that folder once their batch is
    committed, so that a trigger lists only what is new.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("give either max_files or max_bytes")
    reader = spark.readStream.schema(raw_schema(stream)).option("recursiveFileLookup", "true")
    # Files keep the time they were written at; copies and late uploads may carry any.
    reader = reader.option("maxFileAge", "36500d")
    if done_with is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", done_with)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(f"{root.rstrip('/')}/{stream}")


def flush_policy(writer: DataStreamWriter, every: str | None = None) -> DataStreamWriter:
    """A micro-batch every interval, or, without one, everything that has landed and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def each_batch(df: DataFrame, stream: str, checkpoint: str, write: BatchWriter, every: str | None = None) -> StreamingQuery:
    """Start a job that gives ``write`` the rows of landed files, a micro-batch at a time.

    The stream itself carries only the files' names, one micro-batch's at a time; they are then read as a batch, since
    their columns may have lost their types.
    """

    def typed(batch: DataFrame, batch_id: int) -> None:
        files = [r["file"] for r in batch.distinct().collect()]
        write(conform(read_batch(batch.sparkSession, files, stream), stream), batch_id)

    names = df.select(F.col("_metadata.file_path").alias("file"))
    writer = names.writeStream.option("checkpointLocation", checkpoint).foreachBatch(typed)
    return flush_policy(writer, every).start()


def commit_time(spark: SparkSession, path: str, batch_id: int) -> datetime:
    """The batch's commit time: set once, read again when the batch is replayed."""
    log = f"{path.rstrip('/')}_commits/batch={batch_id}"
    try:
        return spark.read.parquet(log).first()["committed_at"]
    except AnalysisException:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        spark.range(1).select(F.lit(str(now)).cast("timestamp_ntz").alias("committed_at")).coalesce(1).write.mode(
            "overwrite"
        ).parquet(log)
        return now


def curated_batch_writer(path: str, drop_copies: bool = False):
    """``foreachBatch`` function that appends a micro-batch; a replay replaces what it wrote before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        committed = commit_time(spark, path, batch_id)
        if drop_copies:
            # A table cannot be read and overwritten in one job, not even in different partitions.
            staged = f"{path.rstrip('/')}_staged/slot={batch_id % 2}"
            new_rows(batch, path, batch_id).write.mode("overwrite").parquet(staged)
            batch = spark.read.schema(batch.schema).parquet(staged)
        commit_batch(batch, path, batch_id, committed)
        if drop_copies:
            note_rows(batch, path, batch_id)

    return write


def curated_schema(schema: T.StructType) -> T.StructType:
    """A table's columns with its partition columns."""
    return T.StructType([*schema.fields, T.StructField(DAY_COLUMN, T.DateType()), T.StructField(WRITE_COLUMN, T.StringType())])


def ingest(
    spark: SparkSession,
    landing: str,
    stream: str,
    curated: str,
    checkpoint: str,
    every: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    drop_copies: bool = False,
    done_with: str | None = None,
) -> StreamingQuery:
    """Start the job from landed files to the curated table at ``<curated>/<stream>``.

    Stopping it loses nothing: the checkpoint knows which files a batch read, and a failed batch
    is run again under the same number. ``drop_copies`` drops rows that are equal in
    every column to one that came before, whenever that was: those of files that landed twice.
    """
    rows = landing_stream(spark, landing, stream, max_files, max_bytes, done_with)
    return each_batch(rows, stream, checkpoint, curated_batch_writer(f"{curated.rstrip('/')}/{stream}", drop_copies), every)

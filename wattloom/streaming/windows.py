"""Live time-bucketed aggregates from mergeable parts.

A micro-batch is aggregated by itself into sums, counts and extremes of its buckets, and these parts are written under
the batch's own name; a replay replaces them. Reading merges the parts of a bucket. So a trigger reads its own batch and
nothing else, no rows are kept a second time, no state is held between batches, and a row counts however late it comes.
``fold`` merges the parts of settled batches, so that reading does not slow down with the number of triggers.

Sums are decimals, so that parts add up to the same in any order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattloom.functions.numbers import fixed
from wattloom.functions.timestamps import DAY_COLUMN, bucket
from wattloom.sinks.maintenance import Compaction, compact
from wattloom.sinks.writers import WRITE_COLUMN
from wattloom.streaming.ingest import curated_schema, each_batch

Merge = Callable[[str], Column]


@dataclass(frozen=True)
class LiveAggregate:
    """An aggregate by ``keys``, of which ``time`` is a bucket within a day.

    ``parts`` are combinable aggregates of rows with the function that merges them; ``measures`` are made of merged parts.
    """

    time: str
    keys: Mapping[str, Column]
    parts: Mapping[str, tuple[Column, Merge]]
    measures: Mapping[str, Column]

    def of_batch(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*[c.alias(k) for k, c in self.keys.items()]).agg(*[c.alias(p) for p, (c, _) in self.parts.items()])

    def merged(self, parts: DataFrame, *also: str) -> DataFrame:
        return parts.groupBy(*self.keys, *also).agg(*[merge(p).cast(parts.schema[p].dataType).alias(p) for p, (_, merge) in self.parts.items()])

    def result(self, parts: DataFrame) -> DataFrame:
        return self.merged(parts).select(*self.keys, *[c.alias(m) for m, c in self.measures.items()])


def temperature_per_minute(scale: int = 6) -> LiveAggregate:
    return LiveAggregate(
        "ts",
        {"ts": bucket("minute", "timestamp")},
        {
            "_sum": (F.sum(fixed("value_celsius", scale)), F.sum),
            "_values": (F.count("value_celsius"), F.sum),
            "_max": (F.max("value_celsius"), F.max),
            "_rows": (F.count(F.lit(1)), F.sum),
        },
        {"avg_temp_c": F.try_divide(F.col("_sum").cast("double"), F.col("_values")), "max_temp_c": F.col("_max"), "n": F.col("_rows")},
    )


def session_events_hourly() -> LiveAggregate:
    keys = {"hour": bucket("hour", "timestamp"), "event_type": F.col("event_type"), "severity": F.col("severity")}
    return LiveAggregate("hour", keys, {"_rows": (F.count(F.lit(1)), F.sum)}, {"n": F.col("_rows")})


def bucket_writer(path: str, live: LiveAggregate):
    """``foreachBatch`` function that adds a micro-batch's parts; a replay overwrites the partitions it wrote before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        parts = live.of_batch(batch).withColumn(DAY_COLUMN, F.to_date(live.time)).withColumn(WRITE_COLUMN, F.lit(f"b{batch_id}"))
        writer = parts.hint("rebalance", DAY_COLUMN).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY_COLUMN, WRITE_COLUMN).parquet(path)

    return write


def keep_current(df: DataFrame, stream: str, live: LiveAggregate, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start the job that maintains the parts of a time-bucketed aggregate under ``path``."""
    return each_batch(df, stream, checkpoint, bucket_writer(path, live), every)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """All parts, with the partition columns in their types also where no day is known."""
    found = spark.read.parquet(path)
    own = [f for f in found.schema if f.name not in (DAY_COLUMN, WRITE_COLUMN)]
    return spark.read.schema(curated_schema(T.StructType(own))).parquet(path)


def read_current(spark: SparkSession, path: str, live: LiveAggregate) -> DataFrame:
    """The complete result over all batches so far. A filter on days (``timestamp_day``) belongs on ``read_parts``."""
    return live.result(read_parts(spark, path))


def fold(spark: SparkSession, path: str, live: LiveAggregate, before_batch: int | None = None) -> Compaction:
    """Merge the parts of batches that won't be replayed, day by day; run it while the job is stopped."""
    return compact(spark, path, before_batch=before_batch, cluster_by=[live.time], combine=live.merged)

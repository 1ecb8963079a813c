"""Derating onsets on a live stream, right also for rows that come late.

The rows that matter to the latch are cut into segments: one per device, day and micro-batch. Within a segment onsets depend on
its own rows only; between segments all that matters is a segment's first row and the last row of the one before it. So
a micro-batch stores, under its own name, one summary per segment and the onsets inside it; a replay replaces them, nothing that
earlier batches wrote is read for its rows, and ``read_onsets`` chains the summaries in event time.

Chaining is right while the segments of a device's day do not overlap in time. A micro-batch whose segment overlaps an earlier
one has late rows: that device's day alone is read again from the history, and its new segment takes the place of those before.
This takes onsets back as well as adding them, also on the following days, whose first rows are judged when reading.
The history is read once per such micro-batch: what it has of the late device days is written to two folders in turn.

A device may bring a large part of a micro-batch: segments are scanned with the batch operator, which cuts heavy keys.
Rows without a time come before all others, in the order of their batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, time, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattloom.functions.rules import DERATED_FROM_PCT
from wattloom.functions.timestamps import DAY_COLUMN, day_of
from wattloom.operators.ordered import order_rows, previous_row
from wattloom.operators.skew import TASK_ROWS
from wattloom.sources.landed import read_indexed
from wattloom.sources.raw import conform
from wattloom.streaming.ingest import each_batch

BATCH = "batch"
# Reads the stream's rows of some days, those of all earlier micro-batches at least; rows may repeat.
History = Callable[[SparkSession, Sequence[date]], DataFrame]

_ROW = "device_id string, timestamp timestamp_ntz, derate_pct double"
_WHERE = f"{DAY_COLUMN} date, {BATCH} long"
_INNER = f"{_ROW}, {_WHERE}"
_SEGMENT = f"device_id string, first_ts timestamp_ntz, first_pct double, last_ts timestamp_ntz, last_pct double, rebuilt boolean, {_WHERE}"


def spans_of(days: Sequence[date]) -> list[tuple[datetime, datetime]]:
    """Runs of consecutive days as time ranges."""
    spans: list[tuple[datetime, datetime]] = []
    for day in sorted(set(days)):
        start = datetime.combine(day, time())
        if spans and spans[-1][1] == start:
            start = spans.pop()[0]
        spans.append((start, datetime.combine(day, time()) + timedelta(days=1)))
    return spans


def landed_history(root: str, stream: str, index: str) -> History:
    """The landed files themselves, through the index that knows each file's event times. Files must not have been moved away."""

    def read(spark: SparkSession, days: Sequence[date]) -> DataFrame:
        parts = [conform(read_indexed(spark, root, stream, index, *span), stream) for span in spans_of(days)]
        return reduce(DataFrame.unionAll, parts)

    return read


def curated_history(path: str) -> History:
    """The curated table of the stream, where the job that fills it is never behind this one."""

    def read(spark: SparkSession, days: Sequence[date]) -> DataFrame:
        return spark.read.parquet(path).where(F.col(DAY_COLUMN).isin(list(days)))

    return read


def matter(df: DataFrame, limit: float = DERATED_FROM_PCT) -> DataFrame:
    """Rows that set or reset the latch, with their day."""
    found = df.select("device_id", "timestamp", "derate_pct", day_of(df).alias(DAY_COLUMN))
    return found.where(F.col("derate_pct").isNull() | (F.col("derate_pct") >= limit))


def segments(rows: DataFrame) -> DataFrame:
    """First and last row per device and day. Of rows at one time those that reset come first."""
    row = F.struct("timestamp", "derate_pct")
    ends = rows.groupBy("device_id", DAY_COLUMN).agg(F.min(row).alias("first"), F.max(row).alias("last"))
    names = {f"{end}_{short}": F.col(f"{end}.{field}") for end in ("first", "last") for short, field in (("ts", "timestamp"), ("pct", "derate_pct"))}
    return ends.select("device_id", *[c.alias(n) for n, c in names.items()], DAY_COLUMN)


def inner_onsets(rows: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Rows that set the latch right after a reset of the same device and day."""
    marked = rows.withColumns({"_rank": F.coalesce("derate_pct", F.lit(-1.0)), "_row": F.lit(True)})
    ordered = order_rows(marked, ["device_id", DAY_COLUMN], ["timestamp", "_rank"], task_rows)
    scanned = previous_row(ordered, ["derate_pct", "_row"]).result()
    fired = F.col("derate_pct").isNotNull() & F.col("prev__row").isNotNull() & F.col("prev_derate_pct").isNull()
    return scanned.where(fired).select("device_id", "timestamp", "derate_pct", DAY_COLUMN)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _among(df: DataFrame, keys: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on ``names``, with NULL equal to NULL."""
    wanted = keys.select(*[F.col(n).alias(f"_{n}") for n in names])
    return df.join(wanted, reduce(lambda a, b: a & b, [df[n].eqNullSafe(wanted[f"_{n}"]) for n in names]), how)


def overlapping(new: DataFrame, known: DataFrame) -> DataFrame:
    """Device days whose new segment overlaps a known one, each once."""
    before = known.select(
        F.col("device_id").alias("_device"), F.col(DAY_COLUMN).alias("_day"), F.col("first_ts").alias("_first"), F.col("last_ts").alias("_last")
    )
    same = new["device_id"].eqNullSafe(before["_device"]) & (new[DAY_COLUMN] == before["_day"])
    meets = (new["first_ts"] <= before["_last"]) & (new["last_ts"] >= before["_first"])
    return new.join(before, same & meets, "left_semi").select("device_id", DAY_COLUMN)


def onset_writer(path: str, history: History, limit: float = DERATED_FROM_PCT, task_rows: int = TASK_ROWS):
    """``foreachBatch`` function that stores a micro-batch's segments and the onsets inside them."""
    segment_path, inner_path = f"{path}/segments", f"{path}/inner"

    def store(df: DataFrame, batch_id: int, to: str) -> None:
        named = df.withColumn(BATCH, F.lit(batch_id).cast("long")).hint("rebalance", DAY_COLUMN)
        writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY_COLUMN, BATCH).parquet(to)

    def staged(df: DataFrame, name: str, batch_id: int) -> DataFrame:
        to = f"{path}/{name}/slot={batch_id % 2}"
        df.write.mode("overwrite").parquet(to)
        return df.sparkSession.read.schema(df.schema).parquet(to)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = matter(batch, limit).persist()
        try:
            new = segments(rows)
            days = [r[0] for r in rows.select(DAY_COLUMN).distinct().collect() if r[0] is not None]
            known = _stored(spark, segment_path, _SEGMENT).where(F.col(DAY_COLUMN).isin(days) & (F.col(BATCH) < batch_id))
            # Written, because the table that tells what is late is about to be written to.
            late = staged(overlapping(new, known), "late", batch_id)
            late_days = [r[0] for r in late.select(DAY_COLUMN).distinct().collect()]
            found, judged = new.withColumn("rebuilt", F.lit(False)), rows
            if late_days:
                keys = ["device_id", DAY_COLUMN]
                # Rows that come twice lie side by side in the scan, so they change neither segments nor onsets.
                again = matter(history(spark, late_days), limit).unionByName(rows)
                # Written, because it is used several times and the history is much larger than what is left of it.
                whole = staged(_among(again, late, keys, "left_semi").hint("rebalance", *keys), "again", batch_id)
                found = _among(found, late, keys, "left_anti").unionByName(segments(whole).withColumn("rebuilt", F.lit(True)))
                judged = _among(rows, late, keys, "left_anti").unionByName(whole)
            # Onsets count only with their segment, so that one is written last.
            store(inner_onsets(judged, task_rows), batch_id, inner_path)
            store(found, batch_id, segment_path)
        finally:
            rows.unpersist()

    return write


def read_onsets(spark: SparkSession, path: str) -> DataFrame:
    """Per device, the first row at or above the limit after each absence of derating: device_id, timestamp, derate_pct."""
    of_day = Window.partitionBy("device_id", DAY_COLUMN)
    since = F.coalesce(F.max(F.when(F.col("rebuilt"), F.col(BATCH))).over(of_day), F.lit(-1))
    kept = _stored(spark, f"{path}/segments", _SEGMENT).withColumn("_since", since).where(F.col(BATCH) >= F.col("_since")).drop("_since")
    before = F.lag("last_pct").over(Window.partitionBy("device_id").orderBy("first_ts", BATCH))
    firsts = kept.withColumn("_before", before).where("first_pct is not null and _before is null")
    inside = _among(_stored(spark, f"{path}/inner", _INNER), kept, ["device_id", DAY_COLUMN, BATCH], "left_semi")
    return firsts.select("device_id", F.col("first_ts").alias("timestamp"), F.col("first_pct").alias("derate_pct")).unionByName(
        inside.select("device_id", "timestamp", "derate_pct")
    )


def derate_onsets(
    df: DataFrame,
    path: str,
    checkpoint: str,
    history: History,
    every: str | None = None,
    limit: float = DERATED_FROM_PCT,
    task_rows: int = TASK_ROWS,
) -> StreamingQuery:
    """Start the job that keeps what ``read_onsets`` needs under ``path``."""
    return each_batch(df, "evse_state", checkpoint, onset_writer(path, history, limit, task_rows), every)

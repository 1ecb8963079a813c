"""Keeping day-partitioned tables healthy: compaction and point-in-time reads."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.hashing import row_hash
from wattloom.functions.timestamps import DAY_COLUMN, moment
from wattloom.sinks.folders import Folders
from wattloom.sinks.writers import BATCH_COLUMN, COMMIT_COLUMN, WRITE_COLUMN


# What Spark names the folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Files below this share of the target size are small.
SMALL_SHARE = 0.5
KEPT = "_kept"


@dataclass(frozen=True)
class Compaction:
    """Days that changed, and the files that were rewritten."""

    days: int
    bytes_before: int
    files_before: int
    files_after: int


class CompactionError(RuntimeError):
    pass


def content(df: DataFrame, columns: Sequence[str]) -> tuple:
    """Row count and a sum of row hashes: equal for equal contents in any order."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_hash(columns)).alias("h")).first()
    return row["n"], row["h"]


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """The data files of a day-partitioned table, as rows: day and write (folders), unit (path inside the day), length, modified.

    Listed by Spark; nothing is read from the files, and no name passes through Python.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    inside = F.regexp_extract("path", rf"/({DAY_COLUMN}=[^/]*)/(.*)$", 2)
    return found.select(
        F.regexp_extract("path", rf"/({DAY_COLUMN}=[^/]*)/", 1).alias("day"),
        F.when(inside.startswith(f"{WRITE_COLUMN}="), F.substring_index(inside, "/", 1)).alias("write"),
        inside.alias("unit"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def _batch(name: Column) -> Column:
    """The batch that a folder of a day was written by; NULL for merged ones."""
    return F.regexp_extract(name, r"b(\d+)$", 1).try_cast("bigint")


def _settled(name: Column, before: int) -> Column:
    return F.coalesce(_batch(name) < before, F.lit(True))


def _kept(spark: SparkSession, aside: str) -> dict[str, list[str]]:
    """By day: files and folders of it that a compaction does not rewrite. As many as large files and open batches."""
    found: dict[str, list[str]] = {}
    for r in spark.read.schema("day string, unit string").parquet(f"{aside}/{KEPT}").collect():
        found.setdefault(r["day"], []).append(r["unit"])
    return found


def _swap_in(folders: Folders, path: str, aside: str, replaced: str, day: str, kept: Sequence[str]) -> None:
    """Put a day's new folder, completed by what the old one keeps, in the place that the old one has left."""
    folders.make(f"{aside}/{day}")
    for unit in kept:
        if folders.exists(f"{replaced}/{day}/{unit}"):
            folders.move(f"{replaced}/{day}/{unit}", f"{aside}/{day}/{unit}")
    folders.move(f"{aside}/{day}", f"{path}/{day}")


def recover(spark: SparkSession, path: str) -> None:
    """Complete or undo what a compaction left when it died.

    A day is swapped by moving the old folder away and the new one in. The folders a compaction works in tell how far it
    came: a day that is missing from the table gets its new files if they are there, and its old ones otherwise.
    """
    path, folders = path.rstrip("/"), Folders(spark, path)
    left = folders.names(path)
    for replaced in (n for n in left if n.startswith("_replaced-")):
        aside = replaced.replace("_replaced-", "_compacted-")
        kept = None
        for day in folders.names(f"{path}/{replaced}"):
            if not folders.exists(f"{path}/{day}"):
                if folders.exists(f"{path}/{aside}/{day}"):
                    kept = _kept(spark, f"{path}/{aside}") if kept is None else kept
                    _swap_in(folders, path, f"{path}/{aside}", f"{path}/{replaced}", day, kept.get(day, ()))
                else:
                    folders.move(f"{path}/{replaced}/{day}", f"{path}/{day}")
        folders.drop(f"{path}/{replaced}")
    for aside in (n for n in left if n.startswith("_compacted-")):
        folders.drop(f"{path}/{aside}")


def compact(
    spark: SparkSession,
    path: str,
    since: date | str | None = None,
    target_mb: float = 512,
    before_batch: int | None = None,
    cluster_by: Sequence[str] = ("device_id", "timestamp"),
    combine: Callable[..., DataFrame] | None = None,
) -> Compaction:
    """Rewrite the small files of day partitions into files of about ``target_mb``; rows do not change.

    The files are listed by one job. Small ones (below half the target) of each day are put in bins of the target size,
    in the order they came, and only they are read: each bin becomes one file, sorted by ``cluster_by``. Days whose small
    files are no more than their bins are left alone; large files stay as they are. Rows without a time are a day. Files
    of a stream's batches are merged where the batch is before ``before_batch``; a batch that may still be replayed stays
    apart, and unless told otherwise that is the newest one.

    Files may differ in their columns: the copy has the columns of all of them, and files whose types disagree are an error.
    It is written beside the table, compared with the original, and only then moved into place day by day.
    With ``combine`` the rows of a bin are merged by that function of (rows, columns to keep apart), which must give the same
    in any order. If a move fails all is moved back; if the job dies the next compaction, or ``recover``, completes or undoes each day. Run it
    while no job appends; a reader that lists a day while it is swapped finds none of its files.
    """
    path = path.rstrip("/")
    folders = Folders(spark, path)
    recover(spark, path)
    listed = file_list(spark, path)
    if since is not None:
        listed = listed.where((F.col("day") >= f"{DAY_COLUMN}={since}") | (F.col("day") == f"{DAY_COLUMN}={NO_VALUE}"))
    if before_batch is None:
        before_batch = listed.agg(F.max(_batch(F.col("write")))).first()[0] or 0
    target = max(1, int(target_mb * 1024 * 1024))
    small = F.col("length") < SMALL_SHARE * target
    arrived = Window.partitionBy("day").orderBy("modified", "unit").rowsBetween(Window.unboundedPreceding, -1)
    chosen = listed.where(small & _settled(F.col("write"), before_batch))
    binned = chosen.withColumn("bin", F.floor(F.coalesce(F.sum("length").over(arrived), F.lit(0)) / target).cast("int"))
    per_day = binned.groupBy("day").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("bin").alias("last"), F.count_distinct("bin").alias("bins")
    )
    plan = sorted(per_day.where("files > bins").collect())  # a row for each day
    if not plan:
        return Compaction(0, 0, 0, 0)
    days = [r["day"] for r in plan]
    offsets, pieces = [], 0
    for r in plan:
        offsets.append((r["day"], pieces))
        pieces += r["last"] + 1

    # The columns of all files of these days, whatever each of them has.
    reader = spark.read.option("basePath", path)
    inside = [f"{path}/{d}" for d in days]
    found = reader.option("mergeSchema", "true").parquet(*inside)
    partitions = [c for c in (DAY_COLUMN, WRITE_COLUMN) if c in found.columns]
    kinds = {DAY_COLUMN: T.DateType(), WRITE_COLUMN: T.StringType()}
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found.schema])
    at = F.col("_metadata.file_path")
    selected = reader.schema(schema).parquet(*inside).where(F.col("_metadata.file_size") < SMALL_SHARE * target)
    if WRITE_COLUMN in partitions:
        selected = selected.where(_settled(F.col(WRITE_COLUMN), before_batch))

    placed = binned.join(F.broadcast(spark.createDataFrame(offsets, "day string, offset int")), "day")
    placed = placed.select(F.concat_ws("/", "day", "unit").alias("_file"), (F.col("offset") + F.col("bin")).alias("_bin"))
    rows = selected.withColumn("_file", F.regexp_extract(at, rf"/({DAY_COLUMN}=.*)$", 1)).join(placed, "_file").drop("_file")
    if WRITE_COLUMN in partitions:
        rows = rows.withColumn(WRITE_COLUMN, F.lit("merged"))
    token = uuid.uuid4().hex[:12]
    aside, replaced = f"{path}/_compacted-{token}", f"{path}/_replaced-{token}"
    if combine is not None:
        rows = combine(rows, *partitions, "_bin")
    order = [*partitions, *[c for c in cluster_by if c in schema.names]]
    sorted_bins = rows.repartitionById(pieces, F.col("_bin")).drop("_bin").sortWithinPartitions(*order)
    sorted_bins.write.option("compression", "zstd").partitionBy(*partitions).parquet(aside)

    columns = [c for c in schema.names if c != WRITE_COLUMN]
    whole = (lambda df: df) if combine is None else (lambda df: combine(df, DAY_COLUMN))
    if content(whole(selected), columns) != content(whole(spark.read.schema(schema).parquet(aside)), columns):
        folders.drop(aside)
        raise CompactionError(f"compacted copy of {path} differs from the original")
    after = file_list(spark, aside).count()
    # Batches that stay apart move as folders, large files one by one.
    staying = listed.where(F.col("day").isin(days)).withColumn("_rewritten", small & _settled(F.col("write"), before_batch))
    folders_of = staying.where(F.col("write").isNotNull()).groupBy("day", "write").agg(F.bool_or("_rewritten").alias("_part"))
    apart = folders_of.where("not _part").select("day", F.col("write").alias("unit"))
    single = staying.where("not _rewritten").join(apart.withColumnRenamed("unit", "write"), ["day", "write"], "left_anti").select("day", "unit")
    apart.unionAll(single).coalesce(1).write.parquet(f"{aside}/{KEPT}")
    kept = _kept(spark, aside)

    folders.make(replaced)
    moved: list[str] = []
    try:
        for day in days:
            folders.move(f"{path}/{day}", f"{replaced}/{day}")
            moved.append(day)
            _swap_in(folders, path, aside, replaced, day, kept.get(day, ()))
    except Exception:
        for day in moved:
            new = f"{path}/{day}" if folders.exists(f"{path}/{day}") else f"{aside}/{day}"
            for unit in kept.get(day, ()):
                if not folders.exists(f"{replaced}/{day}/{unit}"):
                    folders.move(f"{new}/{unit}", f"{replaced}/{day}/{unit}")
            if folders.exists(f"{path}/{day}"):
                folders.drop(f"{path}/{day}")
            folders.move(f"{replaced}/{day}", f"{path}/{day}")
        folders.drop(replaced)
        folders.drop(aside)
        raise
    folders.drop(replaced)
    folders.drop(aside)
    spark.catalog.refreshByPath(path)
    return Compaction(len(days), sum(r["bytes"] for r in plan), sum(r["files"] for r in plan), after)


def read_as_of(
    table: DataFrame, version: int | None = None, at: datetime | str | Column | None = None, keep_lineage: bool = False
) -> DataFrame:
    """The rows an append-only table had after batch ``version``, or at a commit time.

    Rows that were appended without a batch belong to no version, so asking for one where there are such rows is an error.
    """
    if (version is None) == (at is None):
        raise ValueError("give either version or at")
    lineage = BATCH_COLUMN if version is not None else COMMIT_COLUMN
    if lineage not in table.columns or not table.where(F.col(lineage).isNull()).select(F.lit(1)).limit(1).isEmpty():
        raise ValueError(f"some rows have no {lineage}")
    kept = table.where(F.col(BATCH_COLUMN) <= version) if version is not None else table.where(F.col(COMMIT_COLUMN) <= moment(at))
    return kept if keep_lineage else kept.drop(BATCH_COLUMN, COMMIT_COLUMN, WRITE_COLUMN)

"""A kept index of landed files, so that a read opens only the files it needs.

The index is a Parquet table beside the landing folder, one row per file: path, modification time, length, the columns
that have lost their type, row count, least and greatest event time. Footers are read once per file, by tasks, when
the index is refreshed; a file that was replaced counts as new, and one that is gone is no longer found.

A bounded read takes the files whose event times overlap the range, wherever they lie: rows flushed late, and rows
stamped ahead of the hour they were flushed in. Folders whose files are all needed, and read alike, are given to Spark
as a whole: a year, a month, a day or an hour. Only the files of other folders are named one by one. So what the driver
holds grows with the hours of the landing folder and the files of mixed hours, not with all files.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.contracts import raw_schema
from wattloom.session import shuffle_partitions
from wattloom.sources.raw import LAYOUT, epoch_ms, landing_schema, typed_part

FILE_KEY = ["path", "modified", "length"]
SCHEMA = "path string, modified timestamp, length bigint, lost string, rows bigint, least bigint, greatest bigint"
# Footers that are worth a task of their own: each costs a few milliseconds.
FOOTERS_PER_TASK = 20
HOUR_FOLDER = "/" + "/".join(rf"{c}=\d+" for c in LAYOUT) + "$"


def list_files(spark: SparkSession, root: str, stream: str) -> DataFrame:
    """The landed files of a stream: path, modified, length. Spark lists them; nothing is read and no name passes through Python."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return found.load(f"{root.rstrip('/')}/{stream}").select("path", F.col("modificationTime").alias("modified"), "length")


def read_footers(files: DataFrame, stream: str) -> DataFrame:
    """Rows of the index for listed files. Event times are NULL where a file has no statistics of them."""
    wanted = {f.name for f in raw_schema(stream)}

    # Defined here, so that it travels to the workers by value and they need not have this package.
    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from urllib.parse import quote

        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        def event_times(footer, column: int) -> tuple[int | None, int | None]:
            """Least and greatest event time, if every row group with rows tells them."""
            ends = []
            for number in range(footer.num_row_groups):
                group = footer.row_group(number)
                known = group.column(column).statistics
                if known is not None and known.has_min_max:
                    ends += [known.min, known.max]
                elif group.num_rows and not (known is not None and known.has_null_count and known.null_count == group.num_rows):
                    return None, None
            return (min(ends), max(ends)) if ends else (None, None)

        for batch in batches:
            lost, rows, least, greatest = [], [], [], []
            for path in batch["path"]:
                if path.startswith("file:"):
                    system, place = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
                else:
                    system, place = fs.FileSystem.from_uri(quote(path, safe="/:=@"))
                with system.open_input_file(place) as file:
                    footer = pq.ParquetFile(file)
                    kinds = footer.schema_arrow
                    lost.append(",".join(sorted(f.name for f in kinds if pa.types.is_null(f.type) and f.name in wanted)))
                    rows.append(footer.metadata.num_rows)
                    names = footer.metadata.schema.names
                    times = event_times(footer.metadata, names.index("timestamp")) if "timestamp" in names else (None, None)
                    times = times if times[0] is None or isinstance(times[0], int) else (None, None)
                    least.append(times[0])
                    greatest.append(times[1])
            yield batch.assign(
                lost=lost, rows=rows, least=pd.array(least, dtype="Int64"), greatest=pd.array(greatest, dtype="Int64")
            )

    return files.mapInPandas(look, SCHEMA)


def _index_path(index: str, stream: str) -> str:
    return f"{index.rstrip('/')}/{stream}"


def _known(spark: SparkSession, index: str, stream: str) -> DataFrame | None:
    try:
        # An append that was cut short and done again may have left a file twice.
        return spark.read.schema(SCHEMA).parquet(_index_path(index, stream)).dropDuplicates(FILE_KEY)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def refresh(spark: SparkSession, root: str, stream: str, index: str) -> DataFrame:
    """Add the files that have landed since, and return the index rows of all files that are there now."""
    listed = list_files(spark, root, stream)
    known = _known(spark, index, stream)
    new = listed if known is None else listed.join(known, FILE_KEY, "left_anti")
    count = new.count()
    if count or known is None:
        tasks = min(shuffle_partitions(spark), count // FOOTERS_PER_TASK + 1)
        read_footers(new.repartition(tasks), stream).write.mode("append").parquet(_index_path(index, stream))
        known = _known(spark, index, stream)
    return known.join(listed, FILE_KEY, "left_semi")


def overlaps(start: datetime | str | None, end: datetime | str | None) -> Column:
    """Files that may hold rows of the range: also those whose event times are not known, but none without rows."""
    fits = F.lit(True) if start is None and end is None else F.col("rows") > 0
    if start is not None:
        fits = fits & F.coalesce(F.col("greatest") >= epoch_ms(start), F.lit(True))
    if end is not None:
        fits = fits & F.coalesce(F.col("least") < epoch_ms(end), F.lit(True))
    return fits


def _widest(folders: dict[str, str | None]) -> dict[str, list[str]]:
    """Hour folders joined to days, months, years and the whole stream, by the columns lost in all their files.

    ``None`` stands for a folder that cannot be read as a whole; neither can any folder above it.
    """
    out: dict[str, list[str]] = {}
    for _ in LAYOUT:
        above: dict[str, dict[str, str | None]] = {}
        for folder, lost in folders.items():
            above.setdefault(folder.rpartition("/")[0], {})[folder] = lost
        folders = {}
        for parent, inside in above.items():
            kinds = set(inside.values())
            folders[parent] = kinds.pop() if len(kinds) == 1 else None
            if folders[parent] is None:
                for folder, lost in inside.items():
                    if lost is not None:
                        out.setdefault(lost, []).append(folder)
    for folder, lost in folders.items():
        if lost is not None:
            out.setdefault(lost, []).append(folder)
    return out


def sources(entries: DataFrame, start: datetime | str | None = None, end: datetime | str | None = None) -> dict[str, list[str]]:
    """What a read of the range opens: folders and files by the columns (joined by commas) that have lost their type there."""
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    marked = entries.select("path", "lost", folder.alias("folder"), overlaps(start, end).alias("fits"))
    alike = F.bool_and("fits") & (F.min("lost") == F.max("lost"))
    by_folder = marked.groupBy("folder").agg(F.when(alike & F.col("folder").rlike(HOUR_FOLDER), F.min("lost")).alias("whole"))
    hours = by_folder.where(F.col("folder").rlike(HOUR_FOLDER)).collect()
    found = _widest({r["folder"]: r["whole"] for r in hours})
    for r in marked.where("fits").join(by_folder.where("whole is null"), "folder", "left_semi").select("path", "lost").collect():
        found.setdefault(r["lost"], []).append(r["path"])
    return found


def read_indexed(
    spark: SparkSession,
    root: str,
    stream: str,
    index: str,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
) -> DataFrame:
    """Landed rows of a stream with ``start <= event time < end``, through the index at ``index``, which is brought up to date.

    Finds rows of any folder, also those stamped later than the hour they were flushed in. Files that land while
    the read is planned may or may not be in it.
    """
    schema, base = landing_schema(stream), f"{root.rstrip('/')}/{stream}"
    parts = [
        typed_part(spark, sorted(paths), schema, tuple(lost.split(",")) if lost else (), {"basePath": base})
        for lost, paths in sorted(sources(refresh(spark, root, stream, index), start, end).items())
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    rows = reduce(DataFrame.unionAll, parts)
    if start is not None:
        rows = rows.where(F.col("timestamp") >= epoch_ms(start))
    if end is not None:
        rows = rows.where(F.col("timestamp") < epoch_ms(end))
    return rows

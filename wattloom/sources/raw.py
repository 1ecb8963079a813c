"""Landed Parquet files: ``<root>/<stream>/year=/month=/day=/hour=``, event time in epoch milliseconds."""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Iterator
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.contracts import raw_schema, table_schema
from wattloom.functions.timestamps import from_epoch_ms, moment
from wattloom.session import shuffle_partitions

LAYOUT = ("year", "month", "day", "hour")


def landing_schema(stream: str) -> T.StructType:
    """File columns plus the partition columns, so that nothing is inferred."""
    return T.StructType(raw_schema(stream).fields + [T.StructField(c, T.IntegerType(), True) for c in LAYOUT])


def _utc(value: datetime | str) -> datetime:
    at = datetime.fromisoformat(value) if isinstance(value, str) else value
    return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)


def epoch_ms(value: datetime | str) -> int:
    return (_utc(value) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(milliseconds=1)


def _either(n: int) -> str:
    """Glob of a number that is padded with a zero or not."""
    return f"{{{n},{n:02d}}}" if n < 10 else str(n)


def _cover(first: date, last: date) -> list[str]:
    """Globs of the folders from one day to another: whole years and months as one folder each."""
    out, day = [], first
    while day <= last:
        year_end, month_end = date(day.year, 12, 31), date(day.year, day.month, monthrange(day.year, day.month)[1])
        if (day.month, day.day) == (1, 1) and year_end <= last:
            out.append(f"year={day.year}")
            day = year_end
        elif day.day == 1 and month_end <= last:
            out.append(f"year={day.year}/month={_either(day.month)}")
            day = month_end
        else:
            out.append(f"year={day.year}/month={_either(day.month)}/day={_either(day.day)}")
        day += timedelta(days=1)
    return out


def _years(spark: SparkSession, base: str) -> list[int]:
    """Years that have a folder; raises where the stream has none of its own."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise FileNotFoundError(f"PATH_NOT_FOUND: {base}")
    names = [f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory()]
    return [int(n.removeprefix("year=")) for n in names if n.startswith("year=") and n.removeprefix("year=").isdigit()]


def untyped_columns(spark: SparkSession, files: list[str], stream: str) -> dict[str, tuple[str, ...]]:
    """Files with columns that have lost their type, and these columns. Footers are read by tasks, in parallel."""
    wanted = {f.name for f in raw_schema(stream)}

    # Defined here, so that it travels to the workers by value and they need not have this package.
    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            for path in batch["path"]:
                plain = unquote(path)
                system, place = fs.FileSystem.from_uri(path) if not plain.startswith("file:") else (fs.LocalFileSystem(), "/" + plain.removeprefix("file:").lstrip("/"))
                with system.open_input_file(place) as file:
                    lost = [f.name for f in pq.read_schema(file) if pa.types.is_null(f.type) and f.name in wanted]
                if lost:
                    yield pd.DataFrame({"path": [path], "columns": [",".join(sorted(lost))]})

    listed = spark.createDataFrame([(f,) for f in files], "path string").repartition(min(len(files), shuffle_partitions(spark)))
    return {r["path"]: tuple(r["columns"].split(",")) for r in listed.mapInPandas(look, "path string, columns string").collect()}


def read_files(spark: SparkSession, paths: list[str], stream: str, base: str) -> DataFrame:
    """Landed files as typed rows, with the folders' columns. A column that is NULL throughout a file may have lost its
    type there; such columns, and only these, are left out of reading the files in question."""
    return _typed(spark, paths, stream, landing_schema(stream), {"basePath": base})


def read_batch(spark: SparkSession, files: list[str], stream: str) -> DataFrame:
    """The files of a micro-batch, read in the same way, without the folders' columns."""
    if not files:
        return spark.createDataFrame([], raw_schema(stream))
    return _typed(spark, [unquote(f) for f in files], stream, raw_schema(stream), {"recursiveFileLookup": "true"})


def _typed(spark: SparkSession, paths: list[str], stream: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    everything = spark.read.schema(schema).options(**options).parquet(*paths)
    files = everything.inputFiles()
    lost = untyped_columns(spark, files, stream) if files else {}
    if not lost:
        return everything
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        groups.setdefault(lost.get(file, ()), []).append(unquote(file))
    return reduce(DataFrame.unionAll, [typed_part(spark, own, schema, columns, options) for columns, own in sorted(groups.items())])


def typed_part(spark: SparkSession, paths: list[str], schema: T.StructType, lost: tuple[str, ...], options: dict[str, str]) -> DataFrame:
    """Files that have all lost the type of the same columns, which are NULL throughout and are not read."""
    kept = T.StructType([f for f in schema if f.name not in lost])
    part = spark.read.schema(kept).options(**options).parquet(*paths)
    return part.select(*[(F.lit(None).cast(f.dataType) if f.name in lost else F.col(f.name)).alias(f.name) for f in schema])


def read_raw(
    spark: SparkSession,
    root: str,
    stream: str,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    horizon: timedelta | None = None,
) -> DataFrame:
    """Landed rows of a stream, optionally with ``start <= event time < end``.

    A row lies under the hour its file was flushed, at its event time or later. So folders before ``start`` are not
    listed. How long a producer may hold rows back is for the caller to say: with a ``horizon`` folders of hours later
    than ``end + horizon`` are left out too; without one they are read, and the files' statistics skip what is out of range.
    """
    base = f"{root.rstrip('/')}/{stream}"
    years = _years(spark, base)
    path = base
    if start is not None and years:
        last = _utc(end) + horizon if end is not None and horizon is not None else datetime(max(years), 12, 31, tzinfo=timezone.utc)
        path = f"{base}/{{{','.join(_cover(_utc(start).date(), last.date()))}}}"
    try:
        df = read_files(spark, [path], stream, base) if years or start is None else None
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = None  # the stream has folders, but none in the range
    if df is None:
        return spark.createDataFrame([], landing_schema(stream))
    folder_hour = F.make_timestamp_ntz(*[F.col(c) for c in LAYOUT], F.lit(0), F.lit(0).cast("decimal(16,6)"))
    if start is not None:
        df = df.where(folder_hour >= F.date_trunc("hour", moment(start)).cast("timestamp_ntz"))
        df = df.where(F.col("timestamp") >= epoch_ms(start))
    if end is not None:
        if horizon is not None:
            df = df.where(folder_hour <= F.date_trunc("hour", moment(end) + F.lit(horizon)).cast("timestamp_ntz"))
        df = df.where(F.col("timestamp") < epoch_ms(end))
    return df


def conform(df: DataFrame, stream: str) -> DataFrame:
    """Rows in the curated table's columns, order and types; a missing column becomes NULL."""
    columns = []
    for field in table_schema(stream):
        if field.name not in df.columns:
            column = F.lit(None)
        elif field.name == "timestamp" and isinstance(df.schema["timestamp"].dataType, T.LongType):
            column = from_epoch_ms("timestamp")
        else:
            column = F.col(field.name)
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)

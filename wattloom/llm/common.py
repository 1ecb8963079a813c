"""What the operators of this subpackage share.

Conventions: an operator reads the columns it names and ignores all others, so extra columns never clash; helper
columns that travel beside a caller's own start with ``__llm_``. Null text counts as empty. White space is ASCII white
space (space, tab to carriage return) and a word is a run of other characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import scratch_dir, settings

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def saved(df: DataFrame, path: str) -> DataFrame:
    """The rows as a Parquet table at ``path``.

    Python steps on the way get a few megabytes of text at a time, which both sides of the pipe hold several times over.
    """
    with settings(df.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH_ROWS)):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: the plan behind them is run once and survives lost executors."""
    return saved(df, scratch_dir(df.sparkSession, label))


def as_bytes(column: Column | str) -> Column:
    return F.encode(F.col(column) if isinstance(column, str) else column, "UTF-8")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts, so that few texts at a time are Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)

"""Registration of queries and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wattloom.session import scratch_dir, use_utc
from wattloom.suite.fixtures import ctes, read_stream


@dataclass(frozen=True)
class Inputs:
    """The session and test tables of one run; calling it reads a stream."""

    spark: SparkSession
    sf_dir: str

    def __call__(self, stream: str) -> DataFrame:
        return read_stream(self.spark, self.sf_dir, stream)

    def scratch(self, label: str) -> str:
        return scratch_dir(self.spark, label)


@dataclass(frozen=True)
class Case:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}


def query(key: str, sql: str | None = None, streams: tuple[str, ...] = ()):
    """Register a function of ``Inputs``; ``sql`` reads the named streams."""

    def register(function: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return function(Inputs(spark, sf_dir))

        if key in CASES:
            raise KeyError(f"query {key} registered twice")
        CASES[key] = Case(run, f"{ctes(*streams)}\n{sql.strip()}" if sql else None)
        return function

    return register


def sum4(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(18,4))) as double)"


def avg4(column: str) -> str:
    return f"{sum4(column)} / count({column})"

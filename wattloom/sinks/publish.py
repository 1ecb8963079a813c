"""Write, audit, publish: readers see a new version only after it has passed its checks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.operators.quality import Check, run_checks
from wattloom.sinks.folders import Folders
from wattloom.sinks.writers import write_clustered


@dataclass(frozen=True)
class Publication:
    published: bool
    path: str
    report: DataFrame


def publish(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    view: str,
    checks: Sequence[Check],
    partition_by: Sequence[str] = (),
    temporary: bool = False,
    keep: int | None = None,
) -> Publication:
    """Stage ``df`` in a folder of its own, run ``checks`` on what was written, then re-point ``view``.

    Re-pointing is one catalog statement, so a reader sees the old or the new version, never a mix.
    A failed ``error`` check leaves the view as it was; the staged files remain for inspection. With ``keep`` only so
    many of the newest versions remain after a new one is published; failed ones count.
    """
    folder = f"{root.rstrip('/')}/{view.split('.')[-1]}"
    path = f"{folder}/version={uuid.uuid4().hex}"
    write_clustered(df, path, partition_by)
    staged = spark.read.parquet(path)
    report = run_checks({c.table: staged for c in checks}, checks)
    outcome = report.collect() if checks else []  # one row per check
    passed = all(r["status"] != "error" for r in outcome)
    if passed and temporary:
        staged.createOrReplaceTempView(view)
    elif passed:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
    if passed and keep is not None:
        folders = Folders(spark, folder)
        others = [f"{folder}/{n}" for n in folders.newest_first(folder) if not path.endswith(n)]
        for old in others[max(0, keep - 1) :]:
            folders.drop(old)
    return Publication(passed, path, report)


def at_least_rows(table: str, rows: int) -> Check:
    """An ``error`` check that a table has a minimum number of rows."""

    def too_few(df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") < rows)

    return Check(f"{table}_at_least_{rows}_rows", table, too_few, severity="error")

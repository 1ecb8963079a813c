"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "wattloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; ``conf`` entries (dots as ``__``) win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Tables hold zone-less UTC timestamps; conversions from epoch values need a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    A machine-local folder is only used where no shared one is named and Spark runs in local mode,
    because executors on other machines could not read it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    name = f"{label}-{uuid.uuid4().hex[:12]}"
    if shared:
        return f"{shared.rstrip('/')}/{name}"
    if spark.conf.get("spark.master", "").startswith("local"):
        return os.path.join(tempfile.mkdtemp(prefix="wattloom-"), name)
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Set session options (dots as ``__``) for the actions inside the block, then restore them."""
    names = {k: k.replace("__", ".") for k in conf}
    before = {k: spark.conf.get(names[k], None) for k in conf}
    try:
        for k, value in conf.items():
            spark.conf.set(names[k], value)
        yield
    finally:
        for k, value in before.items():
            if value is None:
                spark.conf.unset(names[k])
            else:
                spark.conf.set(names[k], value)

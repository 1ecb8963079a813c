"""Curated tables and models as temporary views, for ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession

from wattloom.contracts import STREAMS
from wattloom.plans.models import MODELS, Model, Source, model_ref
from wattloom.sources.landed import read_indexed
from wattloom.sources.raw import read_raw


def register_views(
    spark: SparkSession, source: Source, streams: Iterable[str] = STREAMS, models: Mapping[str, Model] = MODELS
) -> list[str]:
    """Name every stream and every model that can be built from them; nothing is computed yet.

    Views keep the tables' ``timestamp_day`` column: SQL over a time range should name it too, because
    only a predicate on it prunes partitions.
    """
    streams = list(streams)
    for stream in streams:
        source(stream).createOrReplaceTempView(stream)
    names = list(streams)
    for name in models:
        if _roots(name, models) <= set(streams):
            model_ref(name, spark.table, models).createOrReplaceTempView(name)
            names.append(name)
    return names


def register_raw_views(spark: SparkSession, root: str, streams: Iterable[str] = STREAMS, index: str | None = None) -> list[str]:
    """Name the landed files of every stream ``raw_<stream>``, for SQL over what has landed.

    With an ``index`` only the footers of files that landed since the last time are opened.
    """
    names = []
    for stream in streams:
        rows = read_indexed(spark, root, stream, index) if index else read_raw(spark, root, stream)
        rows.createOrReplaceTempView(f"raw_{stream}")
        names.append(f"raw_{stream}")
    return names


def _roots(name: str, models: Mapping[str, Model]) -> set[str]:
    """The curated tables a model rests on."""
    if name not in models:
        return {name}
    return set().union(*[_roots(i, models) for i in models[name].inputs])

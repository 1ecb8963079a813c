"""Models, what they read, and how they are stored."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from wattloom.operators import staging
from wattloom.operators.aggregates import power_daily
from wattloom.sinks.versions import read_model, write_model


@dataclass(frozen=True)
class Model:
    """``build`` takes the inputs in the order named; inputs are models or curated tables."""

    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    materialized: str = "table"
    # How to build it from a curated table without the models between, so that filters on its day prune the table.
    from_curated: tuple[str, Callable[[DataFrame], DataFrame]] | None = None


def _mart(electrical: DataFrame) -> DataFrame:
    return power_daily(staging.stage_electrical(electrical, keep_day=True))


MODELS = {
    m.name: m
    for m in (
        Model("stg_temperature", ("temperature",), staging.stage_temperature, ("day",), ("device_id",)),
        Model("stg_humidity", ("humidity",), staging.stage_humidity, (), ("device_id",)),
        Model("stg_vibration", ("vibration",), staging.stage_vibration, (), ("device_id",)),
        Model("stg_evse_electrical", ("evse_electrical",), staging.stage_electrical, (), ("device_id", "asset_id")),
        Model("stg_evse_state", ("evse_state",), staging.stage_state, (), ("device_id",)),
        Model("stg_evse_session_event", ("evse_session_event",), staging.stage_session_event, (), ("device_id",)),
        Model("mart_evse_power_daily", ("stg_evse_electrical",), power_daily, ("day",), ("device_id", "asset_id"), from_curated=("evse_electrical", _mart)),
    )
}

Source = Callable[[str], DataFrame]


def model_ref(name: str, source: Source, models: Mapping[str, Model] = MODELS) -> DataFrame:
    """A model as a DataFrame, built from its inputs down to the curated tables, nothing stored."""
    if name not in models:
        return source(name)
    model = models[name]
    if model.from_curated and model.inputs == MODELS[name].inputs and model.build is MODELS[name].build:
        table, build = model.from_curated
        return build(source(table))
    return model.build(*[model_ref(i, source, models) for i in model.inputs])


def run_order(select: Iterable[str] | None = None, models: Mapping[str, Model] = MODELS) -> list[str]:
    """Selected models, every one after the models it reads."""
    graph = {m.name: {i for i in m.inputs if i in models} for m in models.values()}
    order = list(TopologicalSorter(graph).static_order())
    if select is None:
        return order
    chosen = set(select)
    if chosen - set(models):
        raise KeyError(f"unknown models {sorted(chosen - set(models))}")
    return [name for name in order if name in chosen]


def materialize(spark: SparkSession, model: Model, df: DataFrame, root: str) -> DataFrame:
    """Store a model's rows and return what readers of the model get."""
    if model.materialized == "view":
        df.createOrReplaceTempView(model.name)
        return spark.table(model.name)
    path = f"{root.rstrip('/')}/{model.name}"
    write_model(df, path, model.partition_by, model.cluster_by)
    return read_model(spark, path)


def run_models(
    spark: SparkSession, source: Source, root: str, select: Iterable[str] | None = None, models: Mapping[str, Model] = MODELS
) -> dict[str, DataFrame]:
    """Build the selected models in order; a model reads the stored form of models built before it.

    Inputs that are not selected are computed from their own inputs.
    """
    built: dict[str, DataFrame] = {}
    for name in run_order(select, models):
        model = models[name]
        inputs = [built[i] if i in built else model_ref(i, source, models) for i in model.inputs]
        built[name] = materialize(spark, model, model.build(*inputs), root)
    return built

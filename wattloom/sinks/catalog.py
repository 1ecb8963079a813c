"""Schema housekeeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from wattloom.contracts import STREAMS
from wattloom.sinks.writers import ensure_tables


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}" + (f" LOCATION '{location}'" if location else ""))


def drop_schema(spark: SparkSession, schema: str) -> None:
    """Drop a schema with all its tables."""
    spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def reset_schema(spark: SparkSession, schema: str, location: str | None = None, streams: Sequence[str] = STREAMS) -> list[str]:
    """Drop everything and create empty curated tables."""
    drop_schema(spark, schema)
    create_schema(spark, schema, location)
    return ensure_tables(spark, schema, streams)


def list_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    # The statement also names the session's temporary views.
    return spark.sql(f"SHOW TABLES IN {schema}").where("NOT isTemporary").select("tableName")


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {table}")

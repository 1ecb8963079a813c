"""Joins against a lookup side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.skew import heavy_keys, same_keys


def lookup_join(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", null_safe: bool = False, task_rows: int | None = None
) -> DataFrame:
    """Join a big table to a lookup that has one row per key.

    Whether the lookup is broadcast is left to the adaptive planner, which knows its size in bytes when it has been
    read, and splits a key with too many rows. With ``null_safe`` rows without a key match the lookup's row without one.

    With ``task_rows``, keys with more rows than that are spread over salts beforehand, numbered in turn by the order in
    which tasks read rows, and their lookup rows repeated once per salt: for sessions without adaptive execution.
    """
    keys = list(keys)
    names = [f"_k_{k}" for k in keys]
    if task_rows is None:
        other = lookup.withColumnsRenamed(dict(zip(keys, names)))
        pairs = list(zip(keys, names))
        on = same_keys(df, other, pairs) if null_safe else [df[a] == other[b] for a, b in pairs]
        return df.join(other, on, how).drop(*names)
    heavy, share = heavy_keys(df, keys, task_rows)
    if heavy is None:
        return lookup_join(df, lookup, keys, how, null_safe)
    salts = heavy.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.ceil(F.col("_rows") / share).cast("int").alias("_salts"))

    def salted(side: DataFrame) -> DataFrame:
        found = side.join(F.broadcast(salts), same_keys(side, salts, list(zip(keys, names))), "left")
        return found.withColumn("_salts", F.coalesce("_salts", F.lit(1))).drop(*names)

    # Rows in turn, not by their values, or equal rows would stay together.
    spread = salted(df).withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.col("_salts")).cast("int")).drop("_salts")
    repeated = salted(lookup).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return lookup_join(spread, repeated, [*keys, "_salt"], how, null_safe).drop("_salt")


def enrich_with_devices(df: DataFrame, devices: DataFrame, **limits: int) -> DataFrame:
    """Add the device dimension; columns the stream already has keep the stream's value.

    Rows of unknown devices keep NULLs. The dimension must hold one row per device.
    """
    extra = [c for c in devices.columns if c == "device_id" or c not in df.columns]
    return lookup_join(df, devices.select(*extra), ["device_id"], "left", **limits)

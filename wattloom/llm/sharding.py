"""Shards that all hold the mixture of the sources: proportional stratified interleaving.

The rows of each source are put in a seeded random order. The row at rank r of the n of its source gets the fraction
(r + u) / n, u being a fixed number in [0, 1) drawn from the source's name, so that sources of few rows do not all fall
on one spot. Sorted by this fraction the sources run through the table in step, and cutting it into equal parts gives
every shard the mixture of the whole, each source within about one row of its share. The law is ``rows``: row counts of
shards differ by one at most. Inside a shard the slots follow the same order, so any stretch of it holds the mixture.

Both sorts are range-partitioned (see ``ranking``): a hot source is split over tasks, small ones share one. Texts are
read once, for their size and checksum, and are not shuffled unless the caller carries them.

Defined results: a null text has size 1 and the checksum of no bytes; rows with a null source are a source of their own;
null and repeated doc_ids are ordinary rows, equal rows get slots of their own; an empty table gives no rows; with fewer
rows than shards the last slots of some shards are missing. Columns that are not named are ignored, or carried as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import as_bytes, text_of, written
from wattloom.llm.ranking import PART, PLACE, POSITION, sorted_parts, with_positions

SHARDS, SEED = 8, 12
SHARD, SLOT = "__llm_shard", "__llm_slot"
_STRATUM, _KEY = "__llm_stratum", "__llm_key"


def _eight_digits(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def interleaved(docs: DataFrame, stratum: Column, key: Column, label: str) -> DataFrame:
    """The rows with ``__llm_position`` in the interleaved order of the strata; ``key`` gives the order inside each."""
    named = docs.withColumn(_STRATUM, stratum).withColumn(_KEY, key)
    ranked = sorted_parts(named, [_STRATUM, _KEY], f"{label}-strata")
    # A row for each stratum, and one more wherever a part ends inside a stratum.
    spans = ranked.groupBy(PART, _STRATUM).agg(F.min(PLACE).alias("__llm_first"), F.count(F.lit(1)).alias("__llm_rows"))
    own = Window.partitionBy(_STRATUM)
    before = F.coalesce(F.sum("__llm_rows").over(own.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select(
        PART, _STRATUM, (before - F.col("__llm_first")).alias("__llm_shift"), F.sum("__llm_rows").over(own).alias("__llm_of")
    )
    shift = _eight_digits(F.sha2(F.col(_STRATUM), 256)) / F.lit(2.0**32)
    fraction = (F.col(PLACE) + F.col("__llm_shift") + shift) / F.col("__llm_of")
    spread = ranked.join(spans, [PART, _STRATUM]).withColumn("__llm_fraction", fraction)
    spread = spread.drop(PART, PLACE, _STRATUM, "__llm_shift", "__llm_of")
    return with_positions(sorted_parts(spread, ["__llm_fraction", _KEY], f"{label}-order")).drop("__llm_fraction", _KEY, PART, PLACE)


def with_shards(docs: DataFrame, stratum: Column, key: Column, shards: int = SHARDS, label: str = "shards") -> DataFrame:
    """The rows with ``__llm_shard`` and ``__llm_slot``."""
    if shards < 1:
        raise ValueError("there must be a shard")
    rows = docs.count()
    numbered = interleaved(docs, stratum, key, label)
    cut = numbered.withColumn(SHARD, F.expr(f"cast({POSITION} * {shards} div {max(1, rows)} as int)"))
    # The first position of a shard: its number times rows over shards, rounded up.
    return cut.withColumn(SLOT, F.expr(f"{POSITION} - ({SHARD} * {rows}L + {shards - 1}) div {shards}")).drop(POSITION)


def _stratum(column: str = "source") -> Column:
    return F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(column).cast("string")))


def _shuffled(seed: int, size: Column, crc: Column) -> Column:
    """A seeded digest; size and checksum tell rows without an identifier apart."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), size, crc), 256)


def _size() -> Column:
    return F.octet_length(text_of()).cast("long") + 1


def _crc() -> Column:
    return F.crc32(as_bytes(text_of()))


def shard_report(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, and grown_shard, which this law leaves null."""
    narrow = docs.select("doc_id", _stratum().alias("__llm_source"), _size().alias("size"), _crc().alias("text_crc32"))
    # Written, as a range partitioning reads its input twice.
    narrow = written(narrow, "shards-narrow")
    placed = with_shards(narrow, F.col("__llm_source"), _shuffled(seed, F.col("size"), F.col("text_crc32")), shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col(SHARD).alias("shard"), F.col(SLOT).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, columns: Sequence[str] | None = None) -> None:
    """Whole rows as Parquet in a folder for each shard, in slot order; large shards have several files."""
    kept = docs.select(*(columns or docs.columns))
    placed = with_shards(kept, _stratum(), _shuffled(seed, _size(), _crc()), shards)
    placed.repartitionByRange(SHARD, SLOT).sortWithinPartitions(SHARD, SLOT).write.partitionBy(SHARD).parquet(path)

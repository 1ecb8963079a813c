"""Exact deduplication by a tree-merge of digest runs.

Every row belongs to one of ``fan_in ** rounds`` runs, chosen by a hash of its identifier. A run is a sorted list of
(digest, smallest identifier, row count). In each binomial round, ``fan_in`` neighbouring runs exchange their entries
and are merged; the merged run is again sorted and is spread over all tasks by digest, so no task ever holds a whole
run. After the last round one run is left: the groups. A text that a third of all rows share arrives in a round at most
``fan_in`` times per merged run, whatever its number of rows. The answers go back down the same tree: to the runs
(at most one row per run and digest), then to the rows of a run.

Entries merge only if SHA-256, length and a second, independent hash agree, at every level.

Nulls and edges: null text equals empty text. Null identifiers count as rows, and stay only where a group has no other
identifier. Of rows that repeat both identifier and text, one stays. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.llm.common import SPACE, text_of, written
from wattloom.session import shuffle_partitions

FAN_IN = 8
KEY = ["digest", "check", "length"]


def rounds_for(spark: SparkSession, fan_in: int) -> int:
    """Enough rounds that a run is a smaller share of the rows than a shuffle partition."""
    rounds = 2
    while fan_in**rounds < shuffle_partitions(spark):
        rounds += 1
    return rounds


def with_digest(docs: DataFrame) -> DataFrame:
    """The rows with the SHA-256 of the normalised text, its length and a second hash."""
    normal = F.regexp_replace(text_of(), SPACE, " ")
    return docs.withColumns(
        {
            "__llm_digest": F.unhex(F.sha2(normal, 256)),
            "__llm_check": F.xxhash64(normal),
            "__llm_length": F.length(normal),
        }
    )


def merge_runs(runs: DataFrame) -> DataFrame:
    """One entry per run and digest: the smallest identifier and all rows of the entries merged, in digest order."""
    merged = runs.groupBy("run", *KEY).agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    return merged.sortWithinPartitions("run", *KEY)


def exact_groups(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per identifier and text: doc_id, copies (rows that repeat both), digest, check, length, keep_id, group_size."""
    spark = docs.sparkSession
    rounds = rounds_for(spark, fan_in)
    signed = with_digest(docs.select("doc_id", "text")).select(
        "doc_id", *[F.col(f"__llm_{c}").alias(c) for c in KEY], F.pmod(F.xxhash64("doc_id"), F.lit(fan_in**rounds)).alias("run")
    )
    signed = written(signed.groupBy("run", "doc_id", *KEY).agg(F.count(F.lit(1)).alias("copies")), "digests")
    leaves = merge_runs(signed.select("run", *KEY, F.col("doc_id").alias("keep_id"), F.col("copies").alias("group_size")))
    level = leaves
    for _ in range(rounds):
        level = merge_runs(level.withColumn("run", F.floor(F.col("run") / fan_in)))
    groups = level.select(*KEY, "keep_id", "group_size")
    answers = leaves.select("run", *KEY).join(groups, KEY)
    return signed.join(answers, ["run", *KEY]).drop("run")


def exact_dedup_report(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    groups = exact_groups(docs, fan_in).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return groups.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """The rows that stay, with all their columns."""
    keepers = exact_groups(docs, fan_in).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    keepers = keepers.select(F.col("doc_id").alias("__llm_id"), F.col("digest").alias("__llm_kept"))
    signed = with_digest(docs)
    same = signed["doc_id"].eqNullSafe(keepers["__llm_id"]) & (signed["__llm_digest"] == keepers["__llm_kept"])
    first = Window.partitionBy("doc_id", "__llm_digest").orderBy(text_of())
    kept = signed.join(keepers, same, "left_semi").withColumn("__llm_copy", F.row_number().over(first))
    return kept.where("__llm_copy = 1").select(*[signed[c] for c in docs.columns])

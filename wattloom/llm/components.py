"""Connected components of links between nodes, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import written


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node of its component.

    Large-star and small-star steps in turn, until the links are stars around the smallest nodes. Each step sends
    minima, which combine before the shuffle, and joins them back to the links; a node with very many links is spread
    by the adaptive planner. Links are written after each round, so lineage stays short.
    """
    now = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = written(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), label)
        if same_links(now, after):
            break
        now = after
    roots = after.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(after.select("b", "b").distinct().toDF("node", "root"))


def same_links(one: DataFrame, other: DataFrame) -> bool:
    """Whether two sets of links are equal, by count and two order-free sums of hashes."""

    def digest(df: DataFrame) -> tuple:
        parts = [F.sum(F.xxhash64(F.lit(s), "a", "b").cast("decimal(38,0)")) for s in ("x", "y")]
        return tuple(df.agg(F.count(F.lit(1)), *parts).head())

    return digest(one) == digest(other)

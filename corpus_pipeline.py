"""From raw documents to packed training sequences: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and is written and read again before the next one. All but the last return the
columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattloom.llm.common import table, written
from wattloom.llm.exact_dedup import drop_exact_duplicates
from wattloom.llm.mixing import mixed
from wattloom.llm.packing import packing_report
from wattloom.llm.quality_model import keep_good
from wattloom.llm.queries import DOMAIN_WEIGHTS, labelled_domains
from wattloom.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The domains in their target weights, by repeating documents of scarce domains; none is left out."""
    return mixed(docs, labelled_domains(docs, table(spark, sf_dir, "labels")), DOMAIN_WEIGHTS, least=1.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing_report(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("mixing", mixing),
    ("packing", packing),
]

# The classifiers, fingerprints and token ids have no SQL form; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Deduplication of lines with levelled sorted runs of line hashes.

Documents arrive in batches, largest identifiers first. A batch is summed up to a sorted list of its line hashes, with the
number of documents holding each and the largest of them. It is anti-joined with the runs: only hashes that no run holds
enter, as the batch's own run, with their largest document, which is then the largest of all. So a hash lies in
exactly one run, and runs are compacted without comparing them: when a level has ``FAN_OUT`` runs they become one of the next
level. In the end the batches' counts are added up, and the lines of frequent keys removed, except in the document
that the runs name.

Lines are identified by two independent 64-bit hashes of their key. A text's hashes are sorted with their positions, so that
finding repeats costs n log n of its own lines, and the lines that go are named by position. Counting combines before
the shuffle, and the join of occurrences with the frequent keys is a plain equi-join of small rows that the adaptive planner
can split where one key holds many documents. Text moves once, to meet the positions dropped from it.

Nulls and edges: null text is one empty line. Each row counts as a document, also where rows share an identifier, and loses its own
lines. A null identifier is smaller than any other. Keys under the least length are never dropped. Empty tables
give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import let, text_of, written

BATCHES, FAN_OUT = 4, 2
LEAST_CHARS, LEAST_DOCS = 40, 5
HASHES = ["h1", "h2"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends and with A-Z in lower case (other letters as they are)."""
    bare = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def line_hash(line: Column, least_chars: int) -> Column:
    """Two hashes of the line's key; null for short keys."""

    def hashed(key: Column) -> Column:
        return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))

    return F.when(F.length(line) >= least_chars, let(line_key(line), lambda key: F.when(F.length(key) >= least_chars, hashed(key))))


def occurrences(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per line of the least length: doc_id, version, h1, h2, pos, and whether it is the text's first with this key.

    ``version`` tells apart the texts of rows that share an identifier.
    """
    hashed = F.transform(F.split(text_of(), "\n"), lambda line, i: F.struct(line_hash(line, least_chars).alias("k"), i.alias("pos")))
    long_lines = F.filter(hashed, lambda x: x["k"].isNotNull())

    def marked(lines: Column) -> Column:
        # The array is sorted; there is no element before the first one.
        return F.transform(
            lines, lambda x, j: F.struct(x["k"].alias("k"), x["pos"].alias("pos"), F.coalesce(F.get(lines, j - 1)["k"] != x["k"], F.lit(True)).alias("first"))
        )

    found = docs.select("doc_id", version().alias("version"), F.explode(let(F.sort_array(long_lines), marked)).alias("x"))
    return found.select("doc_id", "version", "x.k.h1", "x.k.h2", "x.pos", "x.first")


def version() -> Column:
    return F.xxhash64(text_of())


class LineRuns:
    """Levels of sorted runs (h1, h2, last_doc) that have no hash in common, and the counts (h1, h2, n_docs) of every batch."""

    def __init__(self, fan_out: int = FAN_OUT):
        self.fan_out = fan_out
        self.levels: list[list[DataFrame]] = []
        self.counts: list[DataFrame] = []

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """Add the occurrences of documents that are all smaller than those added before."""
        summed = batch.groupBy(*HASHES).agg(F.count_if("first").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        own = written(summed.sortWithinPartitions(*HASHES), "line-batch")
        self.counts.append(own.select(*HASHES, "n_docs"))
        new = own.select(*HASHES, "last_doc")
        if self.all():
            known = reduce(DataFrame.unionAll, [run.select(*HASHES) for run in self.all()])
            new = written(new.join(known, HASHES, "left_anti").sortWithinPartitions(*HASHES), "line-run")
        self._put(new, 0)

    def _put(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_out:
            compacted = written(reduce(DataFrame.unionAll, self.levels[level]).sortWithinPartitions(*HASHES), "line-run")
            self.levels[level] = []
            self._put(compacted, level + 1)

    def frequent(self, least_docs: int) -> DataFrame:
        """Hashes that so many documents hold, with the largest of them: h1, h2, last_doc."""
        counted = reduce(DataFrame.unionAll, self.counts).groupBy(*HASHES).agg(F.sum("n_docs").alias("n_docs"))
        often = counted.where(F.col("n_docs") >= least_docs).select(*HASHES)
        return reduce(DataFrame.unionAll, self.all()).join(often, HASHES)


def batches_of(found: DataFrame, batches: int) -> list[DataFrame]:
    """The occurrences by ranges of doc_id, largest first; null identifiers come last."""
    shares = [1 - k / batches for k in range(1, batches)]
    cuts = found.agg(F.percentile_approx("doc_id", shares, 1000)).head()[0] if shares else []
    cuts = sorted(set(cuts or []), reverse=True)
    bounds = [(low, high) for low, high in zip([*cuts, None], [None, *cuts])]
    out = []
    for low, high in bounds:
        part = found if high is None else found.where(F.col("doc_id").isNull() | (F.col("doc_id") < high))
        out.append(part if low is None else part.where(F.col("doc_id") >= low))
    return out


def drop_repeated_lines(
    docs: DataFrame, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS, batches: int = BATCHES
) -> DataFrame:
    """The documents with the text that stays, and __llm_n_lines and __llm_n_dropped."""
    found = written(occurrences(docs, least_chars), "lines")
    runs = LineRuns()
    for batch in batches_of(found, batches):
        runs.add(batch)
    # Written, so that both sides of the join are plain exchanges, which the adaptive planner splits at a hot key.
    frequent = written(runs.frequent(least_docs), "frequent-lines")
    dropped = found.join(frequent, HASHES).where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    # A set, because rows that repeat identifier and text bring the same positions.
    dropped = dropped.groupBy(F.col("doc_id").alias("__llm_id"), F.col("version").alias("__llm_version")).agg(F.collect_set("pos").alias("__llm_drops"))
    same = docs["doc_id"].eqNullSafe(dropped["__llm_id"]) & (version() == dropped["__llm_version"])
    both = docs.join(dropped, same, "left")
    lines = F.split(text_of(), "\n")

    def left_of(all_lines: Column) -> Column:
        stays = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("__llm_drops"))
        return F.transform(stays, lambda i: F.get(all_lines, i))

    cut = F.when(F.col("__llm_drops").isNull(), F.struct(text_of().alias("text"), F.size(lines).alias("n"))).otherwise(
        let(let(lines, left_of), lambda left: F.struct(F.array_join(left, "\n").alias("text"), F.size(left).alias("n")))
    )
    both = both.withColumn("__llm_cut", F.explode(F.array(cut)))
    columns = [F.col("__llm_cut.text").alias("text") if c == "text" else docs[c] for c in docs.columns]
    n_lines = F.size(lines).cast("long")
    return both.select(
        *columns,
        n_lines.alias("__llm_n_lines"),
        (n_lines - F.col("__llm_cut.n")).alias("__llm_n_dropped"),
    )


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped, kept_sha256 (of the text that stays)."""
    kept = drop_repeated_lines(docs.select("doc_id", "text"))
    return kept.select(
        "doc_id",
        F.col("__llm_n_lines").alias("n_lines"),
        F.col("__llm_n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"),
    )

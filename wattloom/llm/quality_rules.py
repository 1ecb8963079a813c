"""Quality rules as a bitmask ledger.

``ledger`` reads every text once and stores its measurements and one bit per rule that it fails. Policies are versioned
sets of rules; applying one, or asking what each rule adds to it, only needs bitwise operations on the stored bits. The
ledger is a table of a few numbers a row: verdicts and ablations read it, never the texts.

Everything is DataFrame functions. Repeated five-word windows are found inside a row: the windows' hashes are sorted
with their positions, equal neighbours are repeats, and the union of their ranges is summed, so a text costs
n log n of its own words and no shuffle.

Nulls and edges: a null or empty text has no words and one line, measures 0 everywhere and fails ``few_words``. Repeated
rows are judged alike. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import SPACE, WORD, let, text_of, written

WINDOW = 5
SYMBOLS = r"[^#*$%&|<>]+"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    fails: Callable[[], Column]


# A rule keeps its bit for ever; new rules take new bits.
RULES = [
    Rule("few_words", 0, lambda: F.col("n_words") < 10),
    Rule("repeated_windows", 1, lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    Rule("many_symbols", 2, lambda: 100 * F.col("n_symbols") > 20 * F.col("n_words")),
    Rule("repeated_lines", 3, lambda: 100 * F.col("n_dup_lines") > 50 * F.col("n_lines")),
    Rule("short_words", 4, lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule("long_words", 5, lambda: F.col("word_chars") > 15 * F.col("n_words")),
]
BITS = {rule.name: 1 << rule.bit for rule in RULES}
BASE = ("few_words", "repeated_windows")
POLICIES = {"v1": BASE, "v2": (*BASE, "many_symbols", "repeated_lines", "short_words", "long_words")}


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(BITS[name] for name in rules)


def repeated_window_words(words: Column) -> Column:
    """Words inside windows of five that occur twice or more in the array, first occurrences included."""
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).alias("h"), i.alias("i")),
    )

    def covered(windows: Column) -> Column:
        def at(j: Column) -> Column:
            return F.get(windows, j)["h"]

        again = F.filter(
            F.sequence(F.lit(0), F.size(windows) - 1),
            lambda j: F.coalesce(at(j) == at(j - 1), F.lit(False)) | F.coalesce(at(j) == at(j + 1), F.lit(False)),
        )
        starts = F.sort_array(F.transform(again, lambda j: F.get(windows, j)["i"]))
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("end"), F.lit(0).alias("words")),
            lambda acc, i: F.struct((i + WINDOW).alias("end"), (acc["words"] + i + WINDOW - F.greatest(acc["end"], i)).alias("words")),
            lambda acc: acc["words"],
        )

    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(let(F.sort_array(hashed), covered))


def measures(text: Column) -> Column:
    """All measurements of a text as a struct."""
    lines = F.split(text, "\n")
    worded = F.filter(lines, lambda line: line.rlike(WORD))
    repeated_lines = let(worded, lambda kept: F.size(kept) - F.size(F.array_distinct(kept)))
    return let(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
            repeated_lines.cast("long").alias("n_dup_lines"),
            repeated_window_words(words).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
        ),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``: one bit per rule, set where the text fails it."""
    measured = docs.select("doc_id", text_of().alias("text")).select("doc_id", measures(F.col("text")).alias("m"))
    # The measurements are an array element, so this projection must not be merged into those that use it many times.
    flat = measured.select("doc_id", F.explode(F.array("m")).alias("m")).select("doc_id", *[F.col(f"m.{m}") for m in MEASURES])
    bits = [F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long") for rule in RULES]
    return flat.withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits))


def failed_under(rules: tuple[str, ...]) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask_of(rules)).cast("long"))


def apply_policy(entries: DataFrame, version: str = "v2") -> DataFrame:
    """The ledger with base_failed and kept under a policy."""
    return entries.withColumns({"base_failed": failed_under(BASE) != 0, "kept": failed_under(POLICIES[version]) == 0})


def ablation(entries: DataFrame, version: str = "v2") -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that only it removes.

    The ledger is first reduced to its distinct bit patterns, at most 2 ** rules rows.
    """
    patterns = entries.groupBy(failed_under(POLICIES[version]).alias("failed")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit")) for r in POLICIES[version]]))
    failing = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    return (
        patterns.withColumn("r", rules)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(failing, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("failed") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        )
    )


def sole_rule(version: str = "v2") -> Column:
    """The rule without which a policy would keep the document; null where there is none, or where it is kept anyway."""
    found = failed_under(POLICIES[version])
    return F.coalesce(*[F.when(found == BITS[name], F.lit(name)) for name in POLICIES[version]])


def quality_report(docs: DataFrame, version: str = "v2") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines, failed, and the ablation.

    ``sole_rule`` names the rule that alone removes the document, ``sole_rule_docs`` how many documents it alone removes.
    Both come from the stored ledger. The counts are one row per rule, which is what is broadcast.
    """
    entries = written(ledger(docs), "ledger")
    judged = apply_policy(entries, version).withColumn("sole_rule", sole_rule(version))
    removed = ablation(entries, version).select(F.col("rule").alias("__llm_rule"), F.col("n_only").alias("sole_rule_docs"))
    judged = judged.join(F.broadcast(removed), F.col("sole_rule") == F.col("__llm_rule"), "left")
    return judged.select("doc_id", *MEASURES[:5], "base_failed", "kept", "n_lines", "failed", "sole_rule", "sole_rule_docs")

"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes ``FEATURES`` numbers, each number a bin. The model is a table of additions per feature and per chosen
pair of features; a score is the logistic function of their sum, taken for a batch at a time by array lookups.

Learning: features are visited in turn, each time a tree of at most four leaves over the bins' gradients is added to
the feature's table, with a small learning rate. Then the pairs whose best four-quadrant split explains most of what is
left are chosen and boosted the same way on coarser bins.

Fitting runs on the driver over the binned features of at most about ``TRAIN_ROWS`` labelled documents (a documented
bound; with more labels, those with the smallest hash of their identifier are taken). Their features are computed by
Spark tasks, as is everything else: every text is read whole and scored in the task that reads it, without a shuffle.

Nulls and edges: null text is empty and is scored like any other. Null labels are ignored; where a document has several,
the larger half decides, 1 at a tie. A null identifier counts as held out. Without labels of both kinds every score is
the (smoothed) share of label 1. Repeated rows get equal scores. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from wattloom.llm.common import text_of

TRAIN_ROWS = 20_000
FOLDS = 5
THRESHOLD = 0.3
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, DAMPING = 60, 40, 0.15, 1.0
FEATURES = ["log_words", "word_bytes", "distinct_words", "distinct_bigrams", "adjacent_repeats", "symbols", "capitals", "digits", "exclamations", "marks", "non_ascii", "line_words", "repeated_lines"]
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_CAPITALS = np.arange(65, 91)
_DIGITS = np.arange(48, 58)
_MARKS = np.frombuffer(b".,;:?", np.uint8)


def features(text: bytes) -> list[float]:
    """The numbers of a text in UTF-8; all 0 for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters = int(counts.sum() - counts[9:14].sum() - counts[32])
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        float(np.log1p(n)),
        letters / n,
        len(set(words)) / n,
        len(set(zip(words, words[1:]))) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        float(counts[_SYMBOLS].sum()) / n,
        float(counts[_CAPITALS].sum()) / letters,
        float(counts[_DIGITS].sum()) / letters,
        float(counts[33]) / n,
        float(counts[_MARKS].sum()) / n,
        float(counts[128:].sum()) / letters,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
    ]


@dataclass
class Gam:
    """Bin edges and lookup tables."""

    bias: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, k], "right")]
        if self.pairs:
            bins = binned(x, self.coarse)
            for (i, j), table in zip(self.pairs, self.pair_tables):
                total += table[bins[:, i], bins[:, j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)], axis=1)


def cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + DAMPING)


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The cut of a row of bins that explains most, and how much more than none; 0 for no cut."""
    if len(g) < 2:
        return 0.0, 0
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    found = gain(a, b) + gain(g.sum() - a, h.sum() - b) - gain(g.sum(), h.sum())
    at = int(np.argmax(found))
    return (float(found[at]), at + 1) if found[at] > 0 else (0.0, 0)


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The additions of a tree of at most four leaves over a row of bins."""
    cuts = [0, len(g)]
    _, first = best_cut(g, h)
    if first:
        cuts.append(first)
        for low, high in ((0, first), (first, len(g))):
            _, at = best_cut(g[low:high], h[low:high])
            if at:
                cuts.append(low + at)
    out = np.zeros(len(g))
    cuts = sorted(set(cuts))
    for low, high in zip(cuts, cuts[1:]):
        out[low:high] = RATE * g[low:high].sum() / (h[low:high].sum() + DAMPING)
    return out


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best split of a grid of bins into four quadrants: how much it explains, and its additions."""
    a, b = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts = []
    for s in (a, b):
        top, left, all_ = s[:, -1:], s[-1:, :], s[-1, -1]
        parts.append((s, top - s, left - s, all_ - top - left + s))
    total = sum(gain(x, y) for x, y in zip(*parts))
    i, j = np.unravel_index(int(np.argmax(total)), total.shape)
    out = np.empty_like(g)
    for k, block in enumerate((np.s_[: i + 1, : j + 1], np.s_[: i + 1, j + 1 :], np.s_[i + 1 :, : j + 1], np.s_[i + 1 :, j + 1 :])):
        out[block] = RATE * parts[0][k][i, j] / (parts[1][k][i, j] + DAMPING)
    return float(total[i, j]), out


def learn(x: np.ndarray, y: np.ndarray) -> Gam:
    """Fit on features (rows, FEATURES) and labels 0 or 1."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Gam(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    model.edges = [cut_points(x[:, k], BINS) for k in range(x.shape[1])]
    model.coarse = [cut_points(x[:, k], PAIR_BINS) for k in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine, coarse, margin = binned(x, model.edges), binned(x, model.coarse), np.full(len(y), model.bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, table in enumerate(model.tables):
            g, h = (np.bincount(fine[:, k], s, len(table)) for s in slopes())
            step = shallow_tree(g, h)
            table += step
            margin += step[fine[:, k]]

    def grid(i: int, j: int) -> list[np.ndarray]:
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        cell = coarse[:, i] * shape[1] + coarse[:, j]
        return [np.bincount(cell, s, shape[0] * shape[1]).reshape(shape) for s in slopes()]

    model.pairs = sorted(combinations(range(x.shape[1]), 2), key=lambda p: -quadrants(*grid(*p))[0])[:PAIRS]
    model.pair_tables = [np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            step = quadrants(*grid(i, j))[1]
            table += step
            margin += step[coarse[:, i], coarse[:, j]]
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_sample(labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` labelled identifiers: doc_id, label."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    share = min(1.0, 1.1 * rows / max(1, known.count()))
    return known.where(place < share * (1 << 32)).orderBy(place, "doc_id").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Gam:
    sample = training_sample(labels, rows).toDF("__llm_id", "__llm_label")

    @F.pandas_udf(ArrayType(DoubleType()))
    def measured(text: pd.Series) -> pd.Series:
        return text.map(features)

    labelled = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("__llm_id"))
    found = labelled.select("__llm_label", measured(F.col("text").cast("binary")).alias("x")).limit(2 * rows).toPandas()
    if not len(found):
        return learn(np.zeros((0, len(FEATURES))), np.zeros(0))
    x, y = np.array(found["x"].tolist()), found["__llm_label"].to_numpy(float)
    order = np.lexsort(x.T)  # the same model whatever order the rows came in
    return learn(x[order], y[order])


def score(model: Gam) -> Column:
    """The score of the column text."""

    @F.pandas_udf(DoubleType())
    def scored(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([features(t) for t in text]).reshape(-1, len(FEATURES))))

    return scored(text_of().cast("binary"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if the score is at least the threshold)."""
    model = fit(docs, labels)
    scored = docs.select("doc_id", held_out().alias("held_out"), score(model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    return docs.where(score(fit(docs, labels)) >= THRESHOLD)

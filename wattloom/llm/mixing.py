"""Mixing to target weights by soft membership.

A classifier learned from a labelled table (identifier and domain) gives each document posteriors over the domains. Each
document gets a rate, the expected number of its copies, such that the expected tokens of each domain, the sum of rate
times tokens times posterior, match the target weights. The rates solve a least-squares problem in the domain totals
with bounds, by projected gradient steps from rate 1:

    rate <- clip(rate - posterior . y),   y = Q^-1 (totals - targets),   Q = sum of tokens * posterior posterior'

over the documents whose rate can still move. This is the gradient step of the squared error measured by Q^-1, with
documents weighted by their tokens. A rate is a function of the posterior and the steps so far, so nothing is updated in
place: each step is one pass over a written table of tokens and posteriors, combined in the tasks to the domain totals
and Q, and the final rates are replayed from the steps, in the pass over the texts that uses them.

The classifier is softmax regression on hashed words, fitted on the driver over at most about ``TRAIN_ROWS`` labelled
documents (a documented bound). Tokens are words.

Nulls and edges: null text is empty, has no tokens and the prior's posterior. Null labels, and domains without a target,
are not learned from. Without any label all domains are alike. Weights are scaled to sum to 1. Rates have no upper bound
unless the caller gives one. A target that the bounds or the documents forbid is met as nearly as the steps get; the fit
then carries what each domain lacks, and a warning names it. Copies are the rate rounded up or down by a hash of the identifier, so rows that
share an identifier are rounded alike. Empty tables give empty results.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from wattloom.llm.common import sliced, text_of, written
from wattloom.llm.passages import word_hashes

TRAIN_ROWS = 5_000
WIDTH = 2048
STEPS, CLOSE = 40, 1e-3
LEAST_RATE, MOST_RATE = 0.0, float("inf")


def word_counts(text: bytes) -> tuple[np.ndarray, int]:
    """Hashed word counts of unit length, and the number of words."""
    hashes = word_hashes(text.lower())
    counts = np.sqrt(np.bincount((hashes & np.uint64(WIDTH - 1)).astype(np.int64), minlength=WIDTH).astype(np.float32))
    return counts / max(1e-9, float(np.linalg.norm(counts))), len(hashes)


@dataclass
class Domains:
    """Softmax regression: names, weights (width, names) and offsets."""

    names: list[str]
    weights: np.ndarray
    offsets: np.ndarray

    @staticmethod
    def learn(names: list[str], x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.3, decay: float = 1e-5) -> Domains:
        k = len(names)
        truth = np.eye(k, dtype=np.float32)[y]
        weights, offsets = np.zeros((WIDTH, k), np.float32), np.log((truth.sum(0) + 1) / (len(y) + k)).astype(np.float32)
        first, second = np.zeros_like(weights), np.zeros_like(weights)
        for n in range(1, rounds + 1 if len(y) else 0):
            z = x @ weights + offsets
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            slope = x.T @ (p - truth) / len(y) + decay * weights
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
            weights -= rate * (first / (1 - 0.9**n)) / (np.sqrt(second / (1 - 0.99**n)) + 1e-8)
        return Domains(names, weights, offsets)

    def posteriors(self, texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors and numbers of words of texts."""
        rows, words = [], []
        for text in texts:
            x, n = word_counts(text)
            rows.append(x @ self.weights + self.offsets)
            words.append(n)
        z = np.array(rows, np.float64).reshape(-1, len(self.names))
        p = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
        return p / p.sum(axis=1, keepdims=True), np.array(words, np.int64)


@dataclass
class Rates:
    """Rates as a function of the posteriors: the steps taken, and the bounds; and how the fit ended.

    ``errors`` are the domains' expected tokens less their targets, as shares of all target tokens.
    """

    steps: list[np.ndarray]
    least: float
    most: float
    errors: np.ndarray = field(default_factory=lambda: np.zeros(0))
    met: bool = True

    def of(self, p: np.ndarray) -> np.ndarray:
        rate = np.clip(np.ones(len(p)), self.least, self.most)
        for step in self.steps:
            rate = np.clip(rate - p @ step, self.least, self.most)
        return rate


def learn_domains(docs: DataFrame, labelled: DataFrame, names: list[str], rows: int = TRAIN_ROWS) -> Domains:
    """Fit the classifier; ``labelled`` has doc_id and domain."""
    known = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(names))
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    share = min(1.0, 1.1 * rows / max(1, known.count()))
    sample = known.where(place < share * (1 << 32)).orderBy(place, "doc_id").limit(rows).toDF("__llm_id", "__llm_domain")
    both = docs.select("doc_id", text_of().cast("binary").alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("__llm_id"))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            x = [word_counts(text)[0].astype("<f2").tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("__llm_domain"), pa.array(x, pa.binary())], names=["doc_id", "domain", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = both.mapInArrow(measure, f"doc_id {kind}, domain string, x binary").limit(2 * rows).toPandas().sort_values(["doc_id", "x"])
    x = np.frombuffer(b"".join(found["x"]), "<f2").reshape(-1, WIDTH).astype(np.float32)
    return Domains.learn(names, x, found["domain"].map(names.index).to_numpy(np.int64))


def memberships(docs: DataFrame, model: Domains) -> DataFrame:
    """doc_id, n_tokens, posteriors (in the order of the model's names)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            p, words = model.posteriors(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), pa.array(words), pa.array(list(p), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "posteriors"])

    source = docs.select("doc_id", text_of().cast("binary").alias("text"))
    return source.mapInArrow(judge, f"doc_id {kind}, n_tokens bigint, posteriors array<double>")


def state(members: DataFrame, rates: Rates, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens by domain under the rates, and Q over the rates inside their bounds."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, q = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            p = batch.column("posteriors").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            tokens = batch.column("n_tokens").to_numpy().astype(float)
            rate = rates.of(p)
            totals += (tokens * rate) @ p
            free = (rate > rates.least) & (rate < rates.most) | (len(rates.steps) == 0)
            q += (p * (tokens * free)[:, None]).T @ p
        values = np.concatenate([totals, q.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["i", "v"])

    rows = members.select("n_tokens", "posteriors").mapInArrow(add, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    values = np.zeros(k + k * k)
    for r in rows:
        values[r.i] = r.v
    return values[:k], values[k:].reshape(k, k)


def fit_rates(members: DataFrame, weights: list[float], least: float = LEAST_RATE, most: float = MOST_RATE) -> Rates:
    """Rates under which the expected tokens have the target weights.

    Their sum stays that of the table, or, if no document may be left out (``least`` of 1 or more), becomes the smallest
    with which no domain has to shrink. The result has the steps up to the smallest error, and that error.
    """
    share = np.array(weights, float) / sum(weights)
    rates, targets = Rates([], least, most), None
    best = Rates([], least, most, np.zeros(len(share)))
    for n in range(STEPS + 1):
        totals, q = state(members, rates, len(share))
        if not totals.any():
            break
        if targets is None:
            targets = share * (float((totals / share).max()) if least >= 1 else float(totals.sum()))
        error = totals - targets
        if n == 0 or np.abs(error).max() < np.abs(best.errors).max() * targets.sum():
            met = bool(np.abs(error).max() <= CLOSE * targets.sum())
            best = Rates(list(rates.steps), least, most, error / targets.sum(), met)
        if best.met or not q.any():
            break
        rates.steps.append(np.linalg.lstsq(q + 1e-9 * np.trace(q) * np.eye(len(share)), error, rcond=None)[0])
    return best


def copies(rate: Column) -> Column:
    """The rate rounded up or down at random, by a hash of the identifier, so that its expectation is the rate."""
    chance = F.pmod(F.xxhash64(F.lit("copies"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    return F.floor(rate + chance).cast("int")


def mixture(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], least: float = LEAST_RATE, most: float = MOST_RATE) -> tuple[DataFrame, Domains, Rates]:
    """Memberships (a written table), the classifier and the rates."""
    names = sorted(name for name, weight in targets.items() if weight > 0)
    model = learn_domains(docs, labelled, names)
    members = written(memberships(docs, model), "memberships")
    rates = fit_rates(members, [targets[n] for n in names], least, most)
    if not rates.met:
        left = ", ".join(f"{name} {error:+.2%}" for name, error in zip(names, rates.errors))
        warnings.warn(f"the mixture misses its targets, in shares of all tokens: {left}", stacklevel=2)
    return members, model, rates


def mixing_report(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], least: float = LEAST_RATE, most: float = MOST_RATE) -> DataFrame:
    """One row per document: doc_id, n_tokens, domain (the likeliest), posteriors, rate, copies."""
    members, model, rates = mixture(docs, labelled, targets, least, most)
    k = len(model.names)

    @F.pandas_udf(DoubleType())
    def rate(posteriors: pd.Series) -> pd.Series:
        return pd.Series(rates.of(np.array(posteriors.tolist()).reshape(-1, k)))

    names = F.array(*[F.lit(n) for n in model.names])
    likeliest = F.element_at(names, F.array_position("posteriors", F.array_max("posteriors")).cast("int"))
    rated = members.select("doc_id", "n_tokens", likeliest.alias("domain"), "posteriors", rate("posteriors").alias("rate"))
    return rated.withColumn("copies", copies(F.col("rate")))


def mixed(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], least: float = LEAST_RATE, most: float = MOST_RATE) -> DataFrame:
    """The documents, with all their columns, as many times each as its copies."""
    _, model, rates = mixture(docs, labelled, targets, least, most)

    @F.pandas_udf(DoubleType())
    def rate(text: pd.Series) -> pd.Series:
        return pd.Series(rates.of(model.posteriors(text)[0]))

    # Marked as not deterministic, or the filter would evaluate it a second time, with a Python worker of its own.
    rate = rate.asNondeterministic()
    again = docs.withColumn("__llm_copies", copies(rate(text_of().cast("binary")))).where("__llm_copies > 0")
    return again.withColumn("__llm_copy", F.explode(F.sequence(F.lit(1), F.col("__llm_copies")))).select(*[again[c] for c in docs.columns])

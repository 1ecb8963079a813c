"""Hard negatives of anchors: threshold joins over an inverted index with suffix-norm bounds.

Anchors meet rows in blocks; a pair of blocks is one group of a cogroup, bounded on both sides whatever the table holds.
In a group the rows are indexed by dimension, dimensions in falling order of energy. With a threshold t and the largest
norm among the anchors, a row is left out of the postings of all dimensions from the point where the norm of its
remaining suffix times that norm is below t: such a row can't reach t through those dimensions alone. Rows are kept in
falling order of that point, so that a posting list is a prefix of the rows. Partial scores are accumulated over the
postings, a few dimensions at a time; after each step the rows whose partial score plus the product of the remaining
norms stays below every open anchor's threshold leave. What is left is verified with exact integer products.

A window is an anchor with bounds of the score, and wants its k best rows inside. Thresholds begin high and are lowered
for the windows that are not full until all are, or the threshold is at the lower bound, so that no partner is lost.
The blocks' best are merged by Spark.

First join: positives, between rows and anchors of one label. Second join: a window of scores for each positive, among
rows of all other labels. Blocks of a label are cut by a hash of the identifier, so a hot label is many groups.

Defined results: rows with a null identifier, label or vector, or with a null or non-finite component, take no part. Of
several rows with one identifier the one with the least label and vector counts. Vectors of different lengths are filled
with zeros. Values beyond 2**14 in size count as that, so that scores are exact up to 512 dimensions. Anchors without positives or
negatives give no rows; an empty table gives none. Columns that are not named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import written

POSITIVES, NEGATIVES, ANCHOR_EVERY = 5, 3, 50
# Of positive scores, in percent: where negatives may lie.
LEAST_PERCENT, MOST_PERCENT = 50, 95
# Rows and anchors of one group, on average, and how many anchors are scored at once.
ROW_BLOCK, ANCHOR_BLOCK, AT_ONCE = 8192, 1024, 128
LARGEST = 1 << 22
# Dimensions that are accumulated between two prunings; where thresholds begin, under the greatest score possible, and
# by what they shrink.
STEP, FIRST, LOWER = 8, 0.9, 0.6
# Against rounding of norms, relative to their product; pairs whose products are verified at once.
_SLACK, _PAIRS = 1e-9, 1 << 16
_FOUND = "anchor_id bigint, window bigint, vec_id bigint, score bigint"


def prepared(rows: DataFrame, dealt: Column | None = None) -> DataFrame:
    """vec_id, label, vec (integers) of the rows that take part, one for each identifier."""
    x = F.col("embedding")
    real = F.forall(x, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    label = F.col("label").cast("long") if dealt is None else dealt
    whole = F.transform(
        x, lambda v: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(256 * v.cast("double")).cast("double"))).cast("int")
    )
    able = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & real)
    taken = able.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), whole.alias("vec"))
    least = taken.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("row"))
    return least.select("vec_id", "row.label", "row.vec")


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = vectors.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int32()))
    offsets = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < offsets[:, None]] = lists.flatten().to_numpy()
    return out


def _widest(*vectors: pa.ChunkedArray) -> int:
    return max((int(n) for v in vectors for n in (v.combine_chunks().value_lengths().to_numpy() if len(v) else ())), default=0)


@dataclass
class Index:
    """Rows by dimension: energetic dimensions first, rows that are indexed farthest first."""

    ids: np.ndarray
    labels: np.ndarray
    exact: np.ndarray
    dims: np.ndarray
    columns: np.ndarray  # dimensions x rows
    suffix: np.ndarray  # norms of what is left from each dimension on, dimensions + 1 x rows

    @staticmethod
    def of(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Index:
        dims = np.argsort(-(vectors.astype(float) ** 2).sum(axis=0), kind="stable")
        columns = np.ascontiguousarray(vectors[:, dims].T.astype(float))
        suffix = np.zeros((len(dims) + 1, len(ids)))
        suffix[:-1] = np.sqrt(np.cumsum((columns**2)[::-1], axis=0)[::-1])
        return Index(ids, labels, vectors, dims, columns, suffix)

    def candidates(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (anchor, row) that may score ``least`` of the anchor or more; none that does is missing."""
        turned = anchors[:, self.dims].astype(float)
        norms = np.zeros((len(anchors), len(self.dims) + 1))
        norms[:, :-1] = np.sqrt(np.cumsum((turned**2)[:, ::-1], axis=1)[:, ::-1])
        least = least - _SLACK * norms[:, 0] * self.suffix[0].max(initial=0) - _SLACK
        # How many dimensions of each row are indexed: up to where no anchor can reach its threshold with the rest.
        reach = np.array([(norms[:, d].max(initial=0) * self.suffix[d]) >= least.min(initial=np.inf) for d in range(len(self.dims) + 1)])
        indexed = reach[:-1].sum(axis=0) if least.min(initial=np.inf) > 0 else np.full(len(self.ids), len(self.dims))
        order = np.argsort(-indexed, kind="stable")
        order = order[: np.searchsorted(-indexed[order], 0)] if least.min(initial=np.inf) > 0 else order
        ends = np.searchsorted(-indexed[order], -np.arange(len(self.dims)), side="left")
        scores = np.zeros((len(anchors), len(order)))
        for d in range(0, len(self.dims), STEP):
            n = int(min(len(order), ends[d]))
            upto = min(d + STEP, len(self.dims))
            if n:
                part = self.columns[d:upto, order[:n]]
                # Rows whose postings end inside this step keep the rest of it in their suffix.
                stops = indexed[order[:n]]
                for row in range(d, upto):
                    part[row - d, stops <= row] = 0
                scores[:, :n] += turned[:, d:upto] @ part
            left = np.minimum(upto, indexed[order])
            alive = (scores + norms[:, left] * self.suffix[left, order] >= least[:, None]).any(axis=0)
            if not alive.all():
                order, scores = order[alive], scores[:, alive]
                ends = np.searchsorted(-indexed[order], -np.arange(len(self.dims)), side="left")
        left = indexed[order]
        anchor, place = np.nonzero(scores + norms[:, left] * self.suffix[left, order] >= least[:, None])
        return anchor, order[place]


def best_in_windows(
    index: Index, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray, k: int, same_label: bool
) -> list[tuple[np.ndarray, ...]]:
    """For each anchor and window (lows, highs: anchors x windows, NaN where there is none) its k best rows of the index.

    Returns arrays (anchor number, window number, row number, score).
    """
    out: list[tuple[np.ndarray, ...]] = []
    longest = np.sqrt((anchors.astype(float) ** 2).sum(axis=1)) * index.suffix[0].max(initial=0)
    there = ~np.isnan(lows)
    # A window begins just below the smaller of its upper bound and the greatest score possible.
    aim = np.where(there, np.minimum(highs, longest[:, None]) * FIRST, np.nan)
    open_ = there & (np.minimum(highs, longest[:, None]) >= lows) if len(index.ids) else np.zeros_like(there)
    while open_.any():
        aim = np.where(aim <= np.maximum(lows, longest[:, None] / 64), lows, aim)
        aim = np.maximum(aim, lows)
        rows = np.flatnonzero(open_.any(axis=1))
        least = np.where(open_[rows], aim[rows], np.inf).min(axis=1)
        least = np.where(np.isneginf(least), -longest[rows], least)
        anchor, row = index.candidates(anchors[rows], least)
        fit = (index.labels[row] == labels[rows][anchor]) == same_label
        fit &= index.ids[row] != ids[rows][anchor]
        anchor, row = rows[anchor[fit]], row[fit]
        score = np.zeros(len(row), np.int64)
        for at in range(0, len(row), _PAIRS):
            pair = slice(at, at + _PAIRS)
            score[pair] = np.einsum("ij,ij->i", anchors[anchor[pair]], index.exact[row[pair]])
        for w in range(lows.shape[1]):
            inside = open_[anchor, w] & (score >= aim[anchor, w]) & (score <= highs[anchor, w])
            a, r, s = anchor[inside], row[inside], score[inside]
            order = np.lexsort((index.ids[r], -s, a))
            a, r, s = a[order], r[order], s[order]
            place = np.arange(len(a)) - np.searchsorted(a, a)
            full = np.bincount(a, minlength=len(ids)) >= k
            done = open_[:, w] & (full | (aim[:, w] <= lows[:, w]))
            chosen = done[a] & (place < k)
            out.append((a[chosen], np.full(chosen.sum(), w), r[chosen], s[chosen]))
            open_[:, w] &= ~done
        aim = aim * LOWER
    return out


def _search(k: int, same_label: bool):
    """For a group of anchors (with windows) and rows: the k best rows of each window."""

    def find(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if anchors.num_rows and rows.num_rows:
            width = _widest(anchors["vec"], rows["vec"])
            index = Index.of(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["vec"], width))
            for start in range(0, anchors.num_rows, AT_ONCE):
                some = anchors.slice(start, AT_ONCE)
                ids, labels, vectors = some["vec_id"].to_numpy(), some["label"].to_numpy(), _matrix(some["vec"], width)
                windows = some["windows"].to_pylist()
                lows = np.full((len(ids), max(map(len, windows), default=0)), np.nan)
                highs = lows.copy()
                names = np.zeros(lows.shape, np.int64)
                for i, own in enumerate(windows):
                    for w, (name, low, high) in enumerate((x["name"], x["low"], x["high"]) for x in own):
                        names[i, w], lows[i, w], highs[i, w] = name, low, high
                for a, w, r, s in best_in_windows(index, ids, labels, vectors, lows, highs, k, same_label):
                    found.append((ids[a], names[a, w], index.ids[r], s))
        columns = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(4)]
        return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["anchor_id", "window", "vec_id", "score"])

    return find


def _piece(count: int) -> Column:
    return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and window, with their place."""
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _windows(name: Column, low: Column, high: Column) -> Column:
    return F.struct(name.cast("long").alias("name"), low.cast("double").alias("low"), high.cast("double").alias("high"))


def best_of_label(rows: DataFrame, anchors: DataFrame, k: int = POSITIVES) -> DataFrame:
    """anchor_id, vec_id, score, place: the k best other rows of each anchor's label."""
    # Pieces of a label by its size; small labels are one piece, and there are as many counts as labels.
    pieces = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / ROW_BLOCK).cast("int").alias("row_pieces"))
    of_anchors = anchors.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / ANCHOR_BLOCK).cast("int").alias("anchor_pieces"))
    sizes = pieces.join(of_anchors, "label")
    whole = F.array(_windows(F.lit(0), F.lit(float("-inf")), F.lit(float("inf"))))
    hashed = F.xxhash64("vec_id")
    left = anchors.join(sizes, "label").select(
        "vec_id", "label", "vec", whole.alias("windows"), F.pmod(hashed, "anchor_pieces").alias("ab"),
        F.explode(F.sequence(F.lit(0), F.col("row_pieces") - 1)).alias("rb"),
    )
    right = rows.join(sizes, "label").select(
        "vec_id", "label", "vec", F.pmod(hashed, "row_pieces").alias("rb"), F.explode(F.sequence(F.lit(0), F.col("anchor_pieces") - 1)).alias("ab")
    )
    keys = ["label", "ab", "rb"]
    found = left.withColumn("ab", F.col("ab").cast("int")).groupBy(*keys).cogroup(right.withColumn("rb", F.col("rb").cast("int")).groupBy(*keys))
    return _best(found.applyInArrow(_search(k, True), _FOUND), k).select("anchor_id", "vec_id", "score", "place")


def best_in_score_windows(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """anchor_id, window, vec_id, score, place: the k best rows of other labels in each of an anchor's ``windows``."""
    row_blocks = max(1, -(-rows.count() // ROW_BLOCK))
    anchor_blocks = max(1, -(-anchors.count() // ANCHOR_BLOCK))
    left = anchors.select("*", _piece(anchor_blocks).alias("ab"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"))
    right = rows.select("*", _piece(row_blocks).alias("rb"), F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("ab"))
    found = left.groupBy("ab", "rb").cogroup(right.groupBy("ab", "rb")).applyInArrow(_search(k, False), _FOUND)
    return _best(found, k)


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST_PERCENT, most: int = MOST_PERCENT
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, of rows and anchors as ``prepared`` gives."""
    rows = written(rows, "negatives-rows")
    anchors = written(rows.join(anchors.select("vec_id"), "vec_id", "left_semi"), "negatives-anchors")
    best = written(best_of_label(rows, anchors, positives), "negatives-positives")
    # Positives of equal score share a window, named by the score; without a positive score only 0 itself fits.
    scores = best.where("score >= 0").groupBy("anchor_id").agg(F.collect_set("score").alias("scores"))
    windows = F.transform("scores", lambda p: _windows(p, -F.floor(-p * least / 100), F.floor(p * most / 100)))
    asked = anchors.join(scores.select(F.col("anchor_id").alias("vec_id"), windows.alias("windows")), "vec_id")
    found = best_in_score_windows(rows, asked, negatives)
    found = found.select(
        "anchor_id", F.col("window").alias("positive_score"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"),
        F.col("place").alias("rank"),
    )
    named = best.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    both = named.join(found, ["anchor_id", "positive_score"])
    return both.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negative_report(rows: DataFrame, every: int = ANCHOR_EVERY) -> DataFrame:
    """Hard negatives of the rows whose identifier is divisible by 50; labels of every seventh are shifted first."""
    label = F.col("label").cast("long")
    taken = prepared(rows, F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(taken, taken.where(F.col("vec_id") % every == 0))

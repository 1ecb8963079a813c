"""Drawing documents by how much they resemble a target: importance weights and a Gumbel-top-k cut.

**Weights.** Words and pairs of neighbouring words are hashed into buckets. Counts of all documents and of all target
texts give each bucket a gain, the logarithm of how much more frequent it is in the target; the gains are one array, and
a document's weight is the mean of its features' gains looked up in it. Counts are summed per task before they are
shuffled, as one row a bucket; what reaches the driver is the array of gains.

**Selection.** A Gumbel variate from a seeded hash of doc_id is added to the weight; the highest scores are drawn without
replacement. Their cutoff is found by weighted median-of-medians: each partition gives the median of its keys between
the present bounds, the driver takes the median of these weighted by the keys each stands for, and one pass counts the
keys on either side, taking the next medians of both. At least a quarter of the keys goes each round. The last few
thousand are sorted to read off the exact cutoff. Winners are sorted by range partitions (see ``ranking``).

Keys are unique (score, doc_id, place in the written table), so the cut is exact also among ties.

Defined results: a null or empty text has no words, no features and weight 0, and is never drawn; rows without doc_id
hash as if it were empty and come last among equal scores; repeated rows are rows of their own; without target texts the
gains still follow the formula; an empty table gives no rows. Texts are read in stretches, so length is not bounded.
Columns that are not named are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import sliced, text_of, written
from wattloom.llm.ranking import POSITION, sorted_parts, with_positions

BUCKETS, SHARE, LEAST_WORDS, SEED = 10_000, 25, 20, 7
# Keys that are sorted at once when the search for the cutoff has narrowed to them.
LAST_KEYS = 4096
_STRETCH = 1 << 20
# Runs of ASCII letters, digits and all beyond ASCII; the same for bytes of UTF-8.
_WORD, _GAP = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_ONE_MORE = np.array([zlib.crc32(bytes([255 - k])) ^ 0xFF000000 for k in range(256)], np.uint32)
Key = tuple[int, int, int]


def _crcs(words: Iterable[bytes], n: int, starts: Iterable[int] | None = None) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words) if starts is None else map(zlib.crc32, words, starts), np.uint32, n)


def _then_space(crcs: np.ndarray) -> np.ndarray:
    """Checksums of the same bytes and a space."""
    open_ended = ~crcs
    return ~(_ONE_MORE[(open_ended ^ 32) & 255] ^ (open_ended >> 8))


def feature_buckets(text: bytes, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """Of each stretch of a text: how many words begin in it, and the buckets of its words and pairs of words."""
    text, at, last = text.lower(), 0, None
    while at < len(text):
        gap = _GAP.search(text, at + _STRETCH)
        end = gap.start() if gap else len(text)
        words, at = _WORD.findall(text, at, end), end
        if words:
            single = _crcs(words, len(words))
            before = single[:-1] if last is None else np.concatenate([[last], single[:-1]]).astype(np.uint32)
            seconds = words[1:] if last is None else words
            pairs = _crcs(seconds, len(seconds), _then_space(before).tolist())
            last = single[-1]
            yield len(words), np.concatenate([single, pairs]) % np.uint32(buckets)


def _texts(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(*more, text_of().cast("binary").alias("__llm_text"))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how many features of all texts fall in each bucket; buckets without any are left out."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in sliced(batches):
            for text in batch.column(0).to_pylist():
                for _, found in feature_buckets(text, buckets):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], ["bucket", "n"])

    counted = _texts(docs).mapInArrow(count, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket."""
    of_docs = bucket_counts(docs, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    of_target = bucket_counts(target, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    both = of_docs.unionByName(of_target).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()
    counts = np.zeros((2, buckets), np.int64)
    for row in both:
        counts[:, row["bucket"]] = row["s"], row["t"]
    s, t = counts + 1.0
    all_s, all_t = counts.sum(axis=1) + float(buckets)
    # The logarithm of the C library, a value at a time: numpy's may differ in the last bit.
    return np.array([math.floor(1000 * math.log(x)) for x in (t * all_s) / (s * all_t)], np.int64)


def with_weights(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                words = features = total = 0
                for n, found in feature_buckets(text, len(gains)):
                    words, features, total = words + n, features + len(found), total + int(gains[found].sum())
                rows.append((words, features, total // features if features else 0))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_features", "weight"])

    return _texts(docs, F.col("doc_id")).mapInArrow(weigh, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def _gumbel(seed: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def _middle(keys: np.ndarray) -> list[int]:
    """The lower median of sorted keys, or zeros."""
    return keys[:, (keys.shape[1] - 1) // 2].tolist() if keys.shape[1] else [0, 0, 0]


def _sides(keys: DataFrame, low: Key | None, high: Key | None, pivot: Key | None) -> list[tuple[int, Key, int, Key]]:
    """Of each partition: number and median of the keys between ``low`` and ``pivot``, and of those between it and ``high``."""
    if low:
        keys = keys.where(F.col("a") >= low[0])
    if high:
        keys = keys.where(F.col("a") <= high[0])
    names = [f"{side}_{c}" for side in ("less", "more") for c in ("n", "a", "b", "c")]

    def below(x: np.ndarray, key: Key) -> np.ndarray:
        a, b, c = x
        return (a < key[0]) | (a == key[0]) & ((b < key[1]) | (b == key[1]) & (c < key[2]))

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) for b in batches if b.num_rows]
        x = np.concatenate(held, axis=1) if held else np.zeros((3, 0), np.int64)
        if low:
            x = x[:, ~below(x, (low[0], low[1], low[2] + 1))]
        if high:
            x = x[:, below(x, high)]
        x = x[:, np.lexsort(x[::-1])]
        less = x[:, below(x, pivot)] if pivot else x
        more = x[:, ~below(x, (pivot[0], pivot[1], pivot[2] + 1))] if pivot else x[:, :0]
        if x.shape[1]:
            values = [less.shape[1], *_middle(less), more.shape[1], *_middle(more)]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in values], names)

    found = keys.select("a", "b", "c").mapInArrow(split, ", ".join(f"{n} bigint" for n in names)).collect()
    return [(r[0], (r[1], r[2], r[3]), r[4], (r[5], r[6], r[7])) for r in found]


def _weighted_median(medians: list[tuple[int, Key]]) -> Key:
    half, so_far = sum(n for n, _ in medians) / 2, 0
    for n, key in sorted(medians, key=lambda x: x[1]):
        so_far += n
        if so_far >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, k: int, last_keys: int = LAST_KEYS) -> Key | None:
    """The k-th least of the unique keys (a, b, c), counted from 1; None where there are fewer."""
    low = high = None
    medians = [(n, key) for n, key, _, _ in _sides(keys, None, None, None) if n]
    if not 1 <= k <= sum(n for n, _ in medians):
        return None
    while sum(n for n, _ in medians) > last_keys:
        pivot = _weighted_median(medians)
        sides = _sides(keys, low, high, pivot)
        less = sum(n for n, *_ in sides)
        if k == less + 1:
            return pivot
        if k <= less:
            high, medians = pivot, [(n, key) for n, key, _, _ in sides if n]
        else:
            low, k, medians = pivot, k - less - 1, [(n, key) for _, _, n, key in sides if n]
    key = F.struct("a", "b", "c")
    for bound, sign in ((low, 1), (high, -1)):
        if bound:
            value = F.struct(*[F.lit(v).cast("long").alias(n) for v, n in zip(bound, "abc")])
            keys = keys.where(key > value if sign > 0 else key < value)
    rest = sorted((r["a"], r["b"], r["c"]) for r in keys.select("a", "b", "c").collect())
    return rest[k - 1]


def importance_report(
    docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score, and rank of the ``share`` percent drawn of all with ``least_words`` words."""
    weighed = with_weights(docs, bucket_gains(docs, target, buckets)).withColumn("score", F.col("weight") + _gumbel(seed))
    last = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    keyed = weighed.select("*", (-F.col("score")).alias("a"), last.alias("b"), F.monotonically_increasing_id().alias("c"))
    scored = written(keyed, "importance-scores")
    able = scored.where(F.col("n_words") >= least_words)
    cut = cutoff(able, able.count() * share // 100)
    shown = ["doc_id", "n_features", "weight", "score"]
    if cut is None:
        return scored.select(*shown, F.lit(None).cast("long").alias("rank"))
    drawn = F.struct("a", "b", "c") <= F.struct(*[F.lit(v).cast("long").alias(n) for v, n in zip(cut, "abc")])
    drawn = (F.col("n_words") >= least_words) & drawn
    ranked = with_positions(sorted_parts(scored.where(drawn), ["a", "b", "c"], "importance-drawn"))
    rest = scored.where(~drawn).select(*shown, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*shown, (F.col(POSITION) + 1).alias("rank")).unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The rows of the documents drawn; identifiers must be unique for it, as rows are found by them."""
    drawn = importance_report(docs, target, **how).where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("__llm_drawn"))
    return docs.join(drawn, F.col("doc_id").eqNullSafe(F.col("__llm_drawn")), "left_semi")

"""Repeated passages by collinear chaining of shared seeds.

1. Seeds: of every ``WINDOW`` consecutive k-mers of words, the one with the smallest hash. Two documents that share a
   run of ``WINDOW + K - 1`` words share a seed in it.
2. Links: a seed that several documents hold links each of them to its first holder (the document with the smallest
   identifier), so m holders give m - 1 links, not m * m. Minima combine before the shuffle; occurrences meet them in
   plain equi-joins that the adaptive planner splits at a hot seed.
3. Chains: the links of a document with one first holder are chained in order of both texts, with a cost for gaps, by a
   Fenwick tree over the places in the first holder.
4. Alignment: a chain is aligned word by word, between its seeds and beyond its ends, in slices of the two texts.
   A seed is only a hint; what is reported has been compared.
5. Passages: a document's aligned spans are merged where they lie within a window of each other, whichever documents they
   come from, since the first holder may change inside a passage. The largest runs of spans that have at least
   ``LEAST_WORDS`` words, ``LEAST_SHARE`` of them in spans, are reported.

Known limit of linking first holders only: where the first holders of a passage's seeds each hold just a part of it, and
only a later document holds all, the reported passage may lack a few words at its ends, and is missed if that makes it too
short.

What reaches a task at once is the links or the spans of one document: no more than its words.

Nulls and edges: null text has no words; texts shorter than a seed take no part, nor do rows without an identifier, which
could not be named in a result. Rows that share an identifier count as one document: copies under one name are not
repeats. Letters A-Z are compared in lower case and all white space is alike. Empty tables give empty results.
Identifiers are integers.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import WORD, text_of, written

K, WINDOW = 8, 16
LEAST_WORDS, LEAST_SHARE = 50, 0.8
GAP, GAP_COST = 32, 0.05
REACH = WINDOW + K
_M1, _M2, _BASE = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse modulo 2 ** 64."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (_BASE, inverse))
    return _powers[0][:n], _powers[1][:n]


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of every word, from running sums over the bytes."""
    data = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], ~_SPACES[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1])])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sliding(x: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``size`` neighbours."""
    width = 1
    while width < size:
        step = min(width, size - width)
        x = pick(x[:-step], x[step:])
        width += step
    return x


def seeds(text: bytes, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of a text's seeds."""
    words = word_hashes(text.lower())
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    grams = np.zeros(n, np.uint64)
    for j in range(k):
        grams = grams * _BASE + words[j : j + n]
    grams = mixed(grams)
    size = min(window, n)
    low = sliding(grams, size, np.minimum)
    # A place is chosen if some window that covers it has its hash as the least, so if the greatest of these is its own.
    pad = np.zeros(size - 1, np.uint64)
    places = np.flatnonzero(sliding(np.concatenate([pad, low, pad]), size, np.maximum) == grams)
    return grams[places], places


def seed_table(docs: DataFrame) -> DataFrame:
    """One row per seed and occurrence: seed, doc_id, pos."""
    source = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), text_of().cast("binary").alias("text"))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                found = [seeds(text) for text in batch.column("text").to_pylist()]
                counts = [len(h) for h, _ in found]
                ids = np.repeat(batch.column("doc_id").to_numpy(), counts)
                hashes = np.concatenate([h for h, _ in found]).view(np.int64)
                places = np.concatenate([p for _, p in found]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(ids), pa.array(places)], names=["seed", "doc_id", "pos"])

    return source.mapInArrow(find, "seed bigint, doc_id bigint, pos int")


def links(found: DataFrame) -> DataFrame:
    """Every occurrence of a shared seed with that of its first holder: doc_id, pos, first_id, first_pos."""
    holders = found.groupBy("seed").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    holders = written(holders.where("first_id < last_id").select("seed", "first_id"), "holders")
    shared = written(found.join(holders, "seed"), "shared-seeds")
    heads = written(shared.where("doc_id = first_id").groupBy("seed").agg(F.min("pos").alias("first_pos")), "heads")
    return shared.where("doc_id <> first_id").join(heads, "seed").select("doc_id", "pos", "first_id", "first_pos")


def chains(anchors: list[tuple[int, int]], k: int = K, gap: int = GAP, cost: float = GAP_COST) -> list[list[tuple[int, int]]]:
    """Collinear chains of anchors (place in the text, place in the other), each anchor in one chain at most.

    The best predecessor of an anchor is the one with the largest score plus cost times its places, among those before it
    in both texts: a prefix maximum, kept in a Fenwick tree over the other text's places.
    """
    anchors = sorted(set(anchors))
    ranks = {q: r + 1 for r, q in enumerate(sorted({q for _, q in anchors}))}
    tree: list[tuple[float, int]] = [(float("-inf"), -1)] * (len(ranks) + 1)
    scores, parents = [0.0] * len(anchors), [-1] * len(anchors)
    at = 0
    while at < len(anchors):
        same = at
        while same < len(anchors) and anchors[same][0] == anchors[at][0]:
            p, q = anchors[same]
            best, r = (float("-inf"), -1), ranks[q] - 1
            while r > 0:
                best = max(best, tree[r])
                r &= r - 1
            joined = best[0] - cost * (p + q)
            scores[same] = k + max(0.0, joined)
            parents[same] = best[1] if joined > 0 else -1
            same += 1
        for j in range(at, same):  # anchors at one place in the text do not follow each other
            p, q = anchors[j]
            value, r = (scores[j] + cost * (p + q), j), ranks[q]
            while r < len(tree):
                tree[r] = max(tree[r], value)
                r += r & -r
        at = same
    used, out = [False] * len(anchors), []
    for end in sorted(range(len(anchors)), key=lambda j: -scores[j]):
        chain, j = [], end
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append(anchors[j])
            j = parents[j]
        chain.reverse()
        while chain:  # cut where the gap is too wide
            n = 1
            while n < len(chain) and max(chain[n][0] - chain[n - 1][0], chain[n][1] - chain[n - 1][1]) <= gap + k:
                n += 1
            out.append(chain[:n])
            chain = chain[n:]
    return out


CHAINS = "array<struct<places: array<int>, first_places: array<int>>>"


def chain_table(linked: DataFrame) -> DataFrame:
    """The chains of each pair of documents: doc_id, first_id, chains (the places of their anchors in both)."""
    by_doc = linked.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "first_id", "first_pos")).alias("links"))
    kind = pa.list_(pa.struct([("places", pa.list_(pa.int32())), ("first_places", pa.list_(pa.int32()))]))

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs: dict[tuple[int, int], list[dict]] = {}
            for doc_id, links in zip(*[c.to_pylist() for c in batch.columns]):
                for (_, first_id), anchors in near_links([(x["pos"], x["first_id"], x["first_pos"]) for x in links]).items():
                    found = [{"places": [p for p, _ in c], "first_places": [q for _, q in c]} for c in chains(anchors)]
                    pairs.setdefault((doc_id, first_id), []).extend(found)
            if pairs:
                ids, firsts = zip(*pairs)
                columns = [pa.array(ids, pa.int64()), pa.array(firsts, pa.int64()), pa.array(list(pairs.values()), kind)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "first_id", "chains"])

    return by_doc.mapInArrow(chain, f"doc_id bigint, first_id bigint, chains {CHAINS}")


def near_links(found: list[tuple[int, int, int]]) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """The links of a document by stretch of its text and first holder.

    A stretch ends where no link follows within reach. A passage of the least length has links no farther than a window
    from its ends, so stretches that are shorter than that, whoever holds them, cannot be reported and are left out.
    """
    out: dict[tuple[int, int], list[tuple[int, int]]] = {}
    found.sort()
    at = 0
    while at < len(found):
        end = at + 1
        while end < len(found) and found[end][0] - found[end - 1][0] <= GAP + K:
            end += 1
        if found[end - 1][0] - found[at][0] + K > LEAST_WORDS - 2 * WINDOW:
            for pos, first_id, first_pos in found[at:end]:
                out.setdefault((at, first_id), []).append((pos, first_pos))
        at = end
    return out


def common_words(a: list[bytes], b: list[bytes]) -> int:
    """The length of the longest common subsequence of two short lists."""
    if a == b:
        return len(a)
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            now = row[j + 1]
            row[j + 1] = before + 1 if x == y else max(now, row[j])
            before = now
    return row[-1]


def reach(a: list[bytes], b: list[bytes], drop: int = 6) -> tuple[int, int]:
    """How far two lists agree from their start, mismatches allowed: length and equal words."""
    score = best = length = equal = same = 0
    for n, (x, y) in enumerate(zip(a, b), 1):
        same += x == y
        score += 1 if x == y else -2
        if score > best:
            best, length, equal = score, n, same
        elif score < best - drop:
            break
    return length, equal


def align(a: list[bytes], b: list[bytes], chain: list[tuple[int, int]], k: int = K) -> tuple[int, int, int, int, int]:
    """Start and end in both lists of the passage around a chain, and its number of equal words."""
    p, q = chain[0]
    left, equal = reach(a[max(0, p - REACH) : p][::-1], b[max(0, q - REACH) : q][::-1])
    start, other_start = p - left, q - left
    for (p, q), (p2, q2) in zip(chain, chain[1:]):
        equal += common_words(a[p:p2], b[q:q2])
    p, q = chain[-1]
    n = sum(1 for _ in zip(a[p : p + k], b[q : q + k]))
    equal += sum(x == y for x, y in zip(a[p : p + k], b[q : q + k]))
    right, more = reach(a[p + n : p + n + REACH], b[q + n : q + n + REACH])
    return start, p + n + right, other_start, q + n + right, equal + more


def spans(chained: DataFrame, docs: DataFrame) -> DataFrame:
    """Aligned spans: doc_id, first_id, start, end. Of each text, a pair gets the words its chains can reach."""

    def side(n: int, of: str, places: str) -> Column:
        low = F.greatest(F.array_min(F.transform(f"chains.{places}", F.array_min)) - REACH, F.lit(0))
        high = F.array_max(F.transform(f"chains.{places}", F.array_max)) + K + REACH
        return F.struct(F.lit(n).alias("side"), F.col(of).alias("of"), low.alias("low"), (high - low).alias("n"), F.when(F.lit(n == 0), F.col("chains")).alias("chains"))

    sides = F.explode(F.array(side(0, "doc_id", "places"), side(1, "first_id", "first_places")))
    wanted = chained.select("doc_id", "first_id", sides.alias("s")).select("doc_id", "first_id", "s.*")
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text"))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.col("low") + 1, F.col("n")), " ")
    sliced = wanted.join(texts, wanted["of"] == texts["id"]).select("doc_id", "first_id", "side", "low", "chains", cut.alias("words"))

    def one(n: int, column: str, alias: str) -> Column:
        return F.min(F.when(F.col("side") == n, F.col(column))).alias(alias)

    both = sliced.groupBy("doc_id", "first_id").agg(
        F.first("chains", ignorenulls=True).alias("chains"), one(0, "low", "low"), one(1, "low", "first_low"), one(0, "words", "a"), one(1, "words", "b")
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, first_id, found, low, first_low, a, b in zip(*[c.to_pylist() for c in batch.columns]):
                a, b = a.encode().lower().split(), b.encode().lower().split()
                for chain in found:
                    anchors = [(p - low, q - first_low) for p, q in zip(chain["places"], chain["first_places"])]
                    start, end, _, _, equal = align(a, b, anchors)
                    if equal >= LEAST_SHARE * (end - start):
                        rows.append((doc_id, first_id, start + low, end + low))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "first_id", "start", "end"])

    return both.mapInArrow(compare, "doc_id bigint, first_id bigint, start bigint, end bigint")


def merged(parts: list[tuple[int, int, int]], least_words: int) -> list[tuple[int, int, int, list[int]]]:
    """Spans of one document that lie within a window of each other as passages: start, end, words, first holders.

    A passage needs the least length, and the least share of it must lie in spans. Of spans that do not meet this together,
    every largest run that does is a passage; two of these may share spans.
    """
    out, at = [], 0
    parts = sorted(parts)
    while at < len(parts):
        # Covered stretches that lie within a window of each other: start, end, the parts up to there.
        runs, end = [[parts[at][0], parts[at][1], at + 1]], at + 1
        while end < len(parts) and parts[end][0] <= runs[-1][1] + WINDOW:
            if parts[end][0] <= runs[-1][1]:
                runs[-1][1:] = max(runs[-1][1], parts[end][1]), end + 1
            else:
                runs.append([parts[end][0], parts[end][1], end + 1])
            end += 1
        # Runs i to j have their share if what is covered before j's end, less the share of j's end, is no less than the
        # same at i's start; best[j] is the largest such value at j or later, so it falls and can be searched.
        sums = list(accumulate((high - low for low, high, _ in runs), initial=0))
        best = [sums[j + 1] - LEAST_SHARE * high for j, (_, high, _) in enumerate(runs)]
        best = list(accumulate(reversed(best), max))  # from the last run to the first
        last = -1
        for i, (low, _, _) in enumerate(runs):
            j = len(runs) - 1 - bisect_left(best, sums[i] - LEAST_SHARE * low - 1e-6)
            high = runs[j][1]
            if j > last and high - low >= least_words:
                first = runs[i - 1][2] if i else at
                out.append((low, high, high - low, sorted({x[2] for x in parts[first : runs[j][2]]})))
            last = max(last, j)
        at = end
    return out


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per passage: doc_id, start_word, end_word, n_words, first_ids (documents that hold it, or parts, earlier)."""
    found = written(seed_table(docs), "seeds")
    chained = written(chain_table(links(found)), "chains")
    by_doc = spans(chained, docs).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "first_id")).alias("spans"))

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, parts in zip(*[c.to_pylist() for c in batch.columns]):
                rows += [(doc_id, *found) for found in merged([(x["start"], x["end"], x["first_id"]) for x in parts], least_words)]
            if rows:
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "start_word", "end_word", "n_words", "first_ids"])

    return by_doc.mapInArrow(merge, "doc_id bigint, start_word bigint, end_word bigint, n_words bigint, first_ids array<bigint>")

"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints: 64 majority bits over the hashes of all three-word shingles. Two fingerprints link at a Hamming distance
of at most ``BUDGET`` bits.

The distinct fingerprints are stored in binary tries and each trie is joined with itself from the root: a pair of nodes
of equal depth carries the number of bits in which their prefixes differ, moves to the pairs of their children, and is
dropped as soon as the budget is exceeded. A pair of a node with itself is dropped once only one fingerprint lies below.
A level of the join is one DataFrame join of node pairs with the children of either node, ``STEP`` bits deep, so the work
of a dense node is spread over its pairs; a fingerprint has at most 1 + 64 + 2016 partners, whatever the data.

A single trie in bit order would carry nearly all pairs through its upper levels before the budget prunes. With 4
quarters of 16 bits, two differing bits leave at least two quarters equal, so six tries are used, each with another two
quarters on top. There the budget is zero: the join starts at depth 32 with the nodes paired with themselves. A link is
reported by the first trie whose upper quarters agree, hence once.

Documents enter as the classes of their fingerprints, and links only ever join different fingerprints, so a group of
copies of any size is one node. Components are computed on the classes.

Nulls and edges: null text is empty, and texts without words have the fingerprint zero, linked like any other. Texts of
fewer than three words have one shingle. A null identifier is never a component's name unless its rows have no other.
Repeated rows are classified alike; of each component one row stays, also where identifiers are null or shared by unlike
texts. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import sliced, text_of, written
from wattloom.llm.components import components

SHINGLE, SEED, BUDGET = 3, 42, 2
QUARTER, STEP = 16, 8
TRIES = list(combinations(range(4), 2))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The majority bits of the shingles' hashes; bytes.lower and bytes.split act on ASCII letters and white space only."""
    words = text.encode().lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
    ends = starts[size - 1 :] + lengths[size - 1 :]
    digest = xxhash.xxh64_intdigest
    n, ones = len(ends), np.zeros(64, np.int64)
    spans = zip(starts.tolist(), ends.tolist())
    for at in range(0, n, 1 << 14):
        count = min(1 << 14, n - at)
        hashes = np.fromiter((digest(joined[a:b], SEED) for _, (a, b) in zip(range(count), spans)), np.uint64, count)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep``, and fp: the fingerprint as a signed 64-bit integer."""
    source = docs.select("doc_id", *keep, text_of().alias("__llm_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__llm_text")

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [fingerprint(text) for text in batch.column("__llm_text").to_pylist()]
            names = [n for n in batch.schema.names if n != "__llm_text"]
            fps = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], fps], names=[*names, "fp"])

    return source.mapInArrow(mark, f"{kinds}, fp bigint")


def quarter(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, QUARTER * (3 - k)).bitwiseAND(F.lit((1 << QUARTER) - 1))


def tries(fps: DataFrame) -> DataFrame:
    """Every fingerprint in each trie: trie, code (its bits in the trie's order)."""
    orders = [[*top, *[k for k in range(4) if k not in top]] for top in TRIES]
    codes = [
        reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(quarter(F.col("fp"), k), QUARTER * (3 - i)) for i, k in enumerate(order)])
        for order in orders
    ]
    rows = F.array(*[F.struct(F.lit(t).alias("trie"), code.alias("code")) for t, code in enumerate(codes)])
    return fps.select(F.explode(rows).alias("r")).select("r.trie", "r.code")


def prefix(code: Column, depth: int) -> Column:
    return F.shiftrightunsigned(code, 64 - depth) if depth < 64 else code


def linked_fingerprints(fps: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Pairs (a, b) of different fingerprints of ``fps`` (distinct, column fp) within the budget, each once."""
    if budget > 2:
        raise ValueError("six tries with two equal quarters find differences of at most two bits")
    top = 2 * QUARTER
    coded = tries(fps).withColumn("top", prefix(F.col("code"), top))
    shared = coded.groupBy("trie", "top").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Only nodes with two fingerprints below take part from here on.
    coded = written(coded.join(shared.select("trie", "top"), ["trie", "top"], "left_semi").select("trie", "code"), "trie")
    pairs = coded.select("trie", prefix(F.col("code"), top).alias("a")).distinct().select("trie", "a", F.col("a").alias("b"), F.lit(0).alias("err"))
    for depth in range(top, 64, STEP):
        below = coded.select("trie", prefix(F.col("code"), depth).alias("node"), prefix(F.col("code"), depth + STEP).alias("child"), "code")
        below = written(below.groupBy("trie", "node", "child").agg(F.count(F.lit(1)).alias("n")), "trie-level")
        left = below.select("trie", F.col("node").alias("a"), F.col("child").alias("ca"), F.col("n").alias("na"))
        right = below.select(F.col("trie").alias("t"), F.col("node").alias("nb"), F.col("child").alias("cb"))
        met = pairs.join(left, ["trie", "a"])
        err = met["err"] + F.bit_count(F.col("ca").bitwiseXOR(F.col("cb")).bitwiseAND(F.lit((1 << STEP) - 1)))
        ordered = (F.col("a") != F.col("b")) | (F.col("ca") < F.col("cb")) | ((F.col("ca") == F.col("cb")) & (F.col("na") > 1))
        met = met.join(right, (met["trie"] == right["t"]) & (met["b"] == right["nb"]) & (err <= budget) & ordered)
        pairs = met.select("trie", F.col("ca").alias("a"), F.col("cb").alias("b"), err.cast("int").alias("err"))
    return decoded(written(pairs.where("a <> b"), "trie-pairs"))


def decoded(pairs: DataFrame) -> DataFrame:
    """Node pairs of full depth as fingerprints, without those that an earlier trie reports."""

    def back(code: Column) -> Column:
        out = None
        for trie, top in enumerate(TRIES):
            order = [*top, *[k for k in range(4) if k not in top]]
            parts = [F.shiftleft(quarter(code, i), QUARTER * (3 - k)) for i, k in enumerate(order)]
            value = reduce(lambda x, y: x.bitwiseOR(y), parts)
            out = F.when(F.col("trie") == trie, value) if out is None else out.when(F.col("trie") == trie, value)
        return out

    out = pairs.select("trie", back(F.col("a")).alias("a"), back(F.col("b")).alias("b"))
    same = [quarter(F.col("a"), k) == quarter(F.col("b"), k) for k in range(4)]
    earlier = reduce(lambda x, y: x | y, [(F.col("trie") > t) & same[i] & same[j] for t, (i, j) in enumerate(TRIES)])
    return out.where(~earlier).select("a", "b")


def near_duplicates(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """doc_id, fp and component_id: the smallest doc_id reachable over links, the row's own included."""
    marked = written(fingerprints(docs.select("doc_id", "text")), "fingerprints")
    return with_components(marked, budget).drop("root")


def with_components(marked: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Rows with a fingerprint fp, their root (a fingerprint that stands for the component) and component_id."""
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    links = linked_fingerprints(classes.select("fp"), budget)
    roots = written(components(links), "roots")
    placed = classes.join(roots, classes["fp"] == roots["node"])
    names = placed.groupBy("root").agg(F.min("least").alias("name"))
    named = placed.join(names, "root").select(F.col("fp").alias("__llm_fp"), "root", "name")
    both = classes.join(named, classes["fp"] == named["__llm_fp"], "left")
    name = F.when(F.col("__llm_fp").isNull(), F.col("least")).otherwise(F.col("name"))
    answers = both.select(F.col("fp").alias("__llm_fp"), F.coalesce("root", "fp").alias("root"), name.alias("component_id"))
    # Written, so that the join is of two plain exchanges, which the adaptive planner splits at a fingerprint of many copies.
    answers = written(answers, "answers")
    return marked.join(answers, marked["fp"] == answers["__llm_fp"]).drop("__llm_fp")


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest identifier, then text digest.

    Components are told apart by their roots, not by identifiers, which may be null or shared by unlike texts. All steps
    are minima or firsts that combine before the shuffle.
    """
    digest = F.unhex(F.sha2(text_of(), 256))
    marked = written(fingerprints(docs.select("doc_id", "text", digest.alias("__llm_digest")), ("__llm_digest",)), "fingerprints")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__llm_digest")).alias("k")
    keepers = with_components(marked).groupBy("root").agg(least)
    keepers = keepers.select(F.col("k.doc_id").alias("__llm_id"), F.col("k.__llm_digest").alias("__llm_kept"))
    rows = docs.withColumn("__llm_digest", digest)
    same = rows["doc_id"].eqNullSafe(keepers["__llm_id"]) & (rows["__llm_digest"] == keepers["__llm_kept"])
    return rows.join(keepers, same, "left_semi").dropDuplicates(["doc_id", "__llm_digest"]).select(*docs.columns)

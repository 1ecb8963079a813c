"""Mixture-controlled packing by deficit round-robin over source queues.

Each source has a queue: its documents' ids one after the other. Queues are served in proportion to their weights, and a
queue that has got less than its share so far (its deficit) is served next: id number k of queue s is due at time
(k + 1) / w_s, and ids are dealt in the order of these times, ties by queue. Windows are cut from this order, so each
holds the target proportions to within one id per queue; what a queue lacks in one window it gets in the next; and a
queue that runs dry leaves its share to the others.

The order need not be played through. The rank of an id is a sum over the queues of how many of their ids are due before
it, so any task can place its documents knowing only the queues' sizes and weights and where its documents lie in their
queue. Deficits thereby carry over from window to window and from partition to partition without a sequential pass.
Positions in queues are running sums: inside a partition by the task that tokenizes it, over partitions from one row per
partition and queue.

Windows hold ``LENGTH`` ids. The ids that are left for the last window are cut into windows whose lengths are powers of
two, which need no padding. Inside a window the ids of a queue are contiguous.

Weights default to the sources' shares of all ids, so that queues end together. Then the ``QUEUES`` largest sources have
queues of their own; if weights are given, the sources that they name. All others share one more queue, which is dealt in the
same way: its ids are the dealt order of groups of sources (by digits of a hash, ``FAN`` at each level), and a group's those
of its sources. The place of an id is the rank in its group, then the rank of that in the next, so it stays a closed form,
and every source has its share of each window to within one id per level. No document is left out.

Nulls and edges: null text is the end id alone; documents without a source have a queue of their own; repeated rows are
packed once each. An empty table gives no piece.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import written
from wattloom.llm.tokens import END_ID, default_path, tokenized, unpacked

LENGTH = 4096
QUEUES = 256
FAN_BITS, LEAF = 8, 128
FAN = 1 << FAN_BITS
WEIGHT_BITS = 16
PIECES = "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, queue int, branch bigint, leaf int, at bigint, ids binary"


class Order:
    """The order in which ids are dealt, and the windows cut from it."""

    def __init__(self, sizes: list[int], weights: list[int], length: int = LENGTH):
        self.sizes, self.weights, self.length = np.array(sizes, np.int64), np.array(weights, np.int64), length
        total = int(self.sizes.sum())
        if total * int(self.weights.max(initial=1)) >= 1 << 62:
            raise ValueError("too many ids for the precision of the weights")
        self.full, rest = divmod(total, length)
        ends, at = [], 0
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                ends.append(at := at + (1 << bit))
        self.ends = np.array(ends, np.int64)

    def rank(self, queue: int, k: np.ndarray) -> np.ndarray:
        """The places of ids ``k`` of a queue among all ids."""
        due, own = k + 1, self.weights[queue]
        out = k.copy()
        for other, (size, weight) in enumerate(zip(self.sizes, self.weights)):
            if other != queue:
                before = due * weight // own if other < queue else (due * weight + own - 1) // own - 1
                out += np.minimum(before, size)
        return out

    def window(self, rank: np.ndarray) -> np.ndarray:
        return np.where(rank < self.full * self.length, rank // self.length, self.full + np.searchsorted(self.ends, rank - self.full * self.length, "right"))

    def window_start(self, window: np.ndarray) -> np.ndarray:
        rest = np.concatenate([[0], self.ends])[np.clip(window - self.full, 0, len(self.ends))]
        return np.minimum(window, self.full) * self.length + rest

    def cuts(self, queue: int, a: np.ndarray, b: np.ndarray, inner: Sequence[tuple[Order, int]] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of documents that take the ids [a, b) of a queue: document, first id, end, window.

        ``inner`` are the orders inside the queue that lead to the documents' own, from the innermost, with the queue in each.
        """

        def rank(k: np.ndarray) -> np.ndarray:
            for order, of in inner:
                k = order.rank(of, k)
            return self.rank(queue, k)

        first, last = self.window(rank(a)), self.window(rank(b - 1))
        counts = last - first + 1
        doc = np.repeat(np.arange(len(a)), counts)
        window = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = a[doc].copy()
        later = window > first[doc]
        goal, low, high = self.window_start(window[later]), a[doc][later], b[doc][later] - 1
        while np.any(low < high):  # the smallest id of the document that is dealt in its window or later
            middle = (low + high) // 2
            enough = rank(middle) >= goal
            high, low = np.where(enough, middle, high), np.where(enough, low, middle + 1)
        start[later] = low
        same = np.concatenate([doc[1:] == doc[:-1], [False]]) if len(doc) else np.zeros(0, bool)
        end = np.where(same, np.concatenate([start[1:], [0]]), b[doc]) if len(doc) else start
        some = end > start
        return doc[some], start[some], end[some], window[some]


def scaled(wanted: Sequence[float]) -> list[int]:
    """Weights as integers of ``WEIGHT_BITS`` bits."""
    top = max(wanted, default=0) or 1
    return [max(1, round(w / top * (1 << WEIGHT_BITS))) for w in wanted]


def with_queues(
    tokens: DataFrame, queues: int, weights: dict[str | None, float] | None
) -> tuple[DataFrame, list[int], list[int], int, dict[int, int]]:
    """Rows with queue, branch, leaf and siblings (where the source is in the shared queue) and at (place of the first id among
    the source's); the queues' sizes and weights; the number of levels of branches, and the branches' sizes."""
    segments = written(tokens.groupBy("source", "part").agg(F.sum("n_tokens").alias("n")), "queue-parts")
    totals = segments.groupBy("source").agg(F.sum("n").alias("n"))
    if weights is None:
        names: list[str | None] = [r.source for r in totals.orderBy(F.desc("n"), "source").limit(queues).collect()]  # at most ``queues`` rows
    else:
        if any(not (math.isfinite(w) and w >= 0) for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        names = [name for name in weights if name != "*"]
    own = tokens.sparkSession.createDataFrame([(name, i) for i, name in enumerate(names)], "own string, queue int")
    rest = len(names)
    # Written, as the sizes that are read here and the places of the rows must agree.
    match = totals["source"].eqNullSafe(own["own"])
    totals = written(totals.join(F.broadcast(own), match, "left").select("source", "n", F.coalesce("queue", F.lit(rest)).alias("queue")), "queue-sizes")
    sizes = [0] * (rest + 1)
    shared = 0
    for r in totals.groupBy("queue").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sources")).collect():  # a row for each queue
        sizes[r.queue] = r.n
        shared = r.sources if r.queue == rest else shared
    levels = 0
    while shared > LEAF << FAN_BITS * levels:
        levels += 1
    branch = F.shiftrightunsigned(F.xxhash64("source"), 64 - FAN_BITS * levels) if levels else F.lit(0).cast("long")
    inside = totals.where(F.col("queue") == rest).withColumn("branch", branch).groupBy("branch")
    inside = inside.agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("s"))
    # A row for every LEAF sources or fewer that share the queue.
    branches = {r.branch: r.n for r in inside.select("branch", F.aggregate("s.n", F.lit(0).cast("long"), lambda a, n: a + n).alias("n")).collect()} if levels else {}
    leaves = inside.select("branch", F.col("s.n").alias("siblings"), F.posexplode("s").alias("leaf", "one"))
    leaves = leaves.select(F.col("one.source").alias("source"), F.lit(rest).alias("queue"), "branch", "leaf", "siblings")
    none = [F.lit(0).cast("long").alias("branch"), F.lit(0).alias("leaf"), F.lit(None).cast("array<bigint>").alias("siblings")]
    alone = totals.where(F.col("queue") < rest).select("source", "queue", *none)
    places = (alone.unionAll(leaves) if shared else alone).withColumnRenamed("source", "of")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    segments = segments.select("part", "source", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = segments.join(places, segments["source"].eqNullSafe(places["of"])).drop("of").withColumnsRenamed({"part": "p", "source": "s"})
    wanted = [float(n) for n in sizes] if weights is None else [*[float(weights[name]) for name in names], float(weights.get("*", 0))]
    both = tokens.join(placed, (tokens["part"] == placed["p"]) & tokens["source"].eqNullSafe(placed["s"]))
    rows = both.select("doc_id", "n_tokens", "dtype", "ids", "queue", "branch", "leaf", "siblings", (F.col("base") + F.col("before")).alias("at"))
    return rows, sizes, scaled(wanted), levels, branches


def branch_orders(branches: dict[int, int], levels: int) -> list[dict[int, tuple[Order, dict[int, int]]]]:
    """For each level from the innermost: the order of the branches below a branch one level up, and their numbers in it."""
    out, sizes = [], branches
    for _ in range(levels):
        below: dict[int, list[int]] = {}
        for b in sorted(sizes):
            below.setdefault(b >> FAN_BITS, []).append(b)
        parts = {up: [sizes[b] for b in bs] for up, bs in below.items()}
        out.append({up: (Order(ns, scaled(ns)), {b: i for i, b in enumerate(below[up])}) for up, ns in parts.items()})
        sizes = {up: sum(ns) for up, ns in parts.items()}
    return out


def way(branch: int, leaf: int, siblings: list[int], above: list[dict[int, tuple[Order, dict[int, int]]]]) -> list[tuple[Order, int]]:
    """The orders inside the shared queue from a source outwards, and its number in each."""
    out = [(Order(siblings, scaled(siblings)), leaf)]
    for level in above:
        order, numbers = level[branch >> FAN_BITS]
        out.append((order, numbers[branch]))
        branch >>= FAN_BITS
    return out


def pack(
    docs: DataFrame,
    path: str | None = None,
    length: int = LENGTH,
    weights: dict[str | None, float] | None = None,
    source: str = "source",
    queues: int = QUEUES,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its ids (unsigned 32-bit).

    ``weights`` names target proportions by source; each named source has a queue of its own, and "*" is for all others
    together, which keep their proportions to each other. A source of weight 0 is served at the least weight there is.
    """
    tokens = written(tokenized(docs, path or default_path(), end_id, source), "queue-tokens")
    placed, sizes, served, levels, branches = with_queues(tokens, queues, weights)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, above = Order(sizes, served, length), branch_orders(branches, levels)
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                queue, branch, leaf, at, n = (batch.column(c).to_numpy() for c in ("queue", "branch", "leaf", "at", "n_tokens"))
                pieces, siblings = [], batch.column("siblings")
                groups: dict[tuple[int, int, int], list[int]] = {}
                for row, key in enumerate(zip(queue.tolist(), branch.tolist(), leaf.tolist())):
                    groups.setdefault(key, []).append(row)
                for (q, b, i), found in groups.items():
                    rows = np.array(found)
                    inner = way(b, i, siblings[found[0]].as_py(), above) if q == len(sizes) - 1 else []
                    doc, start, end, window = order.cuts(q, at[rows], at[rows] + n[rows], inner)
                    pieces.append(np.stack([rows[doc], start, end, window, np.full(len(doc), q)]))
                row, start, end, window, of = np.concatenate(pieces, axis=1)
                by_row = np.argsort(row, kind="stable")
                row, start, end, window, of = row[by_row], start[by_row], end[by_row], window[by_row], of[by_row]
                data, kinds, crcs, kept, last, ids = batch.column("ids"), batch.column("dtype"), [], [], -1, None
                for r, a, b in zip(row.tolist(), (start - at[row]).tolist(), (end - at[row]).tolist()):
                    if r != last:
                        ids, last = unpacked(data[r].as_py(), kinds[r].as_py()).astype("<u4"), r
                    piece = ids[a:b].tobytes()
                    crcs.append(zlib.crc32(piece))
                    kept.append(piece if with_ids else None)
                columns = [batch.column("doc_id").take(pa.array(row)), pa.array(start - at[row]), pa.array(end - start), pa.array(crcs, pa.int64()), pa.array(n[row])]
                columns += [pa.array(window, pa.int64()), pa.array(of, pa.int32()), pa.array(branch[row], pa.int64()), pa.array(leaf[row], pa.int32()), pa.array(start, pa.int64()), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "queue", "branch", "leaf", "at", "ids"])

    pieces = placed.mapInArrow(cut, PIECES.format(id=docs.schema["doc_id"].dataType.simpleString()))
    before = Window.partitionBy("sequence_id").orderBy("queue", "branch", "leaf", "at").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pieces.select(*columns, *(["ids"] if with_ids else []))


def packing_report(docs: DataFrame) -> DataFrame:
    """The pieces without their ids."""
    return pack(docs, with_ids=False)

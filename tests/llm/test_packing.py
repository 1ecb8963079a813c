"""Packing against the order played through id by id, and against the tokenizer."""

import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wattloom.llm import packing
from wattloom.llm.packing import Order, pack, packing_report
from wattloom.llm.tokens import default_path


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 50)), min_size=1, max_size=5), st.sampled_from([4, 8, 16]))
@settings(max_examples=150, deadline=None)
def test_ranks_and_cuts(queues, length):
    sizes, weights = [n for n, _ in queues], [w for _, w in queues]
    dealt = sorted((Fraction(k + 1, w), q, k) for q, (n, w) in enumerate(queues) for k in range(n))
    order, total = Order(sizes, weights, length), sum(sizes)
    windows = []
    for place, (_, q, k) in enumerate(dealt):
        assert order.rank(q, np.array([k]))[0] == place
        windows.append(int(order.window(np.array([place]))[0]))
    filled = Counter(windows)
    assert all(filled[w] == length for w in range(total // length))
    assert all(n & (n - 1) == 0 for n in filled.values()) and sorted(filled) == list(range(len(filled)))
    of = {(q, k): windows[place] for place, (_, q, k) in enumerate(dealt)}
    for q, n in enumerate(sizes):
        if n:
            bounds = np.unique([0, n // 3, n // 2, n])
            doc, start, end, window = order.cuts(q, bounds[:-1], bounds[1:])
            cover = [(k, w) for s, e, w in zip(start, end, window) for k in range(s, e)]
            assert cover == [(k, of[q, k]) for k in range(n)] and all(bounds[d] <= s < e <= bounds[d + 1] for d, s, e in zip(doc, start, end))


def ids_of(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(default_path()).encode(text or "", add_special_tokens=False).ids, 2]


ROWS = [(i, f"document {i} " * (i % 13 + 1), ["a", "a", "b", None][i % 4], i) for i in range(80)]
ROWS += [(500, None, "c", 0), (501, "", "a", 0), (502, "long words " * 900, "d", 0), (502, "long words " * 900, "d", 0), (None, "no name", "b", 0)]


@pytest.mark.parametrize("queues", [256, 2])
@pytest.mark.parametrize("weights", [None, {"a": 3, "b": 1, None: 1, "*": 2}])
def test_pieces(spark, queues, weights):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string, queue int").repartition(4)
    rows = pack(docs, length=64, queues=queues, weights=weights).collect()
    expected = Counter((d, tuple(ids_of(t))) for d, t, _, _ in ROWS)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length > 0 and len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.doc_tokens, np.frombuffer(r.ids, "<u4").tolist()))
    total = sum(len(ids) * n for (_, ids), n in expected.items())
    assert sorted(sequences) == list(range(total // 64 + bin(total % 64).count("1")))
    for k, parts in sequences.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 64 if k < total // 64 else at & (at - 1) == 0
    found = Counter()
    for doc_id, parts in pieces.items():
        copies = sum(n for (d, _), n in expected.items() if d == doc_id)
        ids = next(ids for d, ids in expected if d == doc_id)
        assert sum(len(p) for _, _, p in parts) == copies * len(ids)
        assert all(p == list(ids[s : s + len(p)]) and n == len(ids) for s, n, p in parts)
        found[doc_id, ids] += copies
    assert found == expected


def test_windows_hold_the_target_proportions(spark):
    docs = spark.createDataFrame([(i, "a b c d e", "xyz"[i % 3 % 2 + (i % 6 == 5)], 0) for i in range(3000)], "doc_id long, text string, source string, q int")
    share = {r.source: r["count"] / 3000 for r in docs.groupBy("source").count().collect()}
    packed = packing_report(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("sequence_id", "source").sum("length").collect()
    for r in packed:
        if r.sequence_id < 3000 * 6 // 4096:
            assert abs(r["sum(length)"] - 4096 * share[r.source]) <= 2
    assert packing_report(docs.limit(0)).collect() == []


@pytest.mark.parametrize("leaf", [128, 3])
def test_sources_that_share_a_queue_keep_their_proportions(spark, monkeypatch, leaf):
    """Forty sources of equal size beside two queues, in order of source: each window holds ids of all of them."""
    monkeypatch.setattr(packing, "LEAF", leaf)
    docs = spark.createDataFrame([(i, "a b c d e", f"s{i // 100:02}") for i in range(4000)], "doc_id long, text string, source string")
    n = len(ids_of("a b c d e"))
    rows = pack(docs.repartition(4), length=420, queues=2).join(docs.select("doc_id", "source"), "doc_id").collect()
    held, ids = defaultdict(Counter), Counter()
    for r in rows:
        held[r.sequence_id][r.source] += r.length
        ids[r.doc_id] += r.length
    assert set(ids.values()) == {n} and len(ids) == 4000
    full = [c for w, c in held.items() if w < 4000 * n // 420]
    assert full and all(sum(c.values()) == 420 and len(c) == 40 and max(abs(v - 10.5) for v in c.values()) <= 4 for c in full)


def test_every_named_weight_is_honoured(spark):
    docs = spark.createDataFrame([(i, "a b c d e", f"s{i % 8}") for i in range(1600)], "doc_id long, text string, source string")
    rows = pack(docs, length=128, queues=2, weights={"s7": 4, "s6": 2, "s5": 1, "*": 1}).join(docs.select("doc_id", "source"), "doc_id")
    first = {r.source: r.n for r in rows.where("sequence_id = 0").groupBy("source").agg({"length": "sum"}).toDF("source", "n").collect()}
    assert abs(first["s7"] - 64) <= 2 and abs(first["s6"] - 32) <= 2 and abs(first["s5"] - 16) <= 2
    with pytest.raises(ValueError, match="not negative"):
        pack(docs, weights={"s1": -1.0})

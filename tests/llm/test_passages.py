"""Repeated passages against brute force and planted cases."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wattloom.llm.passages import K, WINDOW, align, chains, common_words, merged, repeated_passages, seeds, word_hashes


def test_word_hashes():
    a, b = word_hashes(b"  one two\n one"), word_hashes("zwei  one\tdrei é".encode())
    assert a[0] == a[2] == b[1] and a[0] != a[1] and len(a) == 3 and len(b) == 4
    assert len(word_hashes(b"")) == 0 and len(word_hashes(b" \n")) == 0


@given(st.lists(st.sampled_from(["a", "b", "c"]), max_size=60))
@settings(max_examples=200, deadline=None)
def test_seeds_are_the_window_minima(words):
    found, places = seeds(" ".join(words).encode())
    every, at = seeds(" ".join(words).encode(), window=1)
    assert at.tolist() == list(range(max(0, len(words) - K + 1)))
    expected = set()
    for s in range(max(1, len(every) - WINDOW + 1) if len(every) else 0):
        part = every[s : s + WINDOW]
        expected |= {s + i for i in range(len(part)) if part[i] == part.min()}
    assert places.tolist() == sorted(expected) and found.tolist() == every[places].tolist()


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), max_size=14))
@settings(max_examples=200, deadline=None)
def test_the_best_chain_has_the_best_score(anchors):
    cost, anchors = 0.05, sorted(set(anchors))
    best = {}
    for p, q in anchors:
        before = [s - cost * (p - a + q - b) for (a, b), s in best.items() if a < p and b < q]
        best[p, q] = K + max([0, *before])
    found = chains(anchors, gap=1000)
    assert sorted(x for c in found for x in c) == anchors
    assert all(a < c and b < d for chain in found for (a, b), (c, d) in zip(chain, chain[1:]))
    if anchors:
        value = max(K * len(c) - cost * sum(c[-1]) + cost * sum(c[0]) for c in found)
        assert abs(value - max(best.values())) < 1e-9


def test_align():
    a = [b"x%d" % i for i in range(80)]
    b = [b"y", b"z", *a[:30], b"new", *a[31:50], *a[52:]]
    assert common_words(a[30:], b[32:]) == 47
    start, end, other, other_end, equal = align(a, b, [(10, 12), (35, 37), (60, 60)])
    assert (start, end, other, other_end, equal) == (0, 80, 2, 80, 77)


def corpus():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    plain = lambda n: [word() for _ in range(n)]
    passage, short, half = plain(60), plain(30), plain(120)
    docs = {i: plain(rng.randrange(5, 300)) for i in range(100, 160)}
    holders = {}
    for i in (101, 105, 110, 120, 159):
        at = rng.randrange(len(docs[i]))
        docs[i][at:at] = passage
        holders[i] = (at, at + 60)
    for i in (130, 131):
        docs[i][0:0] = short
    docs[140] = half[:]
    docs[141] = [*half[:40], "edit", *half[41:75], *half[77:], *plain(40)]
    docs[142] = half[:]
    docs[143], docs[144], docs[145] = half[:30] + plain(80), plain(80), plain(20) + half[:60] + plain(20)
    return docs, holders


def test_planted_passages(spark):
    docs, holders = corpus()
    rows = [(i, ("  ".join(w)).upper() if i == 120 else "\n".join(w)) for i, w in docs.items()]
    rows += [(1, None), (2, ""), (3, "short text"), (None, " ".join(docs[140])), (150, "\n".join(docs[150])), (4, "again " * 200)]
    table = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, seed int").repartition(3)
    found = {r.doc_id: r for r in repeated_passages(table).collect()}
    assert set(found) == {105, 110, 120, 159, 141, 142, 145}
    for i in (105, 110, 120, 159):
        assert abs(found[i].start_word - holders[i][0]) <= 2 and abs(found[i].end_word - holders[i][1]) <= 2 and 101 in found[i].first_ids
    assert (found[142].start_word, found[142].end_word) == (0, 120) and found[142].first_ids[0] == 140
    assert found[141].n_words >= 116 and 75 <= found[145].end_word <= 82
    assert repeated_passages(table.limit(0)).collect() == []


@pytest.mark.parametrize("copies", [40])
def test_no_holder_is_lost(spark, copies):
    """Every document with a run of 60 words that an earlier one has is found, though first holders change inside runs."""
    rng = random.Random(6)
    text = [f"v{rng.randrange(5000)}" for _ in range(400)]
    docs = {}
    for i in range(copies):
        n = rng.choice([45, 49, 60, 70, 200])
        at = rng.randrange(400 - n)
        docs[i] = [f"u{i}x{j}" for j in range(20)] + text[at : at + n] + [f"t{i}x{j}" for j in range(20)]
    found = {r.doc_id for r in repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")).collect()}
    runs = {i: {tuple(w[j : j + 60]) for j in range(len(w) - 59)} for i, w in docs.items()}
    expected = {i for i in docs if any(runs[i] & runs[j] for j in range(i))}
    assert expected <= found and all(any(set(docs[i]) & set(docs[j]) for j in range(i)) for i in found)


@given(st.lists(st.tuples(st.integers(0, 160), st.integers(1, 60), st.integers(1, 3)), max_size=10))
@settings(max_examples=300, deadline=None)
def test_merged_spans_against_brute_force(spans):
    parts = sorted((a, a + n, f) for a, n, f in spans)
    good = set()
    for i in range(len(parts)):
        high = parts[i][1]
        for j in range(i, len(parts)):
            if parts[j][0] > high + WINDOW:
                break
            high = max(high, parts[j][1])
            low, words = parts[i][0], {w for a, b, _ in parts[i : j + 1] for w in range(a, b)}
            if high - low >= 50 and 5 * len(words) >= 4 * (high - low):
                good.add((low, high))
    largest = {x for x in good if not any(y != x and y[0] <= x[0] and x[1] <= y[1] for y in good)}
    found = merged(parts, 50)
    assert sorted((a, b) for a, b, _, _ in found) == sorted(largest)
    assert all(n == b - a and firsts == sorted({f for x, y, f in parts if a <= x and y <= b}) for a, b, n, firsts in found)


def test_a_passage_beside_stock_phrases():
    """A group of spans that lacks its share is not lost: the runs inside that have it are reported."""
    assert merged([(0, 60, 1), (76, 84, 2), (100, 108, 3)], 50) == [(0, 84, 84, [1, 2])]
    assert merged([(0, 60, 1), (76, 78, 2), (94, 96, 3), (112, 180, 1)], 50) == [(0, 60, 60, [1]), (94, 180, 86, [1, 3])]
    assert merged([(0, 40, 1), (56, 64, 2), (80, 88, 3)], 50) == []

"""Hard negatives, shards and importance resampling on hand-built rows, against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from wattloom.llm import hard_negatives, resampling, sharding
from wattloom.llm.ranking import POSITION, sorted_parts, with_positions

# --- hard negatives -------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, score string"


def brute_negatives(rows, every=50, positives=5, negatives=3):
    taken = {}
    for vec_id, vec, label, *_ in rows:
        if vec_id is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        whole = [math.floor(256 * float(np.float32(x))) for x in vec]
        taken[vec_id] = min(taken.get(vec_id, (label, whole)), (label, whole))
    out = []
    for anchor in [v for v in taken if v % every == 0]:
        label, vec = taken[anchor]
        scored = sorted((-sum(a * b for a, b in zip(vec, w)), v, other) for v, (other, w) in taken.items() if v != anchor)
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(n, v) for n, v, other in scored if other != label and -50 * p <= -100 * n <= -95 * p]
            out += [(anchor, positive, k, v, -p, -n) for k, (n, v) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def mined(spark, rows):
    found = hard_negatives.hard_negative_report(spark.createDataFrame(rows, VECTORS))
    return sorted(tuple(r) for r in found.collect())


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(4, 12))
    rows = []
    for v in range(900):
        label = int(rng.integers(0, 4)) if v % 3 else 1  # a label with a third of all rows and more
        vec = centers[label] * 0.2 + rng.normal(size=12) * 0.15
        rows.append((v, [float(np.float32(x)) for x in vec], label, "other"))
    rows += [(1000 + k, rows[50][1], k % 4, None) for k in range(60)]  # copies of one vector: ties in every window
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", 100)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 8)
    assert mined(spark, rows) == brute_negatives(rows)


def test_hard_negatives_odd_rows(spark):
    rng = random.Random(5)
    rows = [(v, [rng.uniform(-1, 1) for _ in range(3 + v % 3)], v % 2, "x") for v in range(0, 160)]
    rows = [(v, [float(np.float32(x)) for x in vec], label, s) for v, vec, label, s in rows]
    odd = [
        (None, [1.0, 1.0], 1, "x"), (200, None, 1, "x"), (201, [1.0, None], 1, "x"), (202, [float("nan")], 0, "x"), (203, [float("inf")], 0, "x"),
        (204, [1.0, 1.0], None, "x"), (250, [], 0, "x"), (300, [0.0, 0.0, 0.0], 1, "x"), (50, rows[50][1], rows[50][2], "again"), (51, [0.5, 0.5], 0, "twice"),
    ]
    assert mined(spark, rows + odd) == brute_negatives(rows + odd)
    assert mined(spark, []) == []


def test_index_leaves_out_what_cannot_reach_the_threshold():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-100, 100, size=(500, 16))
    vectors[:400] //= 20  # short rows: the bound covers all their dimensions
    index = hard_negatives.Index.of(np.arange(500), np.zeros(500, int), vectors)
    anchors = rng.integers(-100, 100, size=(7, 16))
    exact = anchors @ vectors.T
    for t in (20_000.0, 5_000.0, 1.0, -1e9):
        anchor, row = index.candidates(anchors, np.full(7, t))
        found = set(zip(anchor.tolist(), row.tolist()))
        assert {(a, r) for a, r in zip(*np.nonzero(exact >= t))} <= found
        if t == 20_000.0:
            assert not {r for _, r in found} & set(range(400))


# --- positions and shards -------------------------------------------------------------------------------------------


def test_positions_are_gapless_also_among_ties(spark):
    df = spark.createDataFrame([(i % 3, "x") for i in range(2000)], "k int, other string").repartition(8)
    rows = with_positions(sorted_parts(df, ["k"], "test-positions")).select("k", POSITION).collect()
    assert sorted(r[1] for r in rows) == list(range(2000))
    assert [k for k, _ in sorted(rows, key=lambda r: r[1])] == sorted(i % 3 for i in range(2000))


DOCS = "doc_id long, text string, lang string, source string, shard string, size string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, "clash", "clash") for i, t, s in rows], DOCS)


def brute_shards(rows, shards=8, seed=12):
    strata = {}
    for doc_id, text, source in rows:
        data = (text or "").encode()
        size, crc = len(data) + 1, zlib.crc32(data)
        key = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}:{size}:{crc}".encode()).hexdigest()
        strata.setdefault("n" if source is None else f"s{source}", []).append((key, doc_id, size, crc))
    spread = []
    for name, members in strata.items():
        shift = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16) / 2.0**32
        spread += [((r + shift) / len(members), *m) for r, m in enumerate(sorted(members, key=lambda m: m[0]))]
    spread.sort(key=lambda x: x[:2])
    out, n = [], len(rows)
    for position, (_, _, doc_id, size, crc) in enumerate(spread):
        shard = position * shards // n
        out.append((doc_id, size, crc, "rows", shard, position - -(-shard * n // shards), None))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [0, 1, 5, 333])
def test_shards_equal_the_plain_version(spark, n):
    rng = random.Random(n)
    rows = [(i, "wörd " * rng.randrange(9), rng.choice(["a", "a", "a", "b", None, f"rare{i}"])) for i in range(n)]
    if n > 5:
        rows += [(None, None, "a"), (None, None, "a"), (None, "", None), (7, "again", "b"), (7, "again", "b"), (400, "x" * 300_000, "b")]
    found = sharding.shard_report(docs_of(spark, rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_shards(rows)
    counts = Counter(r["shard"] for r in found)
    if rows:
        assert max(counts.values()) - min([counts[s] for s in range(8)]) <= 1
    for shard, count in counts.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(count))


def test_every_shard_holds_the_mixture(spark):
    rows = [(i, "t", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(2100)]
    found = sharding.shard_report(docs_of(spark, rows)).collect()
    source = {i: s for i, _, s in rows}
    whole = Counter(source.values())
    for shard in range(8):
        part = Counter(source[r["doc_id"]] for r in found if r["shard"] == shard)
        assert all(abs(part[s] - n / 8) <= 3 for s, n in whole.items())


def test_written_shards_are_whole_rows_in_slot_order(spark, tmp_path):
    rows = [(i, f"text {i}", f"s{i % 5}") for i in range(100)]
    docs = docs_of(spark, rows)
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.select(docs.columns).collect()) == sorted(docs.collect())
    expected = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_report(docs, 4).collect()}
    assert {r["doc_id"]: (r[sharding.SHARD], r[sharding.SLOT]) for r in back.collect()} == expected


# --- importance resampling ------------------------------------------------------------------------------------------


def brute_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [zlib.crc32(f.encode()) % 10000 for f in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]]


def brute_importance(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(brute_features(text)[1])
    for text in target:
        t.update(brute_features(text)[1])
    all_s, all_t = s.total() + 10000, t.total() + 10000
    gain = [math.floor(1000 * math.log(((t[b] + 1.0) * all_s) / ((s[b] + 1.0) * all_t))) for b in range(10000)]
    scored = []
    for doc_id, text in rows:
        words, found = brute_features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        scored.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    able = sorted((r for r in scored if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    rank = {id(r): k for k, r in enumerate(able[: 25 * len(able) // 100], 1)}
    return sorted(((*r[:4], rank.get(id(r))) for r in scored), key=str)


def sampled(spark, rows, target):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, weight string, rank int")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    return sorted((tuple(r) for r in resampling.importance_report(docs, bench).collect()), key=str)


def test_resampling_equals_the_plain_version(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(300)] + ["É", "ÄB", "x9", "日本語"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(60)))) for i in range(400)]
    rows += [(None, None), (500, ""), (501, "!?"), (502, "Ab" * 9 + ","), (503, " ".join(words) * 50), (7, rows[7][1])]
    target = [" ".join(rng.choices(words[:40], k=30)) for _ in range(10)] + [None, ""]
    assert sampled(spark, rows, target) == brute_importance(rows, target)
    assert sampled(spark, rows[:3], []) == brute_importance(rows[:3], [])
    assert sampled(spark, [], target) == []


def test_features_of_long_texts_do_not_depend_on_stretches(monkeypatch):
    text = (" ".join(f"Wort{k % 97}é" for k in range(5000)) + "," + "x" * 5000).encode()
    whole = np.concatenate([b for _, b in resampling.feature_buckets(text)])
    monkeypatch.setattr(resampling, "_STRETCH", 64)
    stretches = list(resampling.feature_buckets(text))
    assert len(stretches) > 100 and sum(n for n, _ in stretches) == 5001
    assert sorted(np.concatenate([b for _, b in stretches])) == sorted(whole)


@pytest.mark.parametrize("k", [1, 2, 500, 999, 1000])
def test_cutoff_is_the_exact_key(spark, k):
    rng = random.Random(k)
    keys = [(rng.randrange(5), rng.randrange(10), c) for c in range(1000)]  # many ties in the first two
    df = spark.createDataFrame(keys, "a long, b long, c long").repartition(7)
    assert resampling.cutoff(df, k, last_keys=3) == sorted(keys)[k - 1]
    assert resampling.cutoff(df, 0) is None and resampling.cutoff(df, 1001) is None

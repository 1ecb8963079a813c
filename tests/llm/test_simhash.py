"""Fingerprints, links and components against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from wattloom.llm.components import components
from wattloom.llm.simhash import drop_near_duplicates, fingerprint, linked_fingerprints, near_duplicate_report, near_duplicates


def plain_fingerprint(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \t\n", "One", "one TWO", "a b c", "ÄÖ x  y\x0bz \x85 q", "w " * 50, " ".join(map(str, range(40_000)))])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_links_are_complete(spark):
    rng = random.Random(1)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(rng.choice([0, 1, 5, 40])):
            for bit in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                base ^= 1 << bit
            fps.add(base)
    dense = rng.getrandbits(64)
    fps |= {dense ^ m for m in range(300)} | {0, 1, 2**64 - 1, 2**63}
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    found = linked_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    pairs = [tuple(sorted(r)) for r in found]
    expected = {tuple(sorted(p)) for p in combinations(signed, 2) if bin((p[0] ^ p[1]) & (2**64 - 1)).count("1") <= 2}
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: find(x) for x in root}


def rows():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(400)]
    out = [(i + 10, " ".join(base[:k] + ["other"] + base[k + 1 :])) for i, k in enumerate(range(0, 400, 40))]
    out += [(i + 100, " ".join(rng.choice(words) for _ in range(30))) for i in range(20)]
    return out + [(7, None), (8, ""), (9, " \n"), (1, "a b c"), (2, "A  b\tc"), (2, "A  b\tc"), (None, "a b c"), (None, "alone here now")]


def test_report_against_brute_force(spark):
    given = rows()
    fps = [plain_fingerprint(t or "") for _, t in given]
    group = list(range(len(given)))
    for i, j in combinations(range(len(given)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= 2:
            a, b = group[i], group[j]
            group = [min(a, b) if g in (a, b) else g for g in group]
    least = {g: min((given[i][0] for i in range(len(given)) if group[i] == g and given[i][0] is not None), default=None) for g in group}
    expected = sorted(((d, f"{f:016x}", least[g]) for (d, _), f, g in zip(given, fps, group)), key=repr)
    docs = spark.createDataFrame([(*r, 1) for r in given], "doc_id long, text string, fp int")
    assert sorted(map(tuple, near_duplicate_report(docs).collect()), key=repr) == expected
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted({least[g] for g in group}, key=repr)
    assert near_duplicates(docs.limit(0)).collect() == [] and drop_near_duplicates(docs.limit(0)).collect() == []


def test_components_without_or_with_shared_identifiers_keep_their_texts(spark):
    given = [(1, "a b c"), (None, "A b  c"), (None, "alone here now"), (None, "alone here now"), (None, "some other text of its own"), (None, "third one without a name")]
    given += [(5, "first text under five"), (5, "quite another thing under the same number"), (6, "FIRST text under  five")]
    docs = spark.createDataFrame([(*r, 1) for r in given], "doc_id long, text string, root int")
    kept = sorted(((r.doc_id, r.text) for r in drop_near_duplicates(docs.repartition(3)).collect()), key=repr)
    assert kept == sorted({given[i] for i in (0, 2, 4, 5, 6, 7)}, key=repr)

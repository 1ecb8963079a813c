"""The pipeline's stages, each against brute force on what the one before kept."""

import re
from itertools import combinations

import corpus_pipeline
from test_simhash import plain_fingerprint
from wattloom.llm.common import table, written
from wattloom.llm.quality_model import quality_scores


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = written(stage(spark, docs, sf), f"test-{name}")
        seen[name] = before, docs.collect()
        if name != "packing":
            assert docs.columns == columns
    before, after = seen["quality"]
    good = {r.doc_id for r in quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels")).collect() if r.predicted}
    assert {r.doc_id for r in after} == good and 0 < len(after) < len(before)
    before, after = seen["exact"]
    first = {}
    for r in sorted(before, key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(first.values())
    before, after = seen["near"]
    group = {r.doc_id: r.doc_id for r in before}
    marks = {r.doc_id: plain_fingerprint(r.text or "") for r in before}
    for a, b in combinations(sorted(marks), 2):
        if bin(marks[a] ^ marks[b]).count("1") <= 2:
            x, y = sorted((group[a], group[b]))
            group = {d: x if g == y else g for d, g in group.items()}
    assert sorted(r.doc_id for r in after) == sorted(set(group.values()))
    before, after = seen["mixing"]
    assert {r.doc_id: r for r in after} == {r.doc_id: r for r in before} and len(after) >= len(before)
    before, after = seen["packing"]
    lengths = {r.doc_id: r.doc_tokens for r in after}
    assert set(lengths) == {r.doc_id for r in before}
    assert sum(r.length for r in after) == sum(lengths[r.doc_id] for r in before)


def test_run_gives_the_stages_result(spark, sf):
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert len(corpus_pipeline.STAGES) == 5


def test_empty_table(spark, sf):
    docs = table(spark, sf, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), f"empty-{name}")
        assert docs.count() == 0

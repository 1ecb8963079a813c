"""Exact dedup, quality rules and line dedup: edge cases against plain Python, and every oracle at the smallest scale."""

import hashlib
import re
from collections import Counter

import duckdb
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from wattloom.llm import quality_rules
from wattloom.llm.common import written
from wattloom.llm.exact_dedup import drop_exact_duplicates, exact_dedup_report
from wattloom.llm.line_dedup import drop_repeated_lines, line_report
from wattloom.llm.queries import ORACLES, QUERIES

SPACE = r"[\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def con():
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracle(spark, sf, con, key):
    problems, rows = differences(QUERIES[key](spark, sf), con, ORACLES[key])
    assert problems == [] and rows > 0


DOCS = [(5, "a  b", 1), (3, "a\tb", 1), (9, "a b", 2), (1, None, 1), (2, "", 1), (4, " ", 1), (None, "a b", 1), (None, "only", 1), (7, "x", 1), (7, "x", 1), (7, "y", 3), (8, "a\x85b", 1), (6, "long " * 50_000, 1)]


@pytest.mark.parametrize("fan_in", [2, 8])
def test_exact_dedup(spark, fan_in):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, length int").repartition(5)
    groups = {}
    for doc_id, text, _ in DOCS:
        groups.setdefault(re.sub(SPACE, " ", text or ""), []).append(doc_id)
    expected, kept = Counter(), Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        stays = 1
        for i in sorted(ids, key=lambda i: i != keep):
            expected[i, keep, len(ids), i == keep and stays == 1, digest] += 1
            stays -= i == keep
        kept[keep, digest] += 1
    assert Counter(map(tuple, exact_dedup_report(docs, fan_in).collect())) == expected
    left = drop_exact_duplicates(docs, fan_in)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, hashlib.sha256(re.sub(SPACE, " ", r.text or "").encode()).hexdigest()) for r in left.collect()) == kept
    assert exact_dedup_report(docs.limit(0)).collect() == [] and drop_exact_duplicates(docs.limit(0)).collect() == []


def plain_measures(text):
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), text.split("\n")
    fives = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(fives)
    covered = {i + k for i, f in enumerate(fives) if counts[f] > 1 for k in range(5)}
    worded = [line for line in lines if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(worded) - len(set(worded)), len(covered), len(lines)


TEXTS = [None, "", " \n\t", "one two three four", "a b c d e a b c d e", "w " * 5000, "a b c d e f a b c d e x\ny z\ny z\n\ny z", "é # $ ** <p>|x 💡 w w\x85w", "q\x0bw\x0ce\rr t y u i o p a s", "###  $$$ &&& a b c d e f g h i j"]


def test_quality_rules(spark):
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(TEXTS)] + [(None, "x y", True), (3, TEXTS[3], True)], "doc_id long, text string, failed boolean")
    rows = quality_rules.quality_report(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        n, chars, symbols, dup, repeat, lines = plain_measures("x y" if r.doc_id is None else TEXTS[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines) == (n, chars, symbols, dup, repeat, lines)
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert r.kept == (r.failed == 0) and (not r.base_failed or not r.kept)
        assert r.sole_rule == next((name for name, bit in quality_rules.BITS.items() if r.failed == bit), None)
        assert r.sole_rule_docs == (sum(o.failed == r.failed for o in rows) if r.sole_rule else None)
    assert quality_rules.quality_report(docs.limit(0)).collect() == []


def test_policies_and_ablation(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    entries = written(quality_rules.ledger(docs), "ledger")
    # What is stored answers every question; no text is read again.
    for asked in (quality_rules.apply_policy(entries), quality_rules.ablation(entries)):
        assert "regexp" not in asked._jdf.queryExecution().optimizedPlan().toString()
    failed = [r.failed for r in entries.collect()]
    for version, rules in quality_rules.POLICIES.items():
        mask = quality_rules.mask_of(rules)
        assert sum(r.kept for r in quality_rules.apply_policy(entries, version).collect()) == sum(f & mask == 0 for f in failed)
        found = {r.rule: (r.n_failed, r.n_only) for r in quality_rules.ablation(entries, version).collect()}
        assert found == {r: (sum(f & quality_rules.BITS[r] > 0 for f in failed), sum(f & mask == quality_rules.BITS[r] for f in failed)) for r in rules}


LONG = "This Line has more than forty characters in it, É"
LINES = [(i, f"{LONG}\n unique line number {i} of forty or more characters\nshort", 0) for i in range(6)]
LINES += [(10, f"  {LONG.replace('T', 't')}\t\n{LONG}\nshort", 0), (11, None, 0), (12, "", 0), (13, "short\n\nshort\n", 0), (None, LONG, 0), (3, LONG, 0), (14, LONG.replace("É", "é"), 0), (20, "again " * 20_000, 0)]


def key_of(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_line_dedup(spark):
    docs = spark.createDataFrame(LINES, "doc_id long, text string, h1 int").repartition(3)
    holders = {}
    for doc_id, text, _ in LINES:
        for key in {key_of(line) for line in (text or "").split("\n")}:
            holders.setdefault(key, []).append(doc_id)
    gone = {k: max(i for i in ids if i is not None) for k, ids in holders.items() if len(k) >= 40 and len(ids) >= 5}
    expected = []
    for doc_id, text, _ in LINES:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key_of(x) not in gone or gone[key_of(x)] == doc_id]
        expected.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    assert sorted(map(tuple, line_report(docs).collect()), key=repr) == sorted(expected, key=repr)
    assert gone and drop_repeated_lines(docs).columns[:3] == docs.columns
    assert line_report(docs.limit(0)).collect() == []


def test_line_dedup_of_rows_that_share_identifiers_like_its_sql(spark, tmp_path):
    stock = [f"stock line {n} that is long enough to count as one" for n in range(3)]
    # Three identifiers, each twice: six documents hold the first line, four the second, and a row that is there twice.
    rows = [(i // 2, stock[0] + (f"\n{stock[1]}" if i < 4 else "") + f"\nown {i}") for i in range(6)] + [(9, f"{stock[0]}\n{stock[2]}")] * 2
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/d")
    (part,) = (tmp_path / "d").glob("*.parquet")
    part.rename(tmp_path / "documents.parquet")
    got = QUERIES["op4_line_dedup"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet'")
    problems, count = differences(got, con, ORACLES["op4_line_dedup"])
    assert problems == [] and count == len(rows)
    assert sorted((r.doc_id, r.n_dropped) for r in got.collect()) == [(0, 1), (0, 1), (1, 1), (1, 1), (2, 1), (2, 1), (9, 0), (9, 0)]


def test_texts_of_many_stock_lines(spark):
    """All lines of long texts go; with a search through the dropped lines for every line this would take hours."""
    lines = 40_000
    docs = spark.range(5, numPartitions=5).select(
        F.col("id").alias("doc_id"),
        F.array_join(F.transform(F.sequence(F.lit(1), F.lit(lines)), lambda i: F.concat(F.lit("a stock line of forty or more characters "), i % (lines // 2))), "\n").alias("text"),
    )
    found = sorted((r.doc_id, r.n_lines, r.n_dropped) for r in line_report(docs).collect())
    assert found == [(i, lines, lines if i < 4 else 0) for i in range(5)]

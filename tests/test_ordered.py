"""Ordered scans against brute force, with and without cut keys."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattloom.operators import ordered
from wattloom.operators.ordered import number_runs, order_rows, previous_row, running_total

SCHEMA = "device_id string, timestamp timestamp_ntz, tie int, state string, x long"


def make_rows(n=3000, seed=5):
    """One device holds two thirds of the rows, one key is NULL, many rows share a timestamp."""
    rng = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        device = rng.choices(["hot", "a", "b", None], [66, 10, 14, 10])[0]
        at = t0 + timedelta(seconds=rng.randrange(max(1, n // 10)))
        rows.append((device, at, i, rng.choice(["x", "x", "y", None]), rng.choice([None, 1, 2, -3])))
    return rows


def by_key(rows, keyed):
    groups = {}
    for r in rows:
        groups.setdefault(r[0] if keyed else 0, []).append(r)
    return {k: sorted(g, key=lambda r: (r[1], r[2])) for k, g in groups.items()}


@pytest.fixture(scope="module", params=["keyed-cut", "keyed-plain", "global"])
def case(request, spark):
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    keyed = request.param != "global"
    task_rows = 10**9 if request.param == "keyed-plain" else 100
    prepared = order_rows(df, ["device_id"] if keyed else [], ["timestamp", "tie"], task_rows)
    assert prepared.cut == (request.param != "keyed-plain")
    return by_key(rows, keyed), prepared


def test_pieces_split_hot_key_evenly(case):
    groups, prepared = case
    if not prepared.cut:
        pytest.skip("plain")
    sizes = [r["count"] for r in prepared.df.groupBy(*prepared.groups).count().collect()]
    assert max(sizes) < len(max(groups.values(), key=len)) / 2


def test_previous_row(case):
    groups, prepared = case
    got = {
        r["tie"]: (r["prev_tie"], r["prev_x"])
        for r in previous_row(prepared, ["tie", "x"]).result().collect()
    }
    for rows in groups.values():
        for before, row in zip([None, *rows], rows):
            assert got[row[2]] == ((before[2], before[4]) if before else (None, None))
    assert len(got) == sum(map(len, groups.values()))


def test_running_total(case):
    groups, prepared = case
    got = {r["tie"]: r["s"] for r in running_total(prepared, "x", "s").result().collect()}
    for rows in groups.values():
        total = None
        for row in rows:
            if row[4] is not None:
                total = (total or 0) + row[4]
            assert got[row[2]] == total


def test_number_runs(case):
    groups, prepared = case
    got = {r["tie"]: r["run"] for r in number_runs(prepared, ["state"]).result().collect()}
    for rows in groups.values():
        run = 0
        for before, row in zip([None, *rows], rows):
            if before is None or before[3] != row[3]:
                run += 1
            assert got[row[2]] == run


def test_empty_and_single(spark):
    for rows in ([], make_rows(1)):
        df = spark.createDataFrame(rows, SCHEMA)
        for keys in (["device_id"], []):
            got = previous_row(order_rows(df, keys, ["timestamp", "tie"]), ["x"]).result().collect()
            assert [r["prev_x"] for r in got] == [None] * len(rows)


def test_global_scan_keeps_rows_out_of_one_task(spark):
    df = spark.createDataFrame(make_rows(), SCHEMA)
    scanned = previous_row(order_rows(df, [], ["timestamp", "tie"]), ["x"]).result()
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    # The only single-partition exchange is the one-row-per-piece summary under the broadcast.
    row_window = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in row_window and "_piece" in row_window


def test_cut_scan_reads_and_shuffles_the_rows_once(spark, tmp_path):
    spark.createDataFrame(make_rows(), SCHEMA).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    rows = order_rows(table, ["device_id"], ["timestamp", "tie"], 100)
    scanned = number_runs(rows, ["state"]).result()
    scanned.collect()
    plan = scanned._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The summaries of the pieces come from the same shuffle as the rows.
    assert rows.cut and plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") == 1
    # Only edges of pieces are aggregated, and no sort-based aggregate stands under the shuffle of the rows.
    assert "SortAggregate" not in plan[plan.rindex("Exchange hashpartitioning") :]


def test_steps_between_pieces_see_both_rows(spark):
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    prepared = order_rows(df, ["device_id"], ["timestamp", "tie"], 100)
    gap = lambda before, here, first: F.when(first, F.lit(-1)).otherwise(here("tie") - before("tie")).cast("long")
    got = {r["tie"]: (r["sum"], r["was"]) for r in ordered.scan(prepared, {"state": "was"}, {"sum": gap}).result().collect()}
    for group in by_key(rows, True).values():
        for i, row in enumerate(group):
            assert got[row[2]] == (row[2] - group[0][2] - 1, group[i - 1][3] if i else None)


def test_piece_number_matches_search(spark):
    for n in (1, 2, 7, 50):
        cuts = list(range(10, 10 + 3 * n, 3))
        firsts, blocks = ordered._blocks(cuts)
        df = spark.range(0, 20 + 3 * n).select(
            "id", F.lit(firsts).cast("array<bigint>").alias("_firsts"), F.lit(blocks).cast("array<array<bigint>>").alias("_blocks")
        )
        for r in ordered._with_piece(df, F.col("id")).collect():
            assert r["_piece"] == sum(c <= r["id"] for c in cuts)


@pytest.mark.parametrize("distinct", [1, 2, 4])
def test_one_timestamp_may_fill_many_pieces(spark, distinct):
    t0 = datetime(2024, 1, 1)
    rows = [("hot", None if i % distinct == 3 else t0 + timedelta(seconds=i % distinct), i, "x", 1) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for keys in (["device_id"], []):
        prepared = order_rows(df, keys, ["timestamp", "tie"], 100)
        sizes = [r["count"] for r in prepared.df.groupBy("_piece").count().collect()]
        assert len(sizes) > 4 and max(sizes) < 700
        got = {r["tie"]: r["s"] for r in running_total(prepared, "x", "s").result().collect()}
        expected = sorted(rows, key=lambda r: (r[1] is not None, r[1] or t0, r[2]))
        assert all(got[r[2]] == i + 1 for i, r in enumerate(expected))

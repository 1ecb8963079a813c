"""Lookup joins by broadcast, by shuffle, and with salted heavy keys give the same rows."""

import pytest

from wattloom.operators.joins import enrich_with_devices, lookup_join


def sides(spark):
    big = spark.createDataFrame(
        [("hot", i) for i in range(300)] + [(f"k{i % 7}", i) for i in range(70)] + [(None, i) for i in range(100)] + [("unknown", 1)],
        "k string, v int",
    ).repartition(4)
    small = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"K{i}") for i in range(7)] + [("unused", "U")], "k string, name string")
    return big, small


@pytest.mark.parametrize("how", ["left", "inner"])
def test_same_rows_on_every_path(spark, how):
    big, small = sides(spark)
    expected = sorted(map(str, big.join(small, "k", how).collect()))
    paths = {"planner": {}, "salted": {"task_rows": 20}}
    for name, limits in paths.items():
        joined = lookup_join(big, small, ["k"], how, **limits)
        assert sorted(map(str, joined.collect())) == expected, name
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert ("_salt" in plan) == (name == "salted")


def test_salts_spread_the_heavy_key(spark):
    big, small = sides(spark)
    plan = lookup_join(big, small, ["k"], task_rows=20)._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" in plan


def test_null_keys_match_where_asked(spark):
    big, small = sides(spark)
    small = small.unionAll(spark.createDataFrame([(None, "N")], small.schema))
    for limits in ({}, {"task_rows": 20}):
        named = lookup_join(big, small, ["k"], null_safe=True, **limits)
        assert named.where("name = 'N'").count() == 100 and named.count() == big.count()


def test_enrichment_keeps_stream_columns(spark):
    events = spark.createDataFrame([("d1", "s1"), ("d2", "s2")], "device_id string, site_id string")
    devices = spark.createDataFrame([("d1", "other", "Davis")], "device_id string, site_id string, city string")
    got = {r["device_id"]: (r["site_id"], r["city"]) for r in enrich_with_devices(events, devices).collect()}
    assert got == {"d1": ("s1", "Davis"), "d2": ("s2", None)}

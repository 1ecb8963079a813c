"""Physical plans: what reaches the scan, how often data is shuffled, which aggregates are used."""

import pytest

from wattloom.operators import aggregates, episodes, latest, staging
from wattloom.operators import quality as dq
from wattloom.operators.joins import enrich_with_devices
from wattloom.session import scratch_dir, settings
from wattloom.sinks import writers
from wattloom.suite.fixtures import AS_OF, read_stream


@pytest.fixture(scope="module")
def tables(spark):
    root = scratch_dir(spark, "plans")
    found = {}
    for name in ("temperature", "evse_electrical", "evse_state", "evse_session_event"):
        found[name] = spark.read.parquet(writers.append_curated(read_stream(spark, "/root/testdata/sf0.001", name), root, name))
    return found


def plan(df):
    with settings(df.sparkSession, spark__sql__maxMetadataStringLength="4000"):
        return df._jdf.queryExecution().executedPlan().toString()


def test_mart_is_one_scan_and_one_shuffle(tables):
    text = plan(aggregates.power_daily(staging.stage_electrical(tables["evse_electrical"])))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and text.count("HashAggregate") == 2
    schema = text.split("ReadSchema: ")[1]
    assert "power_kw" in schema and "site_id" not in schema and "energy_kwh_total" not in schema
    assert "GreaterThan(power_kw,0.0)" in text.split("PushedFilters")[1]


@pytest.mark.parametrize("as_of", [AS_OF, None])
def test_last_hour_prunes_days(tables, as_of):
    text = plan(aggregates.temperature_per_minute(tables["temperature"], as_of=as_of))
    assert "timestamp_day" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(timestamp," in text.split("PushedFilters")[1]


def test_top_k_does_not_sort_the_table(tables):
    text = plan(latest.latest_faults(tables["evse_state"]))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_sessions_use_hash_aggregates(tables):
    text = plan(episodes.session_summary(tables["evse_session_event"]))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text and text.count("Exchange") == 1


@pytest.mark.parametrize(
    "build",
    [
        lambda t: episodes.fault_episodes(t["evse_state"]),
        lambda t: episodes.derate_onsets(t["evse_state"]),
        lambda t: episodes.energy_from_power(t["evse_electrical"]),
        lambda t: dq.not_increasing(t["evse_electrical"], "energy_kwh_total", "timestamp", ["device_id"]),
    ],
)
def test_scans_without_heavy_keys_shuffle_once(tables, build):
    text = plan(build(tables))
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1


def test_meter_energy_groups_without_another_shuffle(tables):
    assert plan(episodes.energy_from_meter(tables["evse_electrical"])).count("Exchange") == 1


def test_cut_scan_joins_by_broadcast_only(spark, tables):
    with settings(spark, spark__sql__shuffle__partitions="50"):
        text = plan(episodes.fault_episodes(tables["evse_state"], task_rows=20))
    assert "_piece" in text and "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_small_dimension_is_broadcast(spark, tables):
    devices = read_stream(spark, "/root/testdata/sf0.001", "device_metadata")
    joined = enrich_with_devices(tables["evse_session_event"], devices)
    assert "BroadcastHashJoin" in plan(joined)


def test_distinct_connectors_are_combined_before_the_shuffle(tables):
    text = plan(aggregates.daily_load(tables["evse_electrical"], as_of=AS_OF, connector="device_id"))
    assert "partial_count(distinct" in text


def day_filters(df):
    return [part.split("PushedFilters")[0] for part in plan(df).split("PartitionFilters: [")[1:]]


def test_models_prune_days(spark, tables):
    from wattloom.plans.models import model_ref

    mart = aggregates.mart_recent_days(model_ref("mart_evse_power_daily", tables.__getitem__), 7, AS_OF)
    staged = model_ref("stg_temperature", tables.__getitem__).where("day >= date '2024-01-20'")
    for df in (mart, staged):
        filters = day_filters(df)
        assert filters and all("timestamp_day" in f and ">= 2024-01-2" in f for f in filters)
    assert "timestamp_day" not in model_ref("stg_evse_electrical", tables.__getitem__).columns


def test_newest_rows_read_the_last_days(spark, tables):
    found = latest.latest_temperature(tables["temperature"])
    assert ">= 2024-01-" in day_filters(found)[0]
    everything = tables["temperature"].drop("timestamp_day")
    assert found.collect() == latest.latest_temperature(everything).collect()
    assert aggregates.humidity_hourly is not None


def test_newest_rows_go_back_over_sparse_days(spark):
    root = scratch_dir(spark, "sparse")
    rows = read_stream(spark, "/root/testdata/sf0.001", "temperature").where("timestamp < '2024-01-03' or timestamp >= '2024-01-29'")
    sparse = rows.where("timestamp < '2024-01-03'").unionAll(rows.where("timestamp >= '2024-01-29'").limit(2))
    table = spark.read.parquet(writers.append_curated(sparse, root, "temperature"))
    assert latest.latest_temperature(table, 30).collect() == latest.latest_temperature(table.drop("timestamp_day"), 30).collect()


def test_as_of_inside_the_data_hides_later_rows(tables):
    from datetime import timedelta

    from wattloom.functions.timestamps import recent

    for table in (tables["temperature"], tables["temperature"].drop("timestamp_day")):
        seen = recent(table, timedelta(days=1), "2024-01-10 00:30:00")
        assert seen.count() > 0 and seen.where("timestamp > timestamp_ntz '2024-01-10 00:30:00'").count() == 0

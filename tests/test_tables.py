"""Landing, curated tables, publishing, compaction, as-of reads."""

import glob
import os
import shutil
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wattloom.contracts import STREAMS, raw_schema, table_schema
from wattloom.operators.quality import Check, missing
from wattloom.plans.views import register_raw_views
from wattloom.session import scratch_dir, settings
from wattloom.sinks import catalog, maintenance, versions, writers
from wattloom.sinks.folders import Folders
from wattloom.sinks.maintenance import CompactionError, compact, content, read_as_of, recover
from wattloom.sinks.publish import at_least_rows, publish
from wattloom.sources.raw import conform, read_raw
from wattloom.sources.tables import read_curated, read_device_metadata
from wattloom.suite.fixtures import read_stream

AT = datetime(2024, 1, 1, 7, 59, 58)


def temperature(spark, *times):
    rows = [(f"d{i}", t, float(i), "C", None, "NORMAL") for i, t in enumerate(times)]
    return spark.createDataFrame(rows, table_schema("temperature"))


def test_flush_hour_row_is_found(spark):
    """A row of 07:59:58 that was flushed at 08:01 lies under hour=08."""
    root = scratch_dir(spark, "raw")
    writers.write_raw(temperature(spark, AT), root, "temperature", flushed_at="2024-01-01 08:01:00")
    assert os.path.isdir(f"{root}/temperature/year=2024/month=1/day=1/hour=8")
    got = read_raw(spark, root, "temperature", start="2024-01-01 07:00:00", end="2024-01-01 08:00:00")
    assert got.count() == 1
    assert conform(got, "temperature").first()["timestamp"] == AT
    assert read_raw(spark, root, "temperature", start="2024-01-01 08:00:00", end="2024-01-01 09:00:00").count() == 0


def test_raw_pruning_reaches_the_scan(spark):
    root = scratch_dir(spark, "raw")
    writers.write_raw(temperature(spark, *[datetime(2024, 1, d, 5) for d in (1, 2, 3)]), root, "temperature")
    got = read_raw(spark, root, "temperature", start="2024-01-02 00:00:00", end="2024-01-03 00:00:00")
    with settings(spark, spark__sql__maxMetadataStringLength="2000"):
        scan = got._jdf.queryExecution().sparkPlan().toString()
    assert "make_timestamp_ntz" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(timestamp" in scan
    # Folders after the range are listed too, unless a horizon says how late a row may be flushed.
    assert len(got.inputFiles()) == 2 and got.count() == 1
    near = read_raw(spark, root, "temperature", start="2024-01-01 00:00:00", end="2024-01-02 00:00:00", horizon=timedelta(minutes=15))
    assert len(near.inputFiles()) == 2 and near.count() == 1
    assert read_raw(spark, root, "temperature", start="2024-01-02 00:00:00").count() == 2
    assert read_raw(spark, root, "temperature", start="2025-01-02 00:00:00", end="2025-01-03 00:00:00").count() == 0
    for days in (1, 400, 4000):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read_raw(spark, root, "humidity", start="2024-01-02 00:00:00", end=str(datetime(2024, 1, 2) + timedelta(days=days)))
        ranged = read_raw(spark, root, "temperature", start="2024-01-02 00:00:00", end=str(datetime(2024, 1, 2) + timedelta(days=days)))
        assert ranged.count() == (1 if days == 1 else 2)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_raw(spark, root, "humidity")


def test_row_flushed_hours_late_is_found(spark):
    root = scratch_dir(spark, "raw")
    writers.write_raw(temperature(spark, AT), root, "temperature", flushed_at="2024-01-01 10:01:00")
    assert read_raw(spark, root, "temperature", start="2024-01-01 07:00:00", end="2024-01-01 08:00:00").count() == 1


def test_times_do_not_depend_on_the_session_zone(spark):
    df = temperature(spark, AT)
    with settings(spark, spark__sql__session__timeZone="America/Los_Angeles"):
        root = scratch_dir(spark, "zone")
        writers.write_raw(df, root, "temperature")
        assert os.path.isdir(f"{root.removeprefix('file:')}/temperature/year=2024/month=1/day=1/hour=7")
        raw = read_raw(spark, root, "temperature", start="2024-01-01 07:00:00", end="2024-01-01 08:00:00")
        assert raw.first()["timestamp"] == 1704095998000
        assert conform(raw, "temperature").selectExpr("cast(timestamp as string) t").first()["t"] == "2024-01-01 07:59:58"


def test_padded_folder_names(spark):
    root = scratch_dir(spark, "raw")
    writers.write_raw(temperature(spark, datetime(2024, 1, 2, 5)), root, "temperature")
    source = glob.glob(f"{root}/temperature/year=2024/month=1/day=2/hour=5/*.parquet")[0]
    folder = f"{root}/padded/temperature/year=2024/month=01/day=02/hour=05"
    os.makedirs(folder)
    shutil.copy(source, folder)
    got = read_raw(spark, f"{root}/padded", "temperature", start="2024-01-02 00:00:00", end="2024-01-02 10:00:00")
    assert [(r["month"], r["day"], r["hour"]) for r in got.collect()] == [(1, 2, 5)]


def test_untyped_null_columns(spark):
    """Files whose never-filled columns carry no type, mixed with fully typed files."""
    root = scratch_dir(spark, "raw")
    folder = f"{root}/evse_session_event/year=2024/month=1/day=1/hour=7"
    os.makedirs(folder)
    base = {
        "site_id": ["s"], "asset_id": ["a"], "connector_id": [1], "device_id": ["d"], "timestamp": [1704095998000],
        "session_id": ["x"], "event_type": ["FAULT"], "reason_code": ["r"], "severity": ["ERROR"],
        "meter_start_kwh": [1.5], "meter_end_kwh": [None],
    }
    pq.write_table(pa.table(base | {"energy_delivered_kwh": [None], "duration_s": [None], "user_id_hash": [None]}), f"{folder}/a.parquet")
    pq.write_table(
        pa.table(base | {"meter_end_kwh": [2.5], "energy_delivered_kwh": [1.0], "duration_s": [9], "user_id_hash": ["h"]}), f"{folder}/b.parquet"
    )
    got = conform(read_raw(spark, root, "evse_session_event"), "evse_session_event").orderBy("duration_s").collect()
    assert [(r["energy_delivered_kwh"], r["duration_s"], r["user_id_hash"]) for r in got] == [(None, None, None), (1.0, 9, "h")]
    assert got[0]["timestamp"] == AT
    ranged = read_raw(spark, root, "evse_session_event", start="2024-01-01 00:00:00", end="2024-01-02 00:00:00")
    assert sorted((r["user_id_hash"] or "", r["hour"]) for r in ranged.collect()) == [("", 7), ("h", 7)]


def test_conform_fills_missing_columns(spark):
    df = spark.createDataFrame([(1704095998000, "3")], "timestamp long, connector_id string")
    got = conform(df, "evse_state")
    assert got.schema == table_schema("evse_state")
    row = got.first()
    assert (row["timestamp"], row["connector_id"], row["state"]) == (AT, 3, None)
    assert raw_schema("evse_state").names == got.columns


def test_curated_day_pruning(spark):
    root = scratch_dir(spark, "curated")
    writers.append_curated(temperature(spark, datetime(2024, 1, 1, 23, 59, 59, 999000), datetime(2024, 1, 2)), root, "temperature")
    table = read_curated(spark, "temperature", root)
    assert sorted(str(r["timestamp_day"]) for r in table.collect()) == ["2024-01-01", "2024-01-02"]
    from wattloom.functions.timestamps import time_range

    kept = time_range(table, "2024-01-02 00:00:00", "2024-01-02 12:00:00")
    filters = kept._jdf.queryExecution().sparkPlan().toString().split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "timestamp_day" in filters and ">= 2024-01-02" in filters
    assert kept.count() == 1
    with pytest.raises(KeyError):
        read_curated(spark, "nope", root)


def test_catalog_jobs(spark):
    catalog.create_schema(spark, "wl_test", scratch_dir(spark, "schema"))
    try:
        assert len(writers.ensure_tables(spark, "wl_test")) == 6
        assert writers.ensure_tables(spark, "wl_test") == []
        rows = writers.with_day(temperature(spark, AT))
        writers.insert_select(rows, "wl_test.temperature")
        writers.insert_select(rows, "wl_test.temperature")
        assert read_curated(spark, "wl_test.temperature").count() == 2
        writers.create_table_as(spark.table("wl_test.temperature"), "wl_test.copy")
        assert spark.table("wl_test.copy").count() == 2
        with pytest.raises(Exception, match="(?i)already exists"):
            writers.create_table_as(rows, "wl_test.copy")
        assert {r[0] for r in catalog.list_tables(spark, "wl_test").collect()} == {*STREAMS, "copy"}
        assert "wl_test" in {r[0] for r in catalog.list_schemas(spark).collect()}
        assert "value_celsius" in {r["col_name"] for r in catalog.describe(spark, "wl_test.temperature").collect()}
        catalog.reset_schema(spark, "wl_test", scratch_dir(spark, "schema"))
        assert spark.table("wl_test.temperature").count() == 0
    finally:
        catalog.drop_schema(spark, "wl_test")


def test_device_metadata(spark, sf):
    path = scratch_dir(spark, "devices")
    read_stream(spark, sf, "device_metadata").write.parquet(path)
    got = read_device_metadata(spark, path)
    assert got.schema["installed_at"].dataType.simpleString() == "timestamp_ntz" and got.count() > 0


@pytest.mark.parametrize("temporary", [True, False])
def test_failed_audit_leaves_target(spark, temporary):
    root, view = scratch_dir(spark, "published"), f"live_{temporary}".lower()
    checks = [at_least_rows("t", 1), Check("unit", "t", missing("unit")), Check("device", "t", missing("device_id"), severity="error")]
    good = temperature(spark, AT, AT)
    assert publish(spark, good, root, view, checks, temporary=temporary).published
    for bad in (good.where("false"), good.selectExpr("cast(null as string) device_id", "unit", "timestamp")):
        outcome = publish(spark, bad, root, view, checks, temporary=temporary)
        assert not outcome.published and outcome.report.where("status = 'error'").count() == 1
        assert spark.table(view).count() == 2
    # A warning does not stop a version.
    assert publish(spark, good.selectExpr("device_id", "cast(null as string) unit"), root, view, checks, temporary=temporary).published
    assert spark.table(view).columns == ["device_id", "unit"]
    spark.sql(f"DROP VIEW {view}")


def files(path, day="*"):
    return glob.glob(f"{path}/timestamp_day={day}/**/*.parquet", recursive=True)


def test_compaction_keeps_rows(spark, sf):
    root = scratch_dir(spark, "curated")
    df = read_stream(spark, sf, "temperature").where("timestamp < '2024-01-04'")
    for k in range(4):
        path = writers.append_curated(df.where(f"hour(timestamp) div 6 = {k}"), root, "temperature")
    before, old_first_day = content(spark.read.parquet(path), df.columns), files(path, "2024-01-01")
    done = compact(spark, path, since="2024-01-02")
    assert content(spark.read.parquet(path), df.columns) == before == content(df, df.columns)
    assert (done.days, done.files_after) == (2, 2) and done.files_before == 8
    assert files(path, "2024-01-01") == old_first_day
    assert not glob.glob(f"{path}/_*-*")
    assert compact(spark, path, since="2030-01-01").days == 0


def test_compaction_splits_a_large_day(spark, sf):
    path = f"{scratch_dir(spark, 'curated')}/temperature"
    df = writers.with_day(read_stream(spark, sf, "temperature").where("timestamp < '2024-01-02'"))
    df.repartition(12).write.partitionBy("timestamp_day").parquet(path)
    size = sum(os.path.getsize(f) for f in files(path.removeprefix("file:")))
    done = compact(spark, path, target_mb=size / 3 / 2**20)
    assert done.files_before == 12 and 1 < done.files_after < 12 and spark.read.parquet(path).count() == df.count()


def several(spark, root):
    days = [AT, datetime(2024, 1, 2), datetime(2024, 1, 3)]
    for _ in range(2):
        path = writers.append_curated(temperature(spark, *days), root, "temperature")
    return path


def test_broken_compaction_leaves_table(spark, monkeypatch):
    path = several(spark, scratch_dir(spark, "curated"))
    before = sorted(files(path))
    monkeypatch.setattr(maintenance, "content", lambda df, columns, seen=iter([1, 2]): next(seen))
    with pytest.raises(CompactionError):
        compact(spark, path)
    assert sorted(files(path)) == before
    monkeypatch.undo()
    real_move, calls = maintenance.Folders.move, []

    def failing_move(self, source, target):
        calls.append(source)
        if len(calls) == 4:
            raise OSError("disk gone")
        real_move(self, source, target)

    monkeypatch.setattr(maintenance.Folders, "move", failing_move)
    with pytest.raises(OSError):
        compact(spark, path)
    assert sorted(files(path)) == before and spark.read.parquet(path).count() == 6


@pytest.mark.parametrize("moves", [0, 1, 2, 3])
def test_dead_compaction_is_completed_or_undone(spark, monkeypatch, moves):
    path = several(spark, scratch_dir(spark, "curated"))
    real_move, calls = maintenance.Folders.move, []

    class Died(BaseException):
        pass

    def dying_move(self, source, target):
        if len(calls) == moves:
            raise Died
        calls.append(source)
        real_move(self, source, target)

    monkeypatch.setattr(maintenance.Folders, "move", dying_move)
    with pytest.raises(Died):
        compact(spark, path)
    monkeypatch.undo()
    recover(spark, path)
    assert spark.read.parquet(path).count() == 6 and not glob.glob(f"{path}/_*-*")
    assert compact(spark, path).days == 3 - (moves + 1) // 2 and len(files(path)) == 3


def test_compaction_takes_untimed_rows_and_rewrites_no_day_twice(spark):
    root = scratch_dir(spark, "curated")
    untimed = temperature(spark, AT).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    for _ in range(2):
        path = writers.append_curated(temperature(spark, AT).unionAll(untimed), root, "temperature")
    assert compact(spark, path).days == 2 and spark.read.parquet(path).count() == 4
    kept = sorted(files(path))
    assert compact(spark, path).days == 0 and sorted(files(path)) == kept


def with_columns_of_their_own(spark, root):
    """Two files with a column that three others of the day do not have, and a large one."""
    df = temperature(spark, AT)
    for k in range(5):
        more = df.withColumn("extra", F.lit(k)) if k < 2 else df
        path = writers.append_curated(more, root, "temperature")
    return path


def test_compaction_keeps_the_columns_of_all_files(spark):
    for _ in range(3):
        path = with_columns_of_their_own(spark, scratch_dir(spark, "curated"))
        done = compact(spark, path)
        assert (done.files_before, done.files_after) == (5, 1)
        table = spark.read.parquet(path)
        assert sorted(r["extra"] for r in table.where("extra is not null").collect()) == [0, 1] and table.count() == 5


def test_compaction_refuses_types_that_disagree(spark):
    path = with_columns_of_their_own(spark, scratch_dir(spark, "curated"))
    writers.append_curated(temperature(spark, AT).withColumn("extra", F.lit("text")), os.path.dirname(path), "temperature")
    before = sorted(files(path))
    with pytest.raises(Exception, match="(?i)schema|type"):
        compact(spark, path)
    assert sorted(files(path)) == before


def large_and_small(spark, root):
    rows = spark.range(50_000).select(
        F.concat(F.lit("d"), F.col("id")).alias("device_id"), F.lit(AT).cast("timestamp_ntz").alias("timestamp"), F.rand(1).alias("value_celsius")
    )
    path = writers.append_curated(rows.coalesce(1), root, "temperature")
    large = files(path)
    for k in range(4):
        writers.append_curated(rows.limit(3 + k), root, "temperature")
    return path, large, max(os.path.getsize(f) for f in large)


def test_compaction_leaves_large_files_alone(spark):
    path, large, size = large_and_small(spark, scratch_dir(spark, "curated"))
    when = os.path.getmtime(large[0])
    done = compact(spark, path, target_mb=size / 2**20)
    assert (done.files_before, done.files_after, done.bytes_before < size) == (4, 1, True)
    assert large[0] in files(path) and len(files(path)) == 2 and os.path.getmtime(large[0]) == when
    assert spark.read.parquet(path).count() == 50_018
    assert compact(spark, path, target_mb=size / 2**20).days == 0


@pytest.mark.parametrize("died", [True, False])
@pytest.mark.parametrize("moves", [0, 1, 2])
def test_large_files_survive_a_compaction_that_fails(spark, monkeypatch, moves, died):
    path, large, size = large_and_small(spark, scratch_dir(spark, "curated"))
    real_move, calls = maintenance.Folders.move, []

    class Failed(BaseException if died else Exception):
        pass

    def failing_move(self, source, target):
        calls.append(source)
        if len(calls) == moves + 1:
            raise Failed
        real_move(self, source, target)

    monkeypatch.setattr(maintenance.Folders, "move", failing_move)
    with pytest.raises(Failed):
        compact(spark, path, target_mb=size / 2**20)
    monkeypatch.undo()
    recover(spark, path)
    assert spark.read.parquet(path).count() == 50_018 and large[0] in files(path) and not glob.glob(f"{path}/_*-*")


def test_compaction_lists_files_in_spark(spark, monkeypatch):
    path = several(spark, scratch_dir(spark, "curated"))
    monkeypatch.setattr(maintenance.Folders, "size", lambda *_: pytest.fail("a call for each file"))
    assert compact(spark, path).files_before == 6


def test_newest_batch_stays_apart(spark):
    path = f"{scratch_dir(spark, 'curated')}/temperature"
    for number in range(3):
        writers.commit_batch(temperature(spark, AT), path, number, "2024-02-01 00:00:00")
    compact(spark, path)
    writers.commit_batch(temperature(spark, AT), path, 2, "2024-02-01 00:00:00")
    assert spark.read.parquet(path).count() == 3


def test_curated_schema_is_the_contracts_whatever_the_files_hold(spark):
    root = scratch_dir(spark, "curated")
    df = temperature(spark, AT)
    path = writers.append_curated(df, root, "temperature", 0, "2024-02-01 00:00:00")
    writers.append_curated(df, root, "temperature")
    table = read_curated(spark, "temperature", root, keep_lineage=True)
    assert table.columns[-4:] == ["_batch_id", "_committed_at", "timestamp_day", "_write_id"] and table.count() == 2
    assert read_curated(spark, "temperature", root).columns == [*df.columns, "timestamp_day"]
    with pytest.raises(ValueError):
        read_as_of(table, version=0)
    assert read_as_of(table, at="2024-02-01 12:00:00").count() == 1
    assert path.endswith("temperature")


def test_failed_model_run_leaves_the_model(spark, monkeypatch):
    path = f"{scratch_dir(spark, 'models')}/m"
    versions.write_model(spark.range(3), path)
    bad = spark.range(2).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        versions.write_model(bad, path)
    assert versions.read_model(spark, path).count() == 3

    # A run that dies after its rows are written, right before they become the model.
    def die(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(Folders, "mark", die)
        with pytest.raises(OSError):
            versions.write_model(spark.range(4), path)
    early = versions.read_model(spark, path)
    assert early.count() == 3
    versions.write_model(spark.range(5), path)
    # Whoever has planned on the version before can still read it.
    assert (versions.read_model(spark, path).count(), early.count()) == (5, 3)
    assert len(versions.remove_unfinished(spark, path)) == 2
    assert versions.remove_unfinished(spark, path) == []
    versions.write_model(spark.range(6), path, keep=1)
    assert versions.read_model(spark, path).count() == 6
    assert len(Folders(spark, path).names(path)) == 2  # the version and the marks


def test_model_folder_without_versions(spark):
    path = f"{scratch_dir(spark, 'models')}/m"
    with pytest.raises(AnalysisException):
        versions.read_model(spark, path)
    spark.range(2).write.parquet(path)
    assert versions.read_model(spark, path).count() == 2
    versions.write_model(spark.range(4), path)
    assert versions.read_model(spark, path).count() == 4


def test_old_versions_are_removed(spark):
    root, view = scratch_dir(spark, "published"), "kept_versions"
    for _ in range(4):
        last = publish(spark, temperature(spark, AT), root, view, [at_least_rows("t", 1)], temporary=True, keep=2)
    versions = glob.glob(f"{root.removeprefix('file:')}/{view}/*")
    assert len(versions) == 2 and any(last.path.endswith(os.path.basename(v)) for v in versions)


def test_raw_views(spark):
    root = scratch_dir(spark, "raw")
    writers.write_raw(temperature(spark, AT), root, "temperature")
    assert register_raw_views(spark, root, ["temperature"]) == ["raw_temperature"]
    assert spark.sql("select count(*) n from raw_temperature where hour = 7").first()["n"] == 1


def test_replayed_batch_replaces_itself_also_after_compaction(spark):
    path = f"{scratch_dir(spark, 'curated')}/temperature"
    batches = [temperature(spark, AT, AT), temperature(spark, AT), temperature(spark, datetime(2024, 1, 2))]
    for number, batch in enumerate(batches):
        for _ in range(2):
            writers.commit_batch(batch, path, number, f"2024-02-0{number + 1} 00:00:00")
    assert spark.read.parquet(path).count() == 4
    compact(spark, path, before_batch=2)
    writers.commit_batch(batches[2], path, 2, "2024-02-03 00:00:00")
    table = spark.read.parquet(path)
    assert table.count() == 4 and {r[0] for r in table.select("_write_id").distinct().collect()} == {"merged", "b2"}
    assert read_as_of(table, version=0).count() == 2 and read_as_of(table, version=1).count() == 3
    assert read_as_of(table, at="2024-02-02 12:00:00").count() == 3
    assert "_batch_id" not in read_as_of(table, version=1).columns
    with pytest.raises(ValueError):
        read_as_of(table)


def test_scratch_and_settings(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    with settings(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"

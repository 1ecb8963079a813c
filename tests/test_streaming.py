"""Streaming jobs: restart, replay, late rows, latch state, duplicates."""

import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattloom.contracts import table_schema
from wattloom.functions.timestamps import to_epoch_ms
from wattloom.operators import episodes
from wattloom.session import scratch_dir
from wattloom.sinks.maintenance import compact, read_as_of
from wattloom.streaming import copies, ingest, latch, windows

T0 = datetime(2024, 1, 1)


def land(df, root, stream):
    df.withColumn("timestamp", to_epoch_ms("timestamp")).coalesce(1).write.mode("append").parquet(f"{root}/landing/{stream}")


def temperature(spark, *seconds, value=1.0):
    rows = [("d", T0 + timedelta(seconds=s), value, "C", None, "NORMAL") for s in seconds]
    return spark.createDataFrame(rows, table_schema("temperature"))


def states(spark, start, derates):
    rows = [("d", T0 + timedelta(seconds=start + i), d) for i, d in enumerate(derates)]
    df = spark.createDataFrame(rows, "device_id string, timestamp timestamp_ntz, derate_pct double")
    from wattloom.sources.raw import conform

    return conform(df, "evse_state")


def run_ingest(spark, root, **options):
    ingest.ingest(spark, f"{root}/landing", "temperature", f"{root}/curated", f"{root}/checkpoint", **options).awaitTermination()
    return spark.read.parquet(f"{root}/curated/temperature")


def test_ingest_restarts_and_keeps_lineage(spark):
    root = scratch_dir(spark, "ingest")
    land(temperature(spark, 0, 1), root, "temperature")
    assert run_ingest(spark, root).count() == 2
    assert run_ingest(spark, root).count() == 2
    land(temperature(spark, 2, 90_000), root, "temperature")
    land(temperature(spark, 3), root, "temperature")
    table = run_ingest(spark, root, max_files=1)
    assert table.count() == 5
    assert [r[0] for r in table.select("_batch_id").distinct().orderBy("_batch_id").collect()] == [0, 1, 2]
    assert read_as_of(table, version=0).count() == 2
    assert read_as_of(table, version=0).columns == [*table_schema("temperature").names, "timestamp_day"]


def test_replayed_batch_keeps_commit_time(spark):
    path = f"{scratch_dir(spark, 'replay')}/temperature"
    write = ingest.curated_batch_writer(path)
    batch = temperature(spark, 0, 1)
    write(batch, 7)
    first = spark.read.parquet(path).first()["_committed_at"]
    write(batch, 7)
    table = spark.read.parquet(path)
    assert table.count() == 2 and table.first()["_committed_at"] == first


def test_limits_exclude_each_other(spark):
    with pytest.raises(ValueError):
        ingest.landing_stream(spark, "x", "temperature", max_files=1, max_bytes=1)


def test_dedup_drops_copies_but_keeps_rows_of_one_tick(spark):
    root = scratch_dir(spark, "dedup")
    tick = temperature(spark, 0, 0).unionAll(temperature(spark, 0, value=2.0))
    land(tick, root, "temperature")
    assert run_ingest(spark, root, drop_copies=True).count() == 2
    land(tick.unionAll(temperature(spark, 5)), root, "temperature")
    assert run_ingest(spark, root, drop_copies=True).count() == 3


def test_late_rows_across_batches_are_kept(spark):
    """Rows late by hours, rows without a time, and copies in later files."""
    root = scratch_dir(spark, "late")
    untimed = temperature(spark, 0).selectExpr("device_id", "cast(null as timestamp_ntz) timestamp", "value_celsius", "unit", "accuracy_pct", "status")
    for rows in (temperature(spark, 90_000, 90_001), temperature(spark, 0, 5), untimed, temperature(spark, 10).unionAll(untimed), temperature(spark, 0)):
        land(rows, root, "temperature")
        table = run_ingest(spark, root, drop_copies=True)
    assert table.count() == 6 and table.where("timestamp is null").count() == 1


def test_replayed_batch_is_not_its_own_copy(spark):
    path = f"{scratch_dir(spark, 'replay')}/temperature"
    write = ingest.curated_batch_writer(path, drop_copies=True)
    for number, batch in enumerate([temperature(spark, 0, 0, 1), temperature(spark, 1, 2)]):
        for _ in range(2):
            write(batch, number)
    assert spark.read.parquet(path).count() == 3


def test_copies_are_found_without_the_rows_of_the_table(spark):
    path = f"{scratch_dir(spark, 'hashes')}/temperature"
    write = ingest.curated_batch_writer(path, drop_copies=True)
    for number, batch in enumerate([temperature(spark, 0, 1), temperature(spark, 90_000)]):
        write(batch, number)
    found = copies.new_rows(temperature(spark, 1, 2), path, 2)
    assert found.inputFiles() and all("temperature_hashes/" in file for file in found.inputFiles())
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert scans and all("timestamp_day#" in line.partition("PartitionFilters: [")[2].partition("]")[0] for line in scans)
    assert all("ReadSchema: struct<key_a:bigint,key_b:bigint>" in line for line in scans)
    assert found.count() == 1


def test_hashes_that_are_missing_or_old_are_made_up_for(spark):
    path = f"{scratch_dir(spark, 'hashes')}/temperature"
    ingest.curated_batch_writer(path)(temperature(spark, 0, 1), 0)  # without hashes
    write = ingest.curated_batch_writer(path, drop_copies=True)
    write(temperature(spark, 1, 2), 1)
    assert spark.read.parquet(path).count() == 3
    ingest.curated_batch_writer(path)(temperature(spark, 3, 4), 2)
    compact(spark, path, before_batch=3)
    untimed = temperature(spark, 0).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    write(temperature(spark, 0, 2, 3, 5).unionAll(untimed), 3)
    write(temperature(spark, 4, 5, 6).unionAll(untimed), 4)
    write(temperature(spark, 4, 5, 6).unionAll(untimed), 4)
    table = spark.read.parquet(path)
    assert table.count() == 8 and table.where("timestamp is null").count() == 1
    write(spark.createDataFrame([], temperature(spark, 0).schema), 5)
    assert spark.read.parquet(path).count() == 8


def test_old_and_untyped_files_are_read(spark):
    import pyarrow as pa
    import pyarrow.parquet as pq

    root = scratch_dir(spark, "untyped").removeprefix("file:")
    os.makedirs(f"{root}/landing/temperature")
    row = {"device_id": ["d"], "timestamp": [1], "value_celsius": [1.0], "unit": [None], "accuracy_pct": [None], "status": ["NORMAL"]}
    pq.write_table(pa.table(row), f"{root}/landing/temperature/a.parquet")
    pq.write_table(pa.table(row | {"unit": ["C"]}), f"{root}/landing/temperature/b.parquet")
    os.utime(f"{root}/landing/temperature/a.parquet", (1, 1))
    assert sorted((r["unit"] or "") for r in run_ingest(spark, root).collect()) == ["", "C"]


def test_archived_files_are_not_listed_again(spark):
    root = scratch_dir(spark, "archive")
    land(temperature(spark, 0), root, "temperature")
    run_ingest(spark, root, done_with=f"{root}/done")
    land(temperature(spark, 1), root, "temperature")
    assert run_ingest(spark, root, done_with=f"{root}/done").count() == 2


def test_late_row_is_counted_and_a_trigger_touches_only_its_own_parts(spark):
    root, live = scratch_dir(spark, "trend"), windows.temperature_per_minute()

    def catch_up():
        rows = ingest.landing_stream(spark, f"{root}/landing", "temperature")
        windows.keep_current(rows, "temperature", live, f"{root}/out", f"{root}/checkpoint").awaitTermination()
        return {r["ts"]: r["n"] for r in windows.read_current(spark, f"{root}/out", live).collect()}

    land(temperature(spark, 0, 59, 60, 7200, 90_000), root, "temperature")
    assert catch_up() == {T0: 2, T0 + timedelta(minutes=1): 1, T0 + timedelta(hours=2): 1, T0 + timedelta(hours=25): 1}
    kept = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/out/**/*.parquet", recursive=True)}
    land(temperature(spark, 30), root, "temperature")
    assert catch_up()[T0] == 3
    now = glob.glob(f"{root}/out/**/*.parquet", recursive=True)
    assert kept.items() <= {f: os.path.getmtime(f) for f in now}.items()
    # The new parts are one bucket of one day, and no rows are kept beside them.
    assert len(now) == len(kept) + 1 and sorted(os.listdir(root)) == ["checkpoint", "landing", "out"]


def test_trigger_does_not_read_the_parts(spark):
    path, live = f"{scratch_dir(spark, 'parts')}/out", windows.session_events_hourly()
    batch = spark.createDataFrame([(T0, "FAULT", "ERROR")], "timestamp timestamp_ntz, event_type string, severity string")
    write = windows.bucket_writer(path, live)
    write(batch, 0)
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        with open(file, "w") as broken:  # reading it would fail
            broken.write("x")
    write(batch, 1)
    assert spark.read.parquet(f"{path}/timestamp_day=2024-01-01/_write_id=b1").first()["_rows"] == 1


def test_parts_are_replayed_and_folded(spark):
    path, live = f"{scratch_dir(spark, 'parts')}/out", windows.temperature_per_minute(scale=3)
    write = windows.bucket_writer(path, live)
    untimed = temperature(spark, 0, value=7.0).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    batches = [temperature(spark, 0, 10, 70), temperature(spark, 20, 86_400, value=2.5).unionAll(untimed), temperature(spark, 30, value=-1.0), temperature(spark, 40)]
    for number, batch in enumerate(batches):
        write(batch, number)
    write(batches[1], 1)  # again
    write(spark.createDataFrame([], batches[0].schema), 4)

    def current():
        return sorted((tuple(r) for r in windows.read_current(spark, path, live).collect()), key=str)

    before = current()
    assert before == sorted(
        [(T0, 0.9, 2.5, 5), (T0 + timedelta(minutes=1), 1.0, 1.0, 1), (T0 + timedelta(days=1), 2.5, 2.5, 1), (None, 7.0, 7.0, 1)], key=str
    )
    done = windows.fold(spark, path, live)
    assert (done.days, done.files_before, done.files_after) == (1, 3, 1) and current() == before
    # Parts of a bucket are one row now, and the newest batch may still be replayed.
    merged = windows.read_parts(spark, path).where("timestamp_day = date'2024-01-01'")
    assert sorted((r["_write_id"], r["_rows"]) for r in merged.collect()) == [("b3", 1), ("merged", 1), ("merged", 4)]
    write(batches[3], 3)
    assert current() == before


PARTS = [[None, 0.5, 1.2], [0.0, 3.0], [None], [2.0, 2.5]]


def landed_latch(spark, root):
    return latch.landed_history(f"{root}/landing", "evse_state", f"{root}/index")


def onsets(df):
    return sorted(map(tuple, df.select("device_id", "timestamp", "derate_pct").collect()), key=str)


@pytest.mark.parametrize("task_rows", [10**9, 1])
def test_latch_survives_batches_and_equals_batch_result(spark, task_rows):
    root = scratch_dir(spark, "latch")
    position = 0
    for part in PARTS:
        land(states(spark, position, part), root, "evse_state")
        position += len(part)
        rows = ingest.landing_stream(spark, f"{root}/landing", "evse_state")
        latch.derate_onsets(rows, f"{root}/out", f"{root}/checkpoint", landed_latch(spark, root), task_rows=task_rows).awaitTermination()
    live = latch.read_onsets(spark, f"{root}/out")
    assert sorted(r["derate_pct"] for r in live.collect()) == [1.2, 2.0]
    whole = episodes.derate_onsets(states(spark, 0, [d for part in PARTS for d in part]))
    assert onsets(live) == onsets(whole)


def no_history(spark, days):
    raise AssertionError("rows on time need no history")


def test_latch_keeps_idle_devices_and_replays(spark):
    path = f"{scratch_dir(spark, 'latch')}/onsets"
    write = latch.onset_writer(path, no_history)
    other = states(spark, 0, [5.0]).replace("d", "idle", "device_id")
    later = states(spark, 20, [9.0]).replace("d", "idle", "device_id")
    batches = [states(spark, 0, [5.0]).unionAll(other), states(spark, 10, [6.0, None, 7.0]), later, later.limit(0)]
    for number, batch in enumerate(batches):
        for _ in range(2):
            write(batch, number)
    got = latch.read_onsets(spark, path).collect()
    assert sorted((r["device_id"], r["derate_pct"]) for r in got) == [("d", 5.0), ("d", 7.0), ("idle", 5.0)]


def test_late_rows_take_back_and_add_onsets(spark):
    root = scratch_dir(spark, "latch")
    write = latch.onset_writer(f"{root}/out", landed_latch(spark, root))
    day = 86400
    steps = [
        (states(spark, 0, [5.0, 6.0, 7.0]).unionAll(states(spark, day, [8.0])), {5.0}),
        # A reset between two rows adds an onset.
        (states(spark, 1, [None]).withColumn("timestamp", F.col("timestamp") + F.expr("interval 500 milliseconds")), {5.0, 7.0}),
        # One at the end of the first day makes the next day's first row fire, without reading that day again.
        (states(spark, day - 1, [None]), {5.0, 7.0, 8.0}),
        # An earlier row takes the onset over, and a row before a day's first one takes that onset back.
        (states(spark, -1, [4.0]), {4.0, 7.0, 8.0}),
        (states(spark, day - 1, [3.0]).withColumn("timestamp", F.col("timestamp") + F.expr("interval 500 milliseconds")), {4.0, 7.0, 3.0}),
    ]
    so_far = None
    for number, (batch, expected) in enumerate(steps):
        land(batch, root, "evse_state")
        so_far = batch if so_far is None else so_far.unionAll(batch)
        for _ in range(2):
            write(batch, number)
        live = latch.read_onsets(spark, f"{root}/out")
        assert {r["derate_pct"] for r in live.collect()} == expected
        assert onsets(live) == onsets(episodes.derate_onsets(so_far))


def test_latch_in_any_order_of_batches(spark):
    pattern = [None, 2.0, 3.0, None, None, 4.0, 0.5, 5.0, None, 6.0, 7.0, None, 8.0, 9.0]
    rows = [(f"d{n % 2}", T0 + timedelta(hours=5 * i + n), v) for n in range(2) for i, v in enumerate(pattern)] + [(None, T0, 3.0)]
    from wattloom.sources.raw import conform

    def frame(part):
        return conform(spark.createDataFrame(part, "device_id string, timestamp timestamp_ntz, derate_pct double"), "evse_state")

    root = scratch_dir(spark, "latch")
    write = latch.onset_writer(f"{root}/out", landed_latch(spark, root), task_rows=1)
    for number in range(4):
        part = frame([r for i, r in enumerate(rows) if (i * 7 + i // 5) % 4 == number])
        land(part, root, "evse_state")
        write(part, number)
    assert onsets(latch.read_onsets(spark, f"{root}/out")) == onsets(episodes.derate_onsets(frame(rows)))


def test_spans_of_days():
    days = [T0.date() + timedelta(days=n) for n in (4, 0, 1, 1)]
    assert latch.spans_of(days) == [(T0, T0 + timedelta(days=2)), (T0 + timedelta(days=4), T0 + timedelta(days=5))]


def test_late_batch_reads_the_history_once(spark, monkeypatch):
    root, opened = scratch_dir(spark, "latch"), []

    def watched(step):
        return lambda rows, *rest: (opened.extend(rows.inputFiles()), step(rows, *rest))[1]

    for name in ("segments", "inner_onsets"):
        monkeypatch.setattr(latch, name, watched(getattr(latch, name)))
    write = latch.onset_writer(f"{root}/out", landed_latch(spark, root))
    batches = [states(spark, 0, [5.0, None, 6.0]), states(spark, 1, [None, 7.0])]
    for number, batch in enumerate(batches):
        land(batch, root, "evse_state")
        write(batch, number)
    assert onsets(latch.read_onsets(spark, f"{root}/out")) == onsets(episodes.derate_onsets(batches[0].unionAll(batches[1])))
    # What follows the one read works on the rows of late device days, which it wrote.
    assert opened and not [f for f in opened if "/landing/" in f]


def test_spread_landing_does_not_depend_on_row_groups(spark):
    from wattloom.session import settings
    from wattloom.suite.registry import Inputs
    from wattloom.suite.streams import catch_up

    class Nothing:
        def processAllAvailable(self): ...

        def stop(self): ...

    root, s = scratch_dir(spark, "spread"), Inputs(spark, "/root/testdata/sf0.1")
    with settings(spark, spark__sql__adaptive__coalescePartitions__minPartitionSize="64k"):
        catch_up(s, "evse_state", root, Nothing, spread=True)
    assert len(glob.glob(f"{root}/evse_state/*.parquet")) > 3
    assert spark.read.parquet(f"{root}/evse_state").count() == s("evse_state").count()

import glob
import os
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from wattloom.contracts import raw_schema
from wattloom.session import scratch_dir
from wattloom.sources import landed
from wattloom.sources.raw import epoch_ms

DAY = "2024-01-01"


def land(root, hour, *times, name="a", unit="C", day=1):
    """A file of temperature rows under an hour of January 2024, stamped at the given times."""
    folder = f"{root}/temperature/year=2024/month=1/day={day}/hour={hour}"
    os.makedirs(folder, exist_ok=True)
    stamps = [None if t is None else epoch_ms(t) for t in times]
    rows = {
        "device_id": ["d"] * len(times),
        "timestamp": pa.array(stamps, pa.int64()),
        "value_celsius": [20.5] * len(times),
        "unit": [unit] * len(times),
    }
    pq.write_table(pa.table(rows), f"{folder}/{name}.parquet")


def read(spark, root, index, start=None, end=None):
    return landed.read_indexed(spark, root, "temperature", index, start, end)


def opened(df):
    return sorted("/".join(f.rsplit("/", 2)[1:]) for f in df.inputFiles())


@pytest.fixture()
def places(spark):
    return scratch_dir(spark, "landing"), scratch_dir(spark, "index")


def test_only_files_of_the_range_are_opened(spark, places):
    root, index = places
    land(root, 7, f"{DAY} 07:10:00", name="on_time")
    land(root, 9, f"{DAY} 07:20:00", name="late")
    land(root, 6, f"{DAY} 07:00:40", f"{DAY} 06:59:00", name="ahead")
    land(root, 7, f"{DAY} 06:30:00", name="before")
    land(root, 9, f"{DAY} 09:30:00", name="after")
    got = read(spark, root, index, f"{DAY} 07:00:00", f"{DAY} 08:00:00")
    assert opened(got) == ["hour=6/ahead.parquet", "hour=7/on_time.parquet", "hour=9/late.parquet"]
    assert sorted((r["timestamp"] - epoch_ms(f"{DAY} 07:00:00")) // 1000 for r in got.collect()) == [40, 600, 1200]
    assert {r["hour"] for r in got.collect()} == {6, 7, 9}


def test_footers_are_read_once(spark, places):
    root, index = places
    land(root, 7, f"{DAY} 07:10:00")
    assert landed.refresh(spark, root, "temperature", index).count() == 1
    land(root, 8, f"{DAY} 08:10:00")
    assert landed.refresh(spark, root, "temperature", index).count() == 2
    before = glob.glob(f"{index}/temperature/*.parquet")
    assert sum(pq.read_metadata(f).num_rows for f in before) == 2
    assert landed.refresh(spark, root, "temperature", index).count() == 2
    assert glob.glob(f"{index}/temperature/*.parquet") == before


def test_replaced_and_removed_files(spark, places):
    root, index = places
    land(root, 7, f"{DAY} 07:10:00")
    land(root, 8, f"{DAY} 08:10:00")
    assert read(spark, root, index).count() == 2
    land(root, 7, f"{DAY} 07:10:00", f"{DAY} 07:50:00", f"{DAY} 07:55:00")
    shutil.rmtree(f"{root}/temperature/year=2024/month=1/day=1/hour=8")
    assert read(spark, root, index).count() == 3
    assert read(spark, root, index, f"{DAY} 07:50:00", f"{DAY} 09:00:00").count() == 2


def test_folders_that_are_read_alike_are_given_whole(spark, places):
    root, index = places
    for day in (1, 2, 3):
        for hour in (0, 1):
            land(root, hour, f"2024-01-0{day} 0{hour}:30:00", day=day)
    entries = landed.refresh(spark, root, "temperature", index)
    tail = lambda paths: sorted(p.partition("/temperature")[2] for p in paths)
    assert tail(landed.sources(entries)[""]) == [""]
    ranged = landed.sources(entries, "2024-01-01 01:00:00", "2024-01-03 01:00:00")[""]
    month = "/year=2024/month=1"
    assert tail(ranged) == [f"{month}/day=1/hour=1", f"{month}/day=2", f"{month}/day=3/hour=0"]
    assert landed.sources(entries, "2025-01-01 00:00:00") == {}


def test_untyped_files_apart(spark, places):
    root, index = places
    land(root, 7, f"{DAY} 07:10:00", name="typed")
    land(root, 7, f"{DAY} 07:20:00", name="untyped", unit=None)
    land(root, 8, f"{DAY} 08:20:00", name="untyped", unit=None)
    got = read(spark, root, index)
    assert sorted((r["unit"] or "", r["hour"]) for r in got.collect()) == [("", 7), ("", 8), ("C", 7)]
    assert got.columns[: len(raw_schema("temperature"))] == [f.name for f in raw_schema("temperature")]
    sources = landed.sources(landed.refresh(spark, root, "temperature", index))
    assert [p.rpartition("/")[2] for p in sorted(sources["unit"])] == ["untyped.parquet", "hour=8"]


def test_rows_without_a_time_and_files_without_rows(spark, places):
    root, index = places
    land(root, 7, None, name="no_time")
    land(root, 7, None, f"{DAY} 07:20:00", name="some")
    land(root, 8, name="empty")
    assert read(spark, root, index).count() == 3
    got = read(spark, root, index, f"{DAY} 07:00:00", f"{DAY} 08:00:00")
    assert got.count() == 1 and "hour=8/empty.parquet" not in opened(got)


def test_nothing_landed(spark, places):
    root, index = places
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read(spark, root, index)
    os.makedirs(f"{root}/temperature")
    assert read(spark, root, index, DAY).count() == 0
    land(root, 7, f"{DAY} 07:10:00")
    assert read(spark, root, index, DAY).count() == 1

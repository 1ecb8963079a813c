import glob
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattloom.contracts import table_schema
from wattloom.operators import digests
from wattloom.session import scratch_dir
from wattloom.sinks import writers
from wattloom.sources.tables import read_curated

COLUMNS = ["device_id", "timestamp", "value_celsius", "unit", "accuracy_pct", "status"]


def row(device, day, hour, value, unit="C"):
    at = None if day is None else datetime(2024, 1, day, hour, 5)
    return (device, at, value, unit, None, "NORMAL")


ROWS = [row(f"d{i % 7}", 1 + i % 4, i % 3, float(i)) for i in range(200)]
ROWS += [row(None, 1, 0, 1.0), row("d1", None, None, 2.0), row("d1", None, None, 2.0), row("d2", 3, 1, 5.0, unit=None)]


def table(spark, rows, root):
    df = spark.createDataFrame(rows, table_schema("temperature"))
    writers.append_curated(df, root, "temperature")
    return read_curated(spark, "temperature", root)


def sides(spark, left, right):
    root = scratch_dir(spark, "sides")
    tables = [table(spark, rows, f"{root}/{name}") for name, rows in (("left", left), ("right", right))]
    stored = [digests.read_digests(spark, digests.write_digests(t, f"{root}/digests-{n}", COLUMNS)) for n, t in enumerate(tables)]
    return root, *tables, *stored


def found(df):
    return Counter({tuple(r[c] for c in COLUMNS): r["copies"] for r in df.collect()})


def test_equal_sides_in_another_order(spark):
    _, *both = sides(spark, ROWS, ROWS[::-1])
    assert digests.differing_branches(*both[2:]).count() == 0
    assert digests.differing_rows(*both, COLUMNS).count() == 0


@pytest.mark.parametrize(
    "gone, more",
    [
        ([0], []),
        ([5, 17, 200], [row("new", 9, 3, 1.0)]),  # a row without a device, and a day that one side lacks
        ([201], []),  # one of two equal rows without a time
        ([203], [row("d2", 3, 1, 5.0, unit="")]),  # NULL against an empty text, in the same branch
        ([3], [row("d3", 4, 0, -3.0)]),
        (range(len(ROWS)), []),
    ],
)
def test_differences_against_brute_force(spark, gone, more):
    right = [r for n, r in enumerate(ROWS) if n not in set(gone)] + more
    _, *both = sides(spark, ROWS, right)
    expected = Counter(ROWS)
    expected.subtract(Counter(right))
    assert found(digests.differing_rows(*both, COLUMNS)) == Counter({r: n for r, n in expected.items() if n})
    keys = digests.differing_keys(*both, COLUMNS)
    assert keys.agg(F.sum("only_left") - F.sum("only_right")).first()[0] == sum(expected.values())


def test_levels_add_up(spark):
    _, left, _, stored, _ = sides(spark, ROWS, ROWS)
    per_level = stored.groupBy("level").agg(*[F.sum(m).alias(m) for m in digests.MEASURES])
    assert len({tuple(r[m] for m in digests.MEASURES) for r in per_level.collect()}) == 1
    assert per_level.first()["rows"] == left.count() == len(ROWS)


def test_other_days_are_not_read(spark):
    root, left, right, *stored = sides(spark, ROWS, [r for r in ROWS if not (r[1] and r[1].day == 2 and r[0] == "d3")])
    expected = digests.differing_rows(left, right, *stored, COLUMNS).count()
    assert expected > 0
    for file in glob.glob(f"{root}/*/temperature/timestamp_day=*/*.parquet"):
        if "2024-01-02" not in file:
            with open(file, "wb") as broken:
                broken.write(b"not a table")
    again = [read_curated(spark, "temperature", f"{root}/{name}") for name in ("left", "right")]
    assert digests.differing_rows(*again, *stored, COLUMNS).count() == expected


def test_days_are_replaced(spark):
    root, left, right, stored, other = sides(spark, ROWS, [r for r in ROWS if not (r[1] and r[1].day == 2)] + [row("x", 2, 0, 0.0)])
    assert digests.differing_days(stored, other) == [datetime(2024, 1, 2).date()]
    digests.write_digests(left.where("timestamp_day = date'2024-01-02'"), f"{root}/digests-1", COLUMNS)
    assert digests.differing_days(stored, digests.read_digests(spark, f"{root}/digests-1")) == []

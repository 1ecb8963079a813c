"""Every registered query against its SQL on the smallest test tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, differences
from wattloom.suite import CASES


@pytest.fixture(scope="module")
def con(sf_path="/root/testdata/sf0.001"):
    return connect(sf_path)


def test_registry():
    assert set(oracle_sql()) & set(CASES) == set(CASES)
    assert set(CASES) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:3] == ["day", "device_id", "asset_id"] and df.count() > 0


@pytest.mark.parametrize("key", sorted(set(oracle_sql()) & set(CASES)))
def test_query(spark, sf, con, key):
    problems, _ = differences(queries()[key](spark, sf), con, oracle_sql()[key])
    assert problems == []

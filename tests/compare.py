"""Run queries in Spark and their SQL in DuckDB and compare rows, names and types.

As a script: ``python tests/compare.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

# A check that finds nothing in good data; a unit test shows that it fires.
NORMALLY_EMPTY = {"test_mart_positive"}

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "FLOAT": "float",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for table in TABLES.split():
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _key(row):
    return tuple((v is not None, "" if v is None else repr(v)) for v in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return 0.0 if value == 0 and isinstance(value, float) else value


def differences(df, con, sql: str) -> tuple[list[str], int]:
    found = []
    relation = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} vs {sorted(relation.columns)}"], -1
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    for field in df.schema:
        expected = TYPES.get(kinds[field.name], kinds[field.name])
        if field.dataType.simpleString() != expected:
            found.append(f"type of {field.name}: {field.dataType.simpleString()} vs {expected}")
    mine = sorted((tuple(_plain(v) for v in r) for r in df.select(*names).toArrow().to_pandas().astype(object).where(lambda d: d.notna(), None).itertuples(index=False, name=None)), key=_key)
    theirs = relation.select(*[f'"{n}"' for n in names]).to_arrow_table().to_pandas().astype(object)
    theirs = sorted((tuple(_plain(v) for v in r) for r in theirs.where(theirs.notna(), None).itertuples(index=False, name=None)), key=_key)
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows vs {len(theirs)}")
    else:
        wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
        if wrong:
            found.append(f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]}")
    return found, len(mine)


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    # A session as a stranger would start it: nothing of the library's settings.
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for key, run in queries().items():
        if wanted and key not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if key in sqls:
                problems, rows = differences(df, con, sqls[key])
                if rows == 0 and key not in NORMALLY_EMPTY:
                    problems.append("no rows")
            else:
                problems, rows = [], df.count()
        except Exception as error:  # report and go on with the next query
            problems, rows = [f"{type(error).__name__}: {str(error)[:600]}"], -1
        bad += bool(problems)
        print(f"{'ok  ' if not problems else 'FAIL'} {key} rows={rows} sec={time.time() - start:.2f} {'; '.join(problems)}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())

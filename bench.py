"""Headline queries on the test tables; prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8) choose data and cores.
Every query runs once to warm up and then three times; the median counts. Results go to Spark's
``noop`` sink, so all rows are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402

from wattloom.functions.timestamps import to_epoch_ms  # noqa: E402
from wattloom.operators import aggregates, episodes, staging  # noqa: E402
from wattloom.operators import quality as dq  # noqa: E402
from wattloom.session import build_session, scratch_dir  # noqa: E402
from wattloom.sinks.maintenance import compact  # noqa: E402
from wattloom.sinks.writers import append_curated  # noqa: E402
from wattloom.streaming.ingest import ingest  # noqa: E402
from wattloom.suite.derived import IN_ORDER, hot  # noqa: E402
from wattloom.suite.fixtures import AS_OF, STREAM_SQL, read_stream  # noqa: E402

RUNS = 3


def run_all(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], None], prepare: Callable[[], None] | None = None) -> float:
    taken = []
    for _ in range(RUNS + 1):
        if prepare:
            prepare()
        start = time.perf_counter()
        action()
        taken.append(time.perf_counter() - start)
    return statistics.median(taken[1:])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "wattloom-bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="wattloom-bench-"),
    )
    spark.sparkContext.setLogLevel("OFF")
    # As in practice the streams are curated tables, written once before anything is timed.
    root = scratch_dir(spark, "curated")
    tables = {}
    for name in STREAM_SQL:
        if name == "device_metadata":
            continue
        read_stream(spark, sf_dir, name).repartition(int(cpus)).write.parquet(f"{root}/{name}")
        tables[name] = spark.read.parquet(f"{root}/{name}")
    rows = tables["temperature"].count()

    electrical, state, events = tables["evse_electrical"], tables["evse_state"], tables["evse_session_event"]
    staged = staging.stage_electrical(electrical)
    hot_state = hot(state)  # two thirds of the rows are one device's
    models = {
        "stg_evse_electrical": staged,
        "stg_temperature": staging.stage_temperature(tables["temperature"]),
        "mart_evse_power_daily": aggregates.power_daily(staged),
    }
    checks = dq.standard_checks() + [
        dq.Check(f"electrical_{c}_present", "stg_evse_electrical", dq.missing(c)) for c in ("power_factor", "grid_frequency_hz", "phase")
    ]
    frames: dict[str, Callable[[], DataFrame]] = {
        "mart_evse_power_daily": lambda: aggregates.power_daily(staged),
        "temperature_per_minute": lambda: aggregates.temperature_per_minute(tables["temperature"], as_of=AS_OF),
        "evse_daily_load": lambda: aggregates.daily_load(electrical, as_of=AS_OF),
        "fault_episodes": lambda: episodes.fault_episodes(state),
        "fault_episodes_hot_plain": lambda: episodes.fault_episodes(hot_state, IN_ORDER),
        "fault_episodes_hot_cut": lambda: episodes.fault_episodes(hot_state, IN_ORDER, rows // 20),
        "session_summary": lambda: episodes.session_summary(events),
        "dq_monotonic_partitioned": lambda: dq.not_increasing(electrical, "energy_kwh_total", "timestamp", ["device_id"]),
        "dq_monotonic_global": lambda: dq.not_increasing(electrical, "energy_kwh_total", ["timestamp", "device_id"]),
        "run_checks_fused": lambda: dq.run_checks(models, checks),
    }
    seconds = {name: timed(lambda build=build: run_all(build())) for name, build in frames.items()}

    def one_by_one() -> None:
        for check in checks:
            run_all(dq.run_checks(models, [check]))

    seconds["run_checks_one_by_one"] = timed(one_by_one)

    curated = {}

    def many_files() -> None:
        curated["root"] = scratch_dir(spark, "compact")
        for part in range(6):
            some = tables["temperature"].where(f"pmod(xxhash64(device_id, timestamp), 6) = {part}")
            append_curated(some, curated["root"], "temperature")

    seconds["compact_partitions"] = timed(lambda: compact(spark, f"{curated['root']}/temperature"), many_files)

    landing = scratch_dir(spark, "landing")
    electrical.withColumn("timestamp", to_epoch_ms("timestamp")).write.parquet(f"{landing}/evse_electrical")

    def catch_up() -> None:
        out = scratch_dir(spark, "ingest")
        ingest(spark, landing, "evse_electrical", f"{out}/curated", f"{out}/checkpoint").awaitTermination()

    seconds["stream_ingest_curated"] = timed(partial(catch_up))
    seconds = {name: round(value, 4) for name, value in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").split("sf")[-1],
                "rows_per_stream": rows,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Structured Streaming jobs. A stream lands in three parts, and the job catches up after each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattloom.functions.timestamps import to_epoch_ms
from wattloom.sources.raw import conform
from wattloom.streaming import ingest, latch, windows
from wattloom.suite.derived import ONSETS
from wattloom.suite.registry import avg4, query
from wattloom.suite.aggregates import HOURLY
from wattloom.suite.tables import MS, at_ms

PARTS = (("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", None))


class replaced:
    """The inputs of a run with another way to read a stream."""

    def __init__(self, inputs, read):
        self.spark, self.scratch, self.read = inputs.spark, inputs.scratch, read

    def __call__(self, stream: str):
        return self.read(stream)


def catch_up(s, stream: str, landing: str, start: Callable[[], StreamingQuery], copies: int = 1, late: bool = False, spread: bool = False) -> None:
    """Land each part (``copies`` times), run the job until it has read everything, and stop it.

    Rows without a time land with the first part. With ``late`` every part brings every tenth row of the part before,
    which that part then lacks. With ``spread`` a part's files grow in number with its rows, by device, however few
    row groups the table has; all later steps have as many tasks as there are files.
    """
    raw = s(stream).withColumn("_part", F.lit(0))
    for number, (first, _) in enumerate(PARTS[1:], 1):
        raw = raw.withColumn("_part", F.when(F.col("timestamp") >= F.lit(first).cast("timestamp_ntz"), number).otherwise(F.col("_part")))
    if late:
        held_back = F.pmod(F.xxhash64("timestamp"), F.lit(10)) == 0
        raw = raw.withColumn("_part", F.when(held_back, F.least(F.col("_part") + 1, F.lit(len(PARTS) - 1))).otherwise(F.col("_part")))
    landed = raw.withColumn("timestamp", to_epoch_ms("timestamp"))
    for number in range(len(PARTS)):
        part = landed.where(F.col("_part") == number).drop("_part")
        part = part.hint("rebalance", "device_id") if spread else part
        for _ in range(copies):
            part.write.mode("append").parquet(f"{landing}/{stream}")
        query = start()
        query.processAllAvailable()
        query.stop()


def ingested(s, stream: str, copies: int = 1, late: bool = False, **options):
    """Run the ingest job over a stream and return the curated table."""
    root = s.scratch("ingest")
    landing, curated, checkpoint = f"{root}/landing", f"{root}/curated", f"{root}/checkpoint"
    catch_up(s, stream, landing, lambda: ingest.ingest(s.spark, landing, stream, curated, checkpoint, **options), copies, late)
    return conform(s.spark.read.parquet(f"{curated}/{stream}"), stream)


@query("stream_ingest_curated", f"select {at_ms('evse_electrical')} from evse_electrical", ("evse_electrical",))
def _(s):
    return ingested(s, "evse_electrical")


@query("stream_flush_policy", f"select {at_ms('vibration')} from vibration", ("vibration",))
def _(s):
    return ingested(s, "vibration", copies=1, every="1 second", max_bytes=1 << 15)


@query("stream_bounded_run", f"select {at_ms('evse_session_event')} from evse_session_event", ("evse_session_event",))
def _(s):
    return ingested(s, "evse_session_event", max_files=1)


@query(
    "stream_dedup_replays",
    f"select distinct {at_ms('temperature')} from temperature union all select distinct * replace (null as timestamp) from temperature where accuracy_pct is null",
    ("temperature",),
)
def _(s):
    # Every part lands twice, rows come late by days, and each part brings the same rows without a time.
    def with_untimed(stream):
        rows = s(stream)
        untimed = rows.where("accuracy_pct is null").withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
        return rows.unionAll(untimed).unionAll(untimed)

    return ingested(replaced(s, with_untimed), "temperature", copies=2, late=True, drop_copies=True)


@query(
    "stream_per_minute_trend",
    f"""select date_trunc('minute', timestamp)::timestamp as ts, {avg4("value_celsius")} as avg_temp_c,
 max(value_celsius) as max_temp_c, count(*) as n from temperature group by 1""",
    ("temperature",),
)
def _(s):
    root, live = s.scratch("trend"), windows.temperature_per_minute(scale=4)

    def start() -> StreamingQuery:
        rows = ingest.landing_stream(s.spark, f"{root}/landing", "temperature")
        return windows.keep_current(rows, "temperature", live, f"{root}/out", f"{root}/checkpoint")

    catch_up(s, "temperature", f"{root}/landing", start, late=True)
    windows.fold(s.spark, f"{root}/out", live)
    return windows.read_current(s.spark, f"{root}/out", live)


@query("stream_session_events_hourly", HOURLY.format(where=""), ("evse_session_event",))
def _(s):
    root, live = s.scratch("hourly"), windows.session_events_hourly()

    def start() -> StreamingQuery:
        rows = ingest.landing_stream(s.spark, f"{root}/landing", "evse_session_event")
        return windows.keep_current(rows, "evse_session_event", live, f"{root}/out", f"{root}/checkpoint")

    catch_up(s, "evse_session_event", f"{root}/landing", start, late=True)
    return windows.read_current(s.spark, f"{root}/out", live)


def live_onsets(s, late: bool = False):
    root = s.scratch("onsets")
    history = latch.landed_history(f"{root}/landing", "evse_state", f"{root}/index")

    def start() -> StreamingQuery:
        rows = ingest.landing_stream(s.spark, f"{root}/landing", "evse_state")
        return latch.derate_onsets(rows, f"{root}/out", f"{root}/checkpoint", history)

    catch_up(s, "evse_state", f"{root}/landing", start, late=late, spread=True)
    return latch.read_onsets(s.spark, f"{root}/out")


@query("stream_derate_onset", ONSETS.format(ts=MS), ("evse_state",))
def _(s):
    return live_onsets(s)


@query("stream_derate_onset_late", ONSETS.format(ts=MS), ("evse_state",))
def _(s):
    # Every tenth row of a part comes with the next one, days late.
    return live_onsets(s, late=True)

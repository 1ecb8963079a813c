"""Sources, sinks and table jobs: each query writes the whole streams it names and reads them back."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import partial

from pyspark.sql import functions as F

from wattloom.contracts import STREAMS
from wattloom.functions.timestamps import to_epoch_ms
from wattloom.operators import digests
from wattloom.operators.aggregates import power_daily, rows_per_stream
from wattloom.operators.staging import stage_electrical
from wattloom.plans.models import MODELS, materialize, run_models
from wattloom.sinks import catalog, writers
from wattloom.sinks.maintenance import compact, read_as_of
from wattloom.sinks.publish import at_least_rows, publish
from wattloom.sources.landed import read_indexed, refresh
from wattloom.sources.raw import LAYOUT, conform, read_raw
from wattloom.sources.tables import read_curated, read_device_metadata
from wattloom.suite.aggregates import COUNTS, MART
from wattloom.suite.models import ELECTRICAL, TEMPERATURE, columns
from wattloom.suite.registry import query

MS = "make_timestamp(epoch_us(timestamp) // 1000 * 1000)"
# Batches of the append jobs: before and from this moment.
SPLIT = "2024-01-15 12:00:00"


def at_ms(stream: str) -> str:
    """Column list of a stream after a trip through millisecond timestamps."""
    return ", ".join(f"{MS} as timestamp" if c == "timestamp" else c for c in columns(stream))


def in_two(df):
    """The rows before a moment, with those that have no time, and the others."""
    return df.where((df.timestamp < SPLIT) | df.timestamp.isNull()), df.where(df.timestamp >= SPLIT)


def new_schema(s) -> str:
    schema = f"wattloom_{uuid.uuid4().hex[:12]}"
    catalog.create_schema(s.spark, schema, s.scratch(schema))
    return schema


def landed(s, stream: str) -> str:
    root = s.scratch("landing")
    writers.write_raw(s(stream), root, stream)
    return root


RAW = """select device_id, epoch_us(timestamp) // 1000 as timestamp, value_celsius, unit, accuracy_pct, status,
 cast(year(timestamp) as integer) as year, cast(month(timestamp) as integer) as month, cast(day(timestamp) as integer) as day,
 cast(hour(timestamp) as integer) as hour from temperature"""


@query("scan_raw_stream", RAW, ("temperature",))
def _(s):
    return read_raw(s.spark, landed(s, "temperature"), "temperature")


@query(
    "scan_raw_pruned",
    f"{RAW} where {MS} >= timestamp '2024-01-10 06:00:00' and {MS} < timestamp '2024-01-17 18:30:00'",
    ("temperature",),
)
def _(s):
    return read_raw(
        s.spark, landed(s, "temperature"), "temperature", start="2024-01-10 06:00:00", end="2024-01-17 18:30:00"
    )


def land_untyped(rows, root: str, stream: str) -> None:
    """Land rows by a producer whose NULL columns carry no type: tasks write a file per folder they hold rows of."""

    def write(batches):
        import uuid

        import pyarrow as pa
        import pyarrow.compute
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            for folder in pa.compute.unique(batch["folder"]).to_pylist():
                some = pa.table(batch).filter(pa.compute.equal(batch["folder"], folder)).drop_columns(["folder"])
                for place, name in enumerate(some.column_names):
                    if some[name].null_count == some.num_rows:
                        some = some.set_column(place, name, pa.nulls(some.num_rows))
                system, base = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
                system.create_dir(base, recursive=True)
                pq.write_table(some, f"{base}/{uuid.uuid4().hex}.parquet", filesystem=system)
                yield pa.RecordBatch.from_pydict({"files": pa.array([1])})

    folders = F.concat(F.lit(f"{root}/{stream}/"), F.date_format("timestamp", "'year='y/'month='M/'day='d/'hour='H"))
    landed_rows = rows.withColumn("folder", folders).withColumn("timestamp", to_epoch_ms("timestamp"))
    landed_rows.repartition("folder").mapInArrow(write, "files long").agg(F.sum("files")).collect()


def land_unevenly(s, root: str, index: str) -> None:
    """A stream from three producers: one flushes an hour late, the clock of one is an hour ahead, and one, whose files lack
    the type of a column that is NULL throughout, is on time. The index has seen the first one's files before the others land."""
    typed = s("temperature").where("unit is not null")
    for number, shift in enumerate((1, -1)):
        some = typed.where(f"pmod(xxhash64(device_id), 2) = {number}")
        some = some.withColumn("_hour", F.col("timestamp") + F.expr(f"interval '{shift}' hour"))
        some = some.withColumns({c: F.expr(f"{c}(_hour)") for c in LAYOUT}).drop("_hour")
        some = some.withColumn("timestamp", to_epoch_ms("timestamp")).repartition("year", "month", "day")
        some.write.mode("append").partitionBy(*LAYOUT).parquet(f"{root}/temperature")
        if number == 0:
            refresh(s.spark, root, "temperature", index)
    land_untyped(s("temperature").where("unit is null"), root, "temperature")


@query(
    "scan_raw_indexed",
    f"""select {at_ms("temperature")} from temperature
 where {MS} >= timestamp '2024-01-10 06:00:00' and {MS} < timestamp '2024-01-17 18:30:00'""",
    ("temperature",),
)
def _(s):
    root, index = s.scratch("landing"), s.scratch("index")
    land_unevenly(s, root, index)
    rows = read_indexed(s.spark, root, "temperature", index, start="2024-01-10 06:00:00", end="2024-01-17 18:30:00")
    return conform(rows, "temperature")


@query(
    "raw_index",
    """select cast(extract(hour from timestamp) as integer) as hour, count(*) as rows, min(epoch_us(timestamp) // 1000) as least,
 max(epoch_us(timestamp) // 1000) as greatest, 'unit' as lost from temperature where unit is null group by 1
 union all select cast(extract(hour from timestamp) as integer), count(*), min(epoch_us(timestamp) // 1000), max(epoch_us(timestamp) // 1000), ''
 from temperature where unit is not null group by 1""",
    ("temperature",),
)
def _(s):
    # From the index alone; the typed files are those of the rows' own hours.
    root, index = s.scratch("landing"), s.scratch("index")
    writers.write_raw(s("temperature").where("unit is not null"), root, "temperature")
    land_untyped(s("temperature").where("unit is null"), root, "temperature")
    hour = F.regexp_extract("path", "/hour=([0-9]+)/", 1).cast("int").alias("hour")
    lost = F.when(F.array_contains(F.split("lost", ","), "unit"), "unit").otherwise("").alias("lost")
    found = refresh(s.spark, root, "temperature", index).groupBy(hour, lost)
    return found.agg(F.sum("rows").alias("rows"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))


@query("raw_to_curated_types", f"select {at_ms('evse_session_event')} from evse_session_event", ("evse_session_event",))
def _(s):
    raw = s("evse_session_event").withColumn("timestamp", to_epoch_ms("timestamp"))
    # Columns the producer never fills may be absent from landed files.
    return conform(raw.drop("energy_delivered_kwh", "duration_s", "user_id_hash"), "evse_session_event")


@query("scan_curated", "select *, cast(timestamp as date) as timestamp_day from evse_electrical", ("evse_electrical",))
def _(s):
    root = s.scratch("curated")
    writers.append_curated(s("evse_electrical"), root, "evse_electrical")
    return read_curated(s.spark, "evse_electrical", root)


@query(
    "scan_device_metadata",
    "select * exclude (installed_at_ms), make_timestamp(installed_at_ms * 1000) as installed_at from device_metadata",
    ("device_metadata",),
)
def _(s):
    path = s.scratch("devices")
    s("device_metadata").write.parquet(path)
    return read_device_metadata(s.spark, path)


@query("write_raw_partitioned", f"select {at_ms('humidity')} from humidity", ("humidity",))
def _(s):
    return conform(read_raw(s.spark, landed(s, "humidity"), "humidity"), "humidity")


@query("append_curated_by_day", "select *, cast(timestamp as date) as timestamp_day from vibration", ("vibration",))
def _(s):
    root = s.scratch("curated")
    for batch in in_two(s("vibration")):
        writers.append_curated(batch, root, "vibration")
    return read_curated(s.spark, "vibration", root)


@query("ensure_tables", COUNTS, STREAMS)
def _(s):
    schema = new_schema(s)
    writers.ensure_tables(s.spark, schema)
    writers.ensure_tables(s.spark, schema)
    for stream in STREAMS:
        writers.insert_select(writers.with_day(s(stream)), f"{schema}.{stream}")
    return rows_per_stream({stream: s.spark.table(f"{schema}.{stream}") for stream in STREAMS})


@query("materialize_model", TEMPERATURE.format(max_c=85), ("temperature",))
def _(s):
    model = MODELS["stg_temperature"]
    return materialize(s.spark, model, model.build(s("temperature")), s.scratch("models"))


@query("run_models", f"{MART} select * from mart", ("evse_electrical",))
def _(s):
    models = MODELS | {"mart_evse_power_daily": replace(MODELS["mart_evse_power_daily"], build=partial(power_daily, scale=4))}
    built = run_models(s.spark, s, s.scratch("models"), ["mart_evse_power_daily", "stg_evse_electrical"], models)
    return built["mart_evse_power_daily"]


@query("insert_select", f"{ELECTRICAL.replace('select *', 'select *, cast(timestamp as date) as timestamp_day')}", ("evse_electrical",))
def _(s):
    schema = new_schema(s)
    writers.ensure_tables(s.spark, schema, ["evse_electrical"])
    staged = conform(stage_electrical(s("evse_electrical")), "evse_electrical")
    writers.insert_select(writers.with_day(staged), f"{schema}.evse_electrical")
    return s.spark.table(f"{schema}.evse_electrical")


@query("ctas", "select * from evse_state", ("evse_state",))
def _(s):
    table = f"{new_schema(s)}.evse_state_copy"
    writers.create_table_as(s("evse_state"), table)
    return s.spark.table(table)


@query("write_audit_publish", ELECTRICAL, ("evse_electrical",))
def _(s):
    root, view = s.scratch("published"), f"{new_schema(s)}.evse_electrical_live"
    staged = stage_electrical(s("evse_electrical"))
    good = publish(s.spark, staged, root, view, [at_least_rows("staged", 1)])
    # A version without rows fails its audit and must not replace the first one.
    bad = publish(s.spark, staged.where("power_kw < 0"), root, view, [at_least_rows("staged", 1)])
    if not good.published or bad.published:
        raise RuntimeError("the audit did not decide what was published")
    return s.spark.table(view)


@query("compact_partitions", "select *, cast(timestamp as date) as timestamp_day from temperature", ("temperature",))
def _(s):
    root = s.scratch("curated")
    for batch in in_two(s("temperature")):
        path = writers.append_curated(batch, root, "temperature")
    compact(s.spark, path, since="2024-01-03")
    return read_curated(s.spark, "temperature", root)


@query(
    "compact_replay",
    """select *, cast(timestamp as date) as timestamp_day from (select * from temperature union all
 select * replace (null as timestamp) from temperature where accuracy_pct is null)""",
    ("temperature",),
)
def _(s):
    # Six batches put as many files in every day and in that of the rows without a time; the newest one comes again.
    rows = s("temperature")
    untimed = rows.where("accuracy_pct is null").withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    rows = rows.unionAll(untimed).withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.lit(6)))
    root = s.scratch("curated")
    batches = [rows.where(F.col("_part") == n).drop("_part") for n in range(6)]
    for number, batch in enumerate(batches):
        writers.commit_batch(batch, f"{root}/temperature", number, "2024-02-01 00:00:00")
    compact(s.spark, f"{root}/temperature")
    writers.commit_batch(batches[-1], f"{root}/temperature", 5, "2024-02-01 00:00:00")
    return read_curated(s.spark, "temperature", root)


@query(
    "compact_columns",
    """select *, cast(timestamp as date) as timestamp_day,
 case when accuracy_pct is null then value_celsius end as corrected from temperature""",
    ("temperature",),
)
def _(s):
    # Files with a column more than others: the rows without accuracy came from a later version of the producer.
    root, rows = s.scratch("curated"), s("temperature")
    for part in range(3):
        some = rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(3)) == part)
        writers.append_curated(some.where("accuracy_pct is not null"), root, "temperature")
        path = writers.append_curated(some.where("accuracy_pct is null").withColumn("corrected", F.col("value_celsius")), root, "temperature")
    compact(s.spark, path)
    return s.spark.read.parquet(path).select(*rows.columns, "timestamp_day", "corrected")


def two_sides(s):
    """A stream as two curated tables with stored digests: the second lacks rows of odd days and has corrected others."""
    root, rows, names = s.scratch("sides"), s("temperature"), columns("temperature")
    odd = F.dayofmonth("timestamp") % 2 == 1
    changed = rows.where(F.col("unit").isNotNull() | ~odd | F.col("timestamp").isNull()).withColumn(
        "accuracy_pct", F.when((F.col("accuracy_pct") == 0.07) & (F.hour("timestamp") < 12), 9.5).otherwise(F.col("accuracy_pct"))
    )
    sides, stored = [], []
    for name, side in (("first", rows), ("second", changed)):
        writers.append_curated(side, f"{root}/{name}", "temperature")
        sides.append(read_curated(s.spark, "temperature", f"{root}/{name}"))
        stored.append(digests.read_digests(s.spark, digests.write_digests(sides[-1], f"{root}/digests-{name}", names)))
    return *sides, *stored, names


@query(
    "reconcile_tree",
    """select cast(timestamp as date) as day, cast(hour(timestamp) as integer) as hour, device_id,
 count(*) as only_left, count(*) filter (not gone) as only_right
from (select *, unit is null and day(timestamp) % 2 = 1 as gone from temperature)
where gone or (accuracy_pct = 0.07 and hour(timestamp) < 12) group by 1, 2, 3""",
    ("temperature",),
)
def _(s):
    return digests.differing_keys(*two_sides(s))


@query("read_as_of", f"select *, cast(timestamp as date) as timestamp_day from humidity where timestamp < timestamp '{SPLIT}'", ("humidity",))
def _(s):
    root = s.scratch("curated")
    for number, batch in enumerate(in_two(s("humidity"))):
        path = writers.append_curated(batch, root, "humidity", number, f"2024-02-0{number + 1} 00:00:00")
    return read_as_of(s.spark.read.parquet(path), at="2024-02-01 12:00:00")


@query(
    "reset_namespace",
    " union all ".join(
        f"select '{n}' as stream, {'count(*)' if n == 'temperature' else 'cast(0 as bigint)'} as rows from {n}"
        + ("" if n == "temperature" else " having true")
        for n in STREAMS
    ),
    STREAMS,
)
def _(s):
    schema = new_schema(s)
    writers.ensure_tables(s.spark, schema)
    for stream in ("temperature", "humidity"):
        writers.insert_select(writers.with_day(s(stream)), f"{schema}.{stream}")
    # After the reset only what is loaded again is there.
    catalog.reset_schema(s.spark, schema, s.scratch(schema))
    writers.insert_select(writers.with_day(s("temperature")), f"{schema}.temperature")
    return rows_per_stream({stream: s.spark.table(f"{schema}.{stream}") for stream in STREAMS})

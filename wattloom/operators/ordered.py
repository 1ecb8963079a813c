"""Scans in key and time order: previous row, running totals, runs of equal values.

A window over ``PARTITION BY device ORDER BY time`` puts all rows of a device in one task, which a
device with a large part of all rows does not survive. ``order_rows`` therefore cuts heavy keys into
consecutive pieces at sampled cut points, and ``scan`` works in one ordered pass: windows run per
(key, piece), the first and the last row of each piece carry what the piece adds up to, and these
summaries are combined over the pieces of a key (its last row and total before each piece) and joined
back by broadcast. Summaries are read off the windows' own output, whose shuffle is the one that the
rows take, so the table is read twice: for the sample, and for the pass.

Pieces never outnumber twice the shuffle partitions, which bounds both the cut points and the
broadcast. Cut points are literals in the plan, so a recomputed task sees the same pieces. With no
heavy key the plan is the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.operators.skew import TASK_ROWS, same_keys
from wattloom.session import shuffle_partitions

PIECE = "_piece"
CUT = "_cut"
SAMPLES_PER_PIECE = 160


@dataclass(frozen=True)
class OrderedRows:
    """Rows with their scan order; ``cut`` tells whether the piece columns are present."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    cut: bool

    @property
    def groups(self) -> list[str]:
        return [*self.keys, PIECE] if self.cut else list(self.keys)

    @property
    def window(self) -> WindowSpec:
        # CUT is no window key: a filter on it must not move below the shuffle that both uses of the rows share.
        return Window.partitionBy(*self.groups).orderBy(*self.order)

    def over(self, df: DataFrame) -> OrderedRows:
        return replace(self, df=df)

    def result(self) -> DataFrame:
        return self.df.drop(PIECE, CUT)


@dataclass(frozen=True)
class _Seen:
    """A key in the sample: about how many rows it has, and some of its order values, sorted."""

    key: tuple
    rows: int
    values: list


def _sampled(df: DataFrame, keys: Sequence[str], order: Sequence[str], rate: float, least: int) -> tuple[list[_Seen], int]:
    """Keys of which the sample has more than ``least`` rows, and about how many rows there are in all: one pass.

    Of every ``SAMPLES_PER_PIECE`` sampled values one in eight comes to the driver, so this is bounded by the pieces.
    """
    sample = df.select(*keys, *[c for c in order if c not in keys]) if rate >= 1 else df.where(F.rand(17) < rate)
    total = Observation()
    by_key = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_list(F.struct(*order))).alias("_seen"))
    thin = F.filter("_seen", lambda _, i: i % (SAMPLES_PER_PIECE // 8) == 0)
    found = by_key.observe(total, F.sum("_n").alias("n")).where(F.col("_n") > least).select(*keys, "_n", thin.alias("_seen")).collect()
    seen = [_Seen(tuple(r[k] for k in keys), round(r["_n"] / rate), r["_seen"]) for r in found]
    return seen, round((total.get.get("n") or 0) / rate)


def _cuts(values: list, pieces: int) -> list:
    """Evenly spaced members of sorted values, each once."""
    picked = [values[min(i * len(values) // pieces, len(values) - 1)] for i in range(1, pieces)]
    return [v for v, before in zip(picked, [None, *picked]) if v != before]


def _blocks(cuts: list) -> tuple[list, list]:
    """Cut points as blocks of about their square root, and the first cut point of every block."""
    size = max(1, math.isqrt(len(cuts)))
    blocks = [cuts[i : i + size] for i in range(0, len(cuts), size)]
    return [b[0] for b in blocks], blocks


def _cut_table(df: DataFrame, keys: Sequence[str], order: Sequence[str], found: list[tuple[tuple, list]]) -> tuple[DataFrame, Column]:
    """The cut points per key, and the value of a row they are compared with.

    That value is the leading order column alone, which is cheap to compare, unless one of its
    values fills more than a piece; then rows are told apart by all order columns.
    """
    leading = all(len({c[0] for c in cuts}) == len(cuts) for _, cuts in found)
    if leading:
        kind, value = df.schema[order[0]].dataType, F.col(order[0])
    else:
        kind, value = T.StructType([df.schema[c] for c in order]), F.struct(*order)
    schema = T.StructType(
        [T.StructField(f"_k_{k}", df.schema[k].dataType) for k in keys]
        + [T.StructField("_firsts", T.ArrayType(kind)), T.StructField("_blocks", T.ArrayType(T.ArrayType(kind)))]
    )
    data = [(*key, *_blocks([c[0] for c in cuts] if leading else cuts)) for key, cuts in found]
    return df.sparkSession.createDataFrame(data, schema), value


def _with_piece(df: DataFrame, value: Column) -> DataFrame:
    """Number of cut points at or before ``value``: first the block, then the place inside it.

    A leading NULL sorts first, so it belongs to piece 0, as do rows of keys that are not cut.
    """
    at_or_before = lambda c: c <= value
    # A column of its own, so that the search for the block is evaluated once.
    df = df.withColumn("_block", F.when(F.col("_firsts").isNotNull(), F.size(F.filter("_firsts", at_or_before))).otherwise(0) - 1)
    inside = F.size(F.filter(F.get("_blocks", F.col("_block")), at_or_before))
    number = F.when(F.col("_block") < 0, F.lit(0)).otherwise(F.col("_block") * F.size(F.get("_blocks", F.lit(0))) + inside)
    return df.withColumn(PIECE, number).drop("_firsts", "_blocks", "_block")


def order_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], task_rows: int = TASK_ROWS) -> OrderedRows:
    """Prepare ``df`` for scans in ascending ``order`` within ``keys`` (none: over the whole table).

    ``order`` should be unique within a key; rows that tie in it have no defined order.
    """
    keys, order = tuple(keys), tuple(order)
    parts = shuffle_partitions(df.sparkSession)
    if keys:
        # A rate that does not depend on the number of rows, so that one pass both finds heavy keys and cuts them.
        rate = min(1.0, SAMPLES_PER_PIECE / task_rows)
        seen, rows = _sampled(df, keys, order, rate, task_rows * rate)
        share = max(task_rows, rows // parts)
        found = [(s.key, _cuts(s.values, math.ceil(s.rows / share))) for s in seen if s.rows > share]
    else:
        rows = df.count()
        share = max(1, min(task_rows, math.ceil(rows / parts)), math.ceil(rows / (2 * parts)))
        seen, _ = _sampled(df, keys, order, min(1.0, SAMPLES_PER_PIECE / share), 1) if rows > share else ([], 0)
        found = [((), _cuts(s.values, math.ceil(rows / share))) for s in seen]
    found = [(key, cuts) for key, cuts in found if cuts]
    if not found:
        return OrderedRows(df, keys, order, False)
    table, value = _cut_table(df, keys, order, found)
    if keys:
        placed = df.join(F.broadcast(table), same_keys(df, table, [(k, f"_k_{k}") for k in keys]), "left")
        placed = placed.withColumn(CUT, F.col("_firsts").isNotNull()).drop(*[f"_k_{k}" for k in keys])
    else:
        # Scalar subqueries: evaluated once, then constants for every task.
        placed = df.select("*", table.select("_firsts").scalar().alias("_firsts"), table.select("_blocks").scalar().alias("_blocks"))
        placed = placed.withColumn(CUT, F.col("_firsts").isNotNull())
    return OrderedRows(_with_piece(placed, value), keys, order, True)


Read = Callable[[str], Column]
Step = Callable[[Read, Read, Column], Column]


def _both(a: Column, b: Column) -> Column:
    """A sum that skips NULL."""
    return F.coalesce(a + b, a, b)


def scan(rows: OrderedRows, previous: Mapping[str, str] | None = None, totals: Mapping[str, Step] | None = None) -> OrderedRows:
    """One ordered pass that adds columns of the row before and running totals.

    ``previous`` maps columns to the names under which their value in the previous row is added (NULL in the first row
    of a key). ``totals`` maps names to steps: the total is the sum of the steps up to and including the row, skipping
    NULL. A step gets the previous row, the row, and whether there is no previous row, so a total may depend on pairs
    of neighbours, also where they lie in different pieces.
    """
    previous, totals = previous or {}, totals or {}
    columns = [c for c in rows.df.columns if c not in (PIECE, CUT)]
    upto = rows.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = columns if totals else list(previous)
    seen = rows.df.select(
        "*", F.lag(F.lit(True), 1, False).over(rows.window).alias("_has"), *[F.lag(c).over(rows.window).alias(f"_b_{c}") for c in held]
    )
    before: Read = lambda c: F.col(f"_b_{c}")
    first = ~F.col("_has")
    named = [F.col(f"_b_{c}").alias(name) for c, name in previous.items()]
    if not rows.cut:
        steps = seen.select("*", *[step(before, F.col, first).alias(f"_s_{name}") for name, step in totals.items()])
        summed = [F.sum(f"_s_{name}").over(upto).alias(name) for name in totals]
        return rows.over(steps.select(*columns, *named, *summed))

    # The first row of a piece takes its step when the pieces are combined; elsewhere the row before is at hand.
    own = {
        name: F.when(F.col("_has"), step(before, F.col, F.lit(False))).when(~F.col(CUT), step(before, F.col, F.lit(True)))
        for name, step in totals.items()
    }
    steps = seen.select("*", F.lead(F.lit(False), 1, True).over(rows.window).alias("_last"), *[c.alias(f"_s_{n}") for n, c in own.items()])
    local = steps.select(
        *columns, PIECE, CUT, "_has", "_last", *[f"_b_{c}" for c in previous], *[F.sum(f"_s_{n}").over(upto).alias(f"_t_{n}") for n in totals]
    )

    # Two rows of each piece at most: where it begins, and where it ends, which has the totals of the piece.
    edges = local.where(F.when(F.col(CUT), first | F.col("_last")).otherwise(False))
    ends = F.struct(*columns, *[f"_t_{n}" for n in totals])
    pieces = edges.groupBy(*rows.groups).agg(
        F.first(F.when(first, F.struct(*columns)), ignorenulls=True).alias("_first"), F.first(F.when(F.col("_last"), ends), ignorenulls=True).alias("_end")
    )
    along = Window.partitionBy(*rows.keys).orderBy(PIECE)
    pieces = pieces.select("*", F.lag("_end").over(along).alias("_carry"))
    crossing = {
        name: step(lambda c: F.col("_carry")[c], lambda c: F.col("_first")[c], F.col("_carry").isNull()) for name, step in totals.items()
    }
    pieces = pieces.select("*", *[c.alias(f"_x_{n}") for n, c in crossing.items()])
    sofar, earlier = along.rowsBetween(Window.unboundedPreceding, Window.currentRow), along.rowsBetween(Window.unboundedPreceding, -1)
    offsets = [_both(F.sum(f"_x_{n}").over(sofar), F.sum(F.col("_end")[f"_t_{n}"]).over(earlier)).alias(f"_o_{n}") for n in totals]
    carried = pieces.select(
        *[F.col(g).alias(f"_c_{g}") for g in rows.groups], F.struct(F.lit(True).alias("_"), *[F.col("_carry")[c].alias(c) for c in previous]).alias("_carry"),
        *offsets,
    )

    joined = local.join(F.broadcast(carried), same_keys(local, carried, [(g, f"_c_{g}") for g in rows.groups]), "left")
    named = [F.when(F.col("_has"), F.col(f"_b_{c}")).when(F.col(CUT), F.col("_carry")[c]).alias(name) for c, name in previous.items()]
    summed = [_both(F.col(f"_t_{n}"), F.col(f"_o_{n}")).cast(local.schema[f"_t_{n}"].dataType).alias(n) for n in totals]
    return rows.over(joined.select(*columns, PIECE, CUT, *named, *summed))


def previous_row(rows: OrderedRows, columns: Sequence[str], prefix: str = "prev_") -> OrderedRows:
    """Add each column's value in the previous row, NULL in the first row of a key."""
    return scan(rows, {c: prefix + c for c in columns})


def running_total(rows: OrderedRows, value: str, name: str) -> OrderedRows:
    """Add the sum of ``value`` up to and including the row, skipping NULLs."""
    return scan(rows, totals={name: lambda before, here, first: here(value)})


def number_runs(rows: OrderedRows, columns: Sequence[str], name: str = "run") -> OrderedRows:
    """Number runs of consecutive rows with equal ``columns`` (NULL equals NULL), from 1 per key."""

    def begins(before: Read, here: Read, first: Column) -> Column:
        return reduce(lambda a, c: a | ~here(c).eqNullSafe(before(c)), columns, first).cast("long")

    return scan(rows, totals={name: begins})

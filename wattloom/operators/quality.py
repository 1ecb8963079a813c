"""Data-quality checks. A check returns the violating rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.contracts import allowed_values, required_columns, table_schema
from wattloom.functions.numbers import ratio
from wattloom.functions.timestamps import moment
from wattloom.operators.joins import lookup_join
from wattloom.operators.ordered import order_rows, previous_row
from wattloom.operators.skew import TASK_ROWS

# --- row predicates: true where a row violates the rule -------------------------------------------


def missing_or_not_positive(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) <= 0)


def below(column: str, limit: float) -> Column:
    return F.col(column) < limit


def above(column: str, limit: float) -> Column:
    return F.col(column) > limit


def outside(column: str, low: float, high: float) -> Column:
    return below(column, low) | above(column, high)


def missing(column: str) -> Column:
    return F.col(column).isNull()


def missing_from(column: str, limit: float, guard: str | None = None) -> Column:
    """NULL where ``guard`` exceeds the limit. Without a guard the column itself is compared, which never fires."""
    return (F.col(guard or column) > limit) & F.col(column).isNull()


def stale_or_future(column: str, max_delay: timedelta, as_of: datetime | str | None = None, strict: bool = True) -> Column:
    """Older than ``max_delay`` or later than ``as_of``; the literal form asks for both and never fires."""
    now = moment(as_of)
    stale, future = F.col(column) < now - F.lit(max_delay), F.col(column) > now
    return (stale | future) if strict else (stale & future)


def untrue(expression: str | Column) -> Column:
    """A condition that is false; NULL is not a violation."""
    return ~(F.expr(expression) if isinstance(expression, str) else expression)


def violations(df: DataFrame, predicate: Column) -> DataFrame:
    return df.where(predicate)


# Limits of the electrical and temperature checks.
def electrical_out_of_limits() -> Column:
    return (
        outside("power_kw", 0, 500)
        | outside("voltage_v", 0, 1000)
        | outside("current_a", 0, 500)
        | outside("power_factor", 0.5, 1)
        | outside("temperature_cabinet_c", -40, 150)
    )


def power_implausible(tolerance_low: float = 0.9, tolerance_high: float = 1.1) -> Column:
    """Power far from voltage times current, where both are positive."""
    expected = F.col("voltage_v") * F.col("current_a") / F.lit(1000)
    far = (F.col("power_kw") > expected * tolerance_high) | (F.col("power_kw") < expected * tolerance_low)
    return (F.col("voltage_v") > 0) & (F.col("current_a") > 0) & far


def temperature_out_of_limits(low: float = -40, high: float = 125) -> Column:
    return outside("value_celsius", low, high) | missing("unit")


def mart_implausible(tolerance: float = 0.0) -> Column:
    """``tolerance`` allows for the mean of equal readings exceeding them by a last bit."""
    return (
        (F.col("avg_power_kw") <= 0)
        | (F.col("total_energy_kwh") <= 0)
        | (F.col("avg_power_kw") > F.col("max_power_kw") * (1 + tolerance))
    )


# --- checks over a whole table --------------------------------------------------------------------


def not_increasing(
    df: DataFrame,
    column: str,
    order_by: str | Sequence[str],
    partition_by: Sequence[str] = (),
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Rows whose value is below the one before; without ``partition_by`` the whole table is one sequence."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    needed = df.select(*dict.fromkeys([*partition_by, *order, column]))
    rows = previous_row(order_rows(needed, partition_by, order, task_rows), [column])
    fell = F.col(column) < F.col(f"prev_{column}")
    return rows.result().where(fell).select(*partition_by, column, f"prev_{column}")


def unexpected_row_count(df: DataFrame, expected: int, tolerance: float) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("cnt"))
    return counted.where(outside("cnt", expected * (1 - tolerance), expected * (1 + tolerance)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def null_rate_above(df: DataFrame, column: str, limit: float) -> DataFrame:
    """Total, nulls and rate in one row where the rate exceeds the limit; an empty table passes."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count(F.when(F.col(column).isNull(), F.lit(1))).alias("null_count"),
    )
    rated = counted.withColumn("null_rate", ratio(F.col("null_count"), F.col("total_count")))
    return rated.where(F.col("null_rate") > limit)


def outliers(
    df: DataFrame, column: str, k: float = 3.0, keys: Sequence[str] = ("device_id",), scale: int | None = None, **limits: int
) -> DataFrame:
    """Rows further than ``k`` sample standard deviations from their device's mean.

    With ``scale`` the moments are added as decimals and do not depend on row order.
    """
    if scale is None:
        centre, spread = F.avg(column), F.stddev_samp(column)
    else:
        value = F.col(column).cast(f"decimal(12,{scale})")
        n = F.count(column)
        s1, s2 = F.sum(value).cast("double"), F.sum(value * value).cast("double")
        centre = F.try_divide(s1, n)
        spread = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(s2 - F.try_divide(s1 * s1, n), n - 1)))
    stats = df.groupBy(*keys).agg(centre.alias("mean"), spread.alias("stddev"))
    joined = lookup_join(df.where(F.col(column).isNotNull()), stats, keys, "left", null_safe=True, **limits)
    return joined.where(F.abs(F.col(column) - F.col("mean")) > F.lit(k) * F.col("stddev"))


def validate_contract(df: DataFrame, stream: str) -> DataFrame:
    """Violations per column and rule (missing value, value outside the enumeration), in one pass.

    A required column that the table lacks is missing in all its rows. A column of another type than the contract's
    adds a rule of its own, which all rows violate.
    """
    rules: list[tuple[str, str, Column]] = [
        (c, "required", F.col(c).isNull() if c in df.columns else F.lit(True)) for c in required_columns(stream)
    ]
    rules += [(c, "enum", ~F.col(c).isin(*values)) for c, values in allowed_values(stream).items() if c in df.columns]
    rules += [
        (f.name, "type", F.lit(True))
        for f in table_schema(stream)
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType
    ]
    return count_violations(df, {f"{c}|{rule}": p for c, rule, p in rules}).select(
        F.split_part("name", F.lit("|"), F.lit(1)).alias("column_name"),
        F.split_part("name", F.lit("|"), F.lit(2)).alias("rule"),
        F.col("failures").alias("violations"),
    )


# --- suites ---------------------------------------------------------------------------------------


def count_violations(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """(name, failures) for many row predicates from a single scan."""
    names = list(predicates)
    counted = df.agg(*[F.count(F.when(predicates[n], F.lit(1))).alias(f"c{i}") for i, n in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"c{i}").alias("failures")) for i, n in enumerate(names)])
    return counted.select(F.explode(pairs).alias("r")).select("r.name", "r.failures")


@dataclass(frozen=True)
class Check:
    """A named check on a table: a row predicate, or a function returning violating rows."""

    name: str
    table: str
    rule: Column | Callable[[DataFrame], DataFrame]
    severity: str = "warn"
    tag: str = "daily"


def select_checks(checks: Sequence[Check], tags: Sequence[str] | None = None, names: Sequence[str] | None = None) -> list[Check]:
    """The checks with one of the tags and one of the names, where these are given."""
    return [c for c in checks if (tags is None or c.tag in tags) and (names is None or c.name in names)]


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Report of (name, severity, tag, failures, status), one row per check.

    Row predicates on the same table share one scan. Nothing stops here; the caller decides what a
    failed ``error`` check means.
    """
    parts: list[DataFrame] = []
    for table in dict.fromkeys(c.table for c in checks):
        predicates = {c.name: c.rule for c in checks if c.table == table and isinstance(c.rule, Column)}
        if predicates:
            parts.append(count_violations(tables[table], predicates))
    for check in checks:
        if not isinstance(check.rule, Column):
            found = check.rule(tables[check.table]).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(found.select(F.lit(check.name).alias("name"), "failures"))
    counted = reduce(lambda a, b: a.unionByName(b), parts)
    severity = F.create_map(*[F.lit(v) for c in checks for v in (c.name, c.severity)])
    tag = F.create_map(*[F.lit(v) for c in checks for v in (c.name, c.tag)])
    return counted.select(
        "name",
        severity[F.col("name")].alias("severity"),
        tag[F.col("name")].alias("tag"),
        "failures",
        F.when(F.col("failures") == 0, "pass").when(severity[F.col("name")] == "error", "error").otherwise("warn").alias("status"),
    )


def standard_checks() -> list[Check]:
    """The checks that run daily on the models."""
    return [
        Check("mart_power_positive", "mart_evse_power_daily", mart_implausible()),
        Check("electrical_limits", "stg_evse_electrical", electrical_out_of_limits()),
        Check("electrical_power_plausible", "stg_evse_electrical", power_implausible()),
        Check("temperature_limits", "stg_temperature", temperature_out_of_limits()),
    ]

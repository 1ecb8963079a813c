"""Charging-domain rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Temperature classes (degrees Celsius) and the derating ramp.
HIGH_C = 45.0
CRITICAL_C = 60.0
DERATE_START_C = 45.0
DERATE_FULL_C = 60.0
# Fixed value: percent of derating from which a connector counts as derated.
DERATED_FROM_PCT = 1.0


def temperature_class(celsius: Column, high: float = HIGH_C, critical: float = CRITICAL_C) -> Column:
    return (
        F.when(celsius.isNull(), F.lit(None).cast("string"))
        .when(celsius >= critical, "CRITICAL")
        .when(celsius >= high, "HIGH")
        .otherwise("NORMAL")
    )


def derate_percent(
    cabinet_c: Column,
    active: Column | None = None,
    start: float = DERATE_START_C,
    full: float = DERATE_FULL_C,
    digits: int | None = 1,
) -> Column:
    """Power reduction for a cabinet temperature: none below ``start``, all from ``full``, linear between.

    ``active`` limits it to connectors that charge without a fault.
    """
    if full <= start:
        raise ValueError("full derating needs a higher temperature than its start")
    ramp = (cabinet_c - F.lit(start)) * 100.0 / (full - start)
    if digits is not None:
        ramp = F.round(ramp, digits)
    level = F.when(cabinet_c >= full, F.lit(100.0)).when(cabinet_c >= start, ramp)
    return level if active is None else F.when(active, level)


def _derated(state: Column, derate: Column, limit: float) -> Column:
    return (state == "CHARGING") & (derate >= limit)


def effective_state(state: Column, fault_active: Column, derate: Column, limit: float = DERATED_FROM_PCT) -> Column:
    return F.when(fault_active, "FAULTED").when(_derated(state, derate, limit), "DERATED").otherwise(state)


def electrical_status(state: Column, fault_active: Column, derate: Column, limit: float = DERATED_FROM_PCT) -> Column:
    return (
        F.when(fault_active | (state == "FAULTED"), "FAULTED").when(_derated(state, derate, limit), "DERATED").otherwise("OK")
    )

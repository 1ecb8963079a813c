"""Every operator as a query over the test tables, with the SQL its result is compared with."""

from wattloom.suite.registry import CASES
from wattloom.suite import aggregates, derived, models, quality, scalars, streams, tables  # noqa: F401

__all__ = ["CASES"]

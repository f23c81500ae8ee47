"""Conditional aggregates: several periods or classes in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def counts_where(conditions: Mapping[str, Column], value: Column) -> list[Column]:
    """One non-null count of ``value`` per named condition."""
    return [F.count(F.when(c, value)).alias(name) for name, c in conditions.items()]


def sums_where(conditions: Mapping[str, Column], value: Column, empty_as_zero: bool = False) -> list[Column]:
    """One sum per named condition; without matching rows NULL, or 0 on request."""
    other = F.lit(0) if empty_as_zero else F.lit(None)
    return [F.sum(F.when(c, value).otherwise(other)).alias(name) for name, c in conditions.items()]


def firsts_where(conditions: Mapping[str, Column], value: Column) -> list[Column]:
    """Smallest ``value`` per named condition."""
    return [F.min(F.when(c, value)).alias(name) for name, c in conditions.items()]

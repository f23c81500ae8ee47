"""Registered queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows."""

    def add(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check
        return function

    return add

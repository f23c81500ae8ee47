"""Rows of the latest snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def latest_rows(df: DataFrame, dated: str, scope: DataFrame | None = None) -> DataFrame:
    """Rows dated with the latest date found in ``scope`` (default: the frame itself).

    The date is read first (one small aggregate over the date column) and given to the
    filter as a value, so that the scan of ``df`` skips files and row groups of other dates
    and a table partitioned by date reads one partition. No date found: no rows.
    """
    return on_date(df, dated, (df if scope is None else scope).agg(F.max(dated)).first()[0])


def on_date(df: DataFrame, dated: str, value) -> DataFrame:
    """Rows of ``df`` on the date ``value``, as a literal the scan can use; none for None."""
    return df.where(F.lit(False)) if value is None else df.where(F.col(dated) == F.lit(value))

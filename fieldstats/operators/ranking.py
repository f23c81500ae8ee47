"""Latest, earliest and top-ranked rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark limits each map task to one row per key before the shuffle (window
    group limit), so a key with very many rows stays small. Give an order that
    decides ties.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__position", F.row_number().over(window)).where("__position = 1").drop("__position")


def top_rank_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]]
) -> DataFrame:
    """All rows that share the first rank of their key, ties kept.

    ``order`` holds (column, direction) with direction one of ``asc_nulls_first``,
    ``asc_nulls_last``, ``desc_nulls_first``, ``desc_nulls_last``. The leading
    values of each key are found first; the rows are then matched on key and
    values together, so tied rows never have to meet in one window partition.
    """
    columns = [name for name, _ in order]
    sort = [getattr(F.col(name), direction)() for name, direction in order]
    leading = first_row_per_key(df.select(*keys, *columns), keys, sort)
    leading = leading.select(*[F.col(c).alias(f"__top_{c}") for c in [*keys, *columns]])
    same = [F.col(c).eqNullSafe(F.col(f"__top_{c}")) for c in [*keys, *columns]]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return df.join(leading, condition, "left_semi")

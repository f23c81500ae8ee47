"""Lookup joins, membership and overrides."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F



def cross_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row frame (a global aggregate) to every row.

    The row is always broadcast, whatever its columns hold: Spark takes a global
    aggregate for a few bytes. The caller answers for the size of its text. A frame of
    more than one row fails the query instead of multiplying ``df``.
    """
    rows = F.count(F.lit(1)).over(Window.partitionBy())
    many = F.raise_error(F.lit("cross_one_row: the frame holds more than one row"))
    checked = one_row.withColumn("__rows", rows).where(F.when(F.col("__rows") > 1, many).otherwise(F.lit(True))).drop("__rows")
    return df.crossJoin(F.broadcast(checked))


def keep_members(df: DataFrame, column: str, values: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose column is one of the values: literals of any number, or a one-column frame to join."""
    if not isinstance(values, DataFrame):
        return df.where(F.col(column).isin(list(values)))
    names = values.select(F.col(values.columns[0]).alias("__value"))
    return df.join(names, F.col(column) == F.col("__value"), "left_semi")


def drop_members(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose column is known and none of the values; a NULL among the values keeps no row, as NOT IN has it."""
    return df.where(~F.col(column).isin(list(values)))


def override_table(spark: SparkSession, rows: Iterable[tuple], keys: Sequence[str], value: str) -> DataFrame:
    """Overrides as a frame with one row per key; the first entry of a key wins."""
    first: dict[tuple, str] = {}
    for *key, new in rows:
        first.setdefault(tuple(key), new)
    fields = ", ".join(f"{name} string" for name in (*keys, value))
    return spark.createDataFrame([(*key, new) for key, new in first.items()], fields)


def with_overrides(
    df: DataFrame, name: str, default: Column, overrides: Sequence[tuple[DataFrame, Sequence[str], str]]
) -> DataFrame:
    """Column ``name``: the first override found for the row's keys, else the default.

    Each override is (frame, key columns, value column). Keys are made unique
    here (smallest value), so an override can never multiply rows.
    """
    chosen: list[Column] = []
    for i, (frame, keys, value) in enumerate(overrides):
        unique = frame.groupBy(*[F.col(k).alias(f"__k{i}_{k}") for k in keys]).agg(F.min(value).alias(f"__new{i}"))
        match = F.lit(True)
        for k in keys:
            match = match & (F.col(k) == F.col(f"__k{i}_{k}"))
        df = df.join(unique, match, "left")
        chosen.append(F.col(f"__new{i}"))
    df = df.withColumn(name, F.coalesce(*chosen, default) if chosen else default)
    extra = [c for c in df.columns if c.startswith(("__k", "__new"))]
    return df.drop(*extra)


def key_report(
    name: str,
    rows: DataFrame,
    keys: Sequence[str],
    parent: DataFrame | None = None,
    parent_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Uniqueness and foreign-key counters of a keyed lookup table, as one row.

    Columns: table_name; rows; null_keys (rows with a null in a key column, which a join
    never matches); distinct_keys and repeated_keys (keys listed once or more, and more than
    once); extra_rows (rows beyond the first of each key: what a join on the table would
    multiply); orphan_keys (known keys the parent does not hold; null without a parent).
    An empty table gives one row of zeros.

    One pass: the rows are grouped on their keys (partially before the shuffle), the
    grouped keys meet the parent's distinct keys in one join, and a global aggregate counts.
    Keys are renamed inside, so the tables may hold columns of any other names.
    """
    parent_keys = list(parent_keys or keys)
    if parent is not None and len(parent_keys) != len(keys):
        raise ValueError("key_report: the parent needs as many key columns as the table")
    renamed = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]
    unknown = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    grouped = rows.groupBy(unknown.alias("__null"), *renamed).agg(F.count(F.lit(1)).alias("__n"))
    known = ~F.col("__null")
    if parent is None:
        orphans = F.lit(None).cast("long")
    else:
        held = parent.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(parent_keys)]).distinct()
        grouped = grouped.join(held.withColumn("__held", F.lit(True)), [f"__k{i}" for i in range(len(keys))], "left")
        orphans = F.count(F.when(known & F.col("__held").isNull(), 1))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return grouped.agg(
        total(F.col("__n")).alias("rows"),
        total(F.when(F.col("__null"), F.col("__n"))).alias("null_keys"),
        F.count(F.when(known, 1)).cast("long").alias("distinct_keys"),
        F.count(F.when(known & (F.col("__n") > 1), 1)).cast("long").alias("repeated_keys"),
        total(F.when(known & (F.col("__n") > 1), F.col("__n") - 1)).alias("extra_rows"),
        orphans.cast("long").alias("orphan_keys"),
    ).select(F.lit(name).alias("table_name"), "*")

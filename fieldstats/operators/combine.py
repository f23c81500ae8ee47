"""Unions and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def fit_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the schema, in order and type; absent ones are typed NULLs."""
    present = {name.lower() for name in df.columns}
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def union_to_schema(branches: Sequence[DataFrame], schema: StructType) -> DataFrame:
    """Union of unlike branches, each padded to one declared schema."""
    return reduce(DataFrame.unionByName, [fit_to_schema(b, schema) for b in branches])


def concat_by_name(branches: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing in a branch becomes NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in values], name, value)

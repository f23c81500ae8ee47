"""Ordered lists of distinct values, as text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstats.session import scratch_path

#: Members on a page of ``paged_lists``.
PAGE_SIZE = 100


def distinct_lists(
    df: DataFrame,
    keys: Sequence[str],
    lists: Mapping[str, str],
    separator: str = ", ",
    descending: bool = False,
) -> DataFrame:
    """Per key, one sorted text list of the distinct values of each column.

    ``lists`` maps output name to input column. Duplicates are removed before
    any list is formed, with the value as part of the shuffle key, so a key that
    holds most rows only ever brings its distinct values together. A key (or,
    without keys, the whole input) with no values has a NULL list.
    """
    tagged = F.array(
        *[
            F.struct(F.lit(i).alias("slot"), F.col(column).cast("string").alias("item"))
            for i, column in enumerate(lists.values())
        ]
    )
    values = df.select(*keys, F.explode(tagged).alias("tagged")).select(*keys, "tagged.*").distinct()

    def as_text(slot: int) -> Column:
        items = F.collect_list(F.when(F.col("slot") == slot, F.col("item")))
        ordered = F.array_join(F.sort_array(items, asc=not descending), separator)
        return F.when(F.size(items) > 0, ordered)

    return values.groupBy(*keys).agg(*[as_text(i).alias(name) for i, name in enumerate(lists)])


def paged_lists(df: DataFrame, keys: Sequence[str], member: str, page_size: int = PAGE_SIZE, separator: str = ", ") -> DataFrame:
    """(keys..., page, members, text): each key's distinct members in ascending order, cut into pages.

    Members are compared as text; null members are left out, null keys are a key of their
    own. Pages are numbered from 0 and hold ``page_size`` members, the last one fewer; text
    joins a page's members with ``separator``. An empty table gives no rows.

    No key's members meet in one task: the distinct rows are range-sorted over all
    partitions (and written to the shared scratch folder, so the numbering is read from one
    fixed layout), each partition counts its members per key, a running sum over those few
    counts gives every partition's offset within its key, and a member's number is that
    offset plus its place in its partition. Only a page is gathered into one text.
    """
    spark = df.sparkSession
    names = [f"__key{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], F.col(f"`{member}`").cast("string").alias("__m"))
    ranged = rows.where(F.col("__m").isNotNull()).distinct().repartitionByRange(*names, "__m").withColumn("__part", F.spark_partition_id())
    path = scratch_path(spark, "pages")
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    counts = ranged.groupBy("__part", *names).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*names).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("__part").alias("__opart"), *[F.col(n).alias(f"__o{n}") for n in names], F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    numbered = ranged.withColumn("__k", F.row_number().over(Window.partitionBy("__part", *names).orderBy("__m")))
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__o{n}")) for n in names], F.col("__part") == F.col("__opart"))
    numbered = numbered.join(offsets, same)
    page = F.floor((F.col("__before") + F.col("__k") - 1) / page_size).cast("long").alias("page")
    pages = numbered.groupBy(*names, page).agg(F.array_sort(F.collect_list("__m")).alias("__ms"))
    return pages.select(
        *[F.col(n).alias(k) for n, k in zip(names, keys)], "page", F.size("__ms").cast("long").alias("members"), F.array_join("__ms", separator).alias("text")
    )

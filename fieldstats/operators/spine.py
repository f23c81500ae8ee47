"""Entity-by-quarter spines without Cartesian products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstats.functions.dates import index_key


def calendar_spine(entities: DataFrame, first_index: int, last_index: int) -> DataFrame:
    """Every entity row in every quarter of a fixed range."""
    quarters = F.sequence(F.lit(first_index), F.lit(last_index))
    return entities.withColumn("quarter_index", F.explode(quarters)).withColumn(
        "quarter", index_key(F.col("quarter_index"))
    )


def activity_spine(entities: DataFrame, first_index: Column, floor_index: int, last_index: int) -> DataFrame:
    """Every entity in each quarter from its first activity (or the floor) on; never-active ones have none."""
    start = F.greatest(first_index, F.lit(floor_index))
    return (
        entities.where(first_index.isNotNull() & (start <= last_index))
        .withColumn("quarter_index", F.explode(F.sequence(start, F.lit(last_index))))
        .withColumn("quarter", index_key(F.col("quarter_index")))
    )


def fill_gaps(quarterly: DataFrame, entity: str, last_index: int, measures: list[str]) -> DataFrame:
    """Insert the missing quarters after each entity's first one.

    Input has one row per entity and ``quarter_index``. Each row is repeated up
    to the entity's next row (or the last quarter); repeats carry NULL measures.
    One shuffle on the entity, which the following windows share.
    """
    window = Window.partitionBy(entity).orderBy("quarter_index")
    until = F.coalesce(F.lead("quarter_index").over(window) - 1, F.lit(last_index))
    others = [c for c in quarterly.columns if c not in (*measures, "quarter_index")]
    return (
        quarterly.where(F.col("quarter_index") <= last_index)
        .withColumn("__until", until)
        .select(
            *others,
            *measures,
            F.posexplode(F.sequence("quarter_index", "__until")).alias("__step", "quarter_index"),
        )
        .select(
            *others,
            "quarter_index",
            *[F.when(F.col("__step") == 0, F.col(m)).alias(m) for m in measures],
        )
    )

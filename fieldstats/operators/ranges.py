"""Period and range joins in forms that stay linear in the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trailing_sum(entity: str, value: Column, quarters: int = 4) -> Column:
    """Sum over this quarter and those before it, by quarter distance."""
    window = Window.partitionBy(entity).orderBy("quarter_index").rangeBetween(-(quarters - 1), 0)
    return F.sum(value).over(window)


def count_year_before(
    anchors: DataFrame,
    facts: DataFrame,
    key: str,
    anchor: str,
    fact_date: str,
    fact_id: str,
    alias: str,
) -> DataFrame:
    """Append to each anchor row the facts of its key in the year before it.

    A fact counts from the same day one year earlier up to the day before the
    anchor. By prefix sums: facts counted per key and day, and each distinct anchor
    date with its date a year before, are one union; a running sum of facts per key
    in day order (dates before the facts of the same day) gives every date the facts
    before it, and an anchor's count is the difference of its two dates. A key's
    window holds one row per day and per date asked, never facts times anchors.
    Null keys, anchors or days count nothing.
    """
    day = F.to_date(fact_date)
    daily = (
        facts.where(F.col(key).isNotNull() & day.isNotNull())
        .groupBy(F.col(key).alias("__key"), day.alias("__day"))
        .agg(F.count(fact_id).alias("__facts"))
        .select("__key", "__day", F.lit(1).alias("__kind"), "__facts", F.lit(None).cast("date").alias("__anchor"))
    )
    dates = anchors.where(F.col(key).isNotNull() & F.col(anchor).isNotNull()).select(F.col(key).alias("__key"), F.col(anchor).alias("__anchor")).distinct()
    asked = dates.select(
        "__key",
        F.explode(F.array(F.col("__anchor"), F.add_months("__anchor", -12))).alias("__day"),
        F.lit(0).alias("__kind"),
        F.lit(0).cast("bigint").alias("__facts"),
        "__anchor",
    )
    order = Window.partitionBy("__key").orderBy("__day", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = daily.unionByName(asked).withColumn("__before", F.sum("__facts").over(order)).where(F.col("__kind") == 0)
    sign = F.when(F.col("__day") == F.col("__anchor"), 1).otherwise(-1)
    counted = before.groupBy("__key", "__anchor").agg(F.sum(sign * F.col("__before")).alias(alias))
    same = anchors[key].eqNullSafe(counted["__key"]) & anchors[anchor].eqNullSafe(counted["__anchor"])
    joined = anchors.join(counted, same, "left").drop("__key", "__anchor")
    return joined.withColumn(alias, F.coalesce(F.col(alias), F.lit(0)).cast("bigint"))


def as_prior_period(df: DataFrame, index: str, renames: dict[str, str]) -> DataFrame:
    """The same rows dated one period later, to be joined as "previous period"."""
    shifted = df.withColumn(index, F.col(index) + 1)
    for old, new in renames.items():
        shifted = shifted.withColumnRenamed(old, new)
    return shifted

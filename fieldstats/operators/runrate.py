"""Projection of the running quarter to its full length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstats.params import JobParams


def run_rate_calendar(spark: SparkSession, params: JobParams, holidays: DataFrame | None = None) -> DataFrame:
    """One row: last updated day, working days of the quarter, and those so far.

    Working days are Monday to Friday without the days of ``holidays`` (one
    date column). "So far" ends with the weekly cutoff.
    """
    last_day = F.date_sub(F.lit(params.next_quarter_first), 1)
    days = spark.range(0, 1, 1, 1).select(F.explode(F.sequence(F.lit(params.quarter_first), last_day)).alias("day"))
    days = days.where(~F.dayofweek("day").isin(1, 7))
    if holidays is not None:
        closed = holidays.select(F.to_date(holidays.columns[0]).alias("__closed"))
        days = days.join(closed, F.col("day") == F.col("__closed"), "left_anti")
    cutoff = F.lit(params.week_cutoff)
    return days.agg(
        F.max(cutoff).alias("lastupdateday"),
        F.count("day").alias("workingday"),
        F.count(F.when(F.col("day") <= cutoff, 1)).alias("dayssofar"),
    )


def projected(count: Column) -> Column:
    """A count so far, projected to the end of the quarter; NULL before any working day."""
    return F.try_divide(count.cast("double"), F.col("dayssofar")) * F.col("workingday")


def case_periods(params: JobParams, case_date: Column, status: Column) -> tuple[Column, Column]:
    """Two conditions on a completed case: in the running quarter so far, or earlier.

    The comparison with the running quarter looks at the quarter number alone, so
    a case of a later year in a smaller quarter also counts as earlier.
    """
    done = status == params.completed
    quarter = (params.as_of.month - 1) // 3 + 1
    running = (
        (case_date <= F.lit(params.week_cutoff))
        & (F.quarter(case_date) == quarter)
        & (F.year(case_date) == params.as_of.year)
    )
    earlier = (F.year(case_date) < params.as_of.year) | (F.quarter(case_date) < quarter)
    return running & done, earlier & done


def case_volume(params: JobParams, case_date: Column, status: Column) -> Column:
    """Weight of one case: projected in the running quarter, 1 earlier, else 0."""
    running, earlier = case_periods(params, case_date, status)
    return F.when(running, projected(F.lit(1))).when(earlier, F.lit(1.0)).otherwise(F.lit(0.0))

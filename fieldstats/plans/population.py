"""Surgeon population by quarter and its shift over the last four quarters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldstats.functions.dates import index_key, quarter_index
from fieldstats.operators.lookup import cross_one_row
from fieldstats.operators.pivots import counts_where, firsts_where
from fieldstats.operators.ranges import trailing_sum
from fieldstats.operators.runrate import projected, run_rate_calendar
from fieldstats.operators.spine import fill_gaps
from fieldstats.operators.tiers import (
    DETAILED_TIERS,
    MODEL_TIERS,
    POPULATION_TIERS,
    activity_tier,
    earlier,
    is_stalled,
)
from fieldstats.params import JobParams


def quarterly_activity(tables: Mapping[str, DataFrame], params: JobParams, count_scope: str = "global") -> DataFrame:
    """One row per surgeon and quarter with completed hospital cases.

    ``first*`` and ``n_region`` cover cases with a summary row in the region (once
    per such row); the ``n_quarter*`` counts cover all cases up to the weekly
    cutoff, or those of the region with ``count_scope="region"``. Everything
    comes from one pass over the cases.
    """
    hospitals = tables["account"].where(F.col("recordtype") == params.record_type).select("accountguid")
    regional = (
        tables["procedure_summary"]
        .where(F.col("clinicalregion") == params.region)
        .groupBy("casenumber")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    cases = (
        tables["procedures"]
        .where((F.col("status") == params.completed) & F.col("proceduredatelocal").isNotNull())
        .join(hospitals, "accountguid", "left_semi")
        .select("casenumber", "recordid", "surgeonguid", "systemmodel", "proceduredatelocal")
        .join(regional, "casenumber", "left")
    )
    day = F.col("proceduredatelocal")
    in_region = F.col("weight").isNotNull()
    counted = day <= F.lit(params.week_cutoff)
    if count_scope == "region":
        counted = counted & in_region
    of_model = {label: F.col("systemmodel") == value for label, value in params.models}
    has_id = F.col("recordid").isNotNull()
    return cases.groupBy("surgeonguid", quarter_index(day).alias("quarter_index")).agg(
        F.sum(F.when(in_region & has_id, F.col("weight"))).alias("n_region"),
        F.count(F.when(counted, 1)).alias("n_rows"),
        *firsts_where({"first": in_region, **{f"first_{m}": in_region & c for m, c in of_model.items()}}, day),
        *counts_where(
            {"n_quarter": counted, **{f"n_quarter_{m}": counted & c for m, c in of_model.items()}},
            F.col("recordid"),
        ),
    )


def population_by_quarter(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    params: JobParams,
    calendar: DataFrame | None = None,
    count_scope: str = "global",
) -> DataFrame:
    """Tiers, lags and ever-active flags per surgeon and quarter, without lookups."""
    labels = [label for label, _ in params.models]
    suffixes = ["", *[f"_{label}" for label in labels]]
    ordered = Window.partitionBy("surgeonguid").orderBy("quarter_index")
    # the same order as all other windows, so one sort serves them
    all_quarters = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = [f"n_quarter{s}" for s in suffixes]

    rows = quarterly_activity(tables, params, count_scope)
    rows = rows.select(
        "surgeonguid",
        "quarter_index",
        "n_region",
        *[F.when(F.col("n_rows") > 0, F.col(c)).alias(c) for c in counts],
        *[F.min(f"first{s}").over(all_quarters).alias(f"first{s}") for s in suffixes],
    ).where(F.col("quarter_index") >= quarter_index(F.col("first")))
    rows = fill_gaps(rows, "surgeonguid", params.quarter_index, ["n_region", *counts])
    rows = rows.withColumn("past_year", F.coalesce(trailing_sum("surgeonguid", F.col("n_region")), F.lit(0)))
    rows = rows.where(F.col("quarter_index") >= params.floor_index)

    rows = cross_one_row(rows, run_rate_calendar(spark, params) if calendar is None else calendar)
    running = F.col("quarter_index") == params.quarter_index
    rows = rows.withColumns(
        {c: F.when(running, projected(F.col(c))).otherwise(F.col(c).cast("double")) for c in counts}
    )

    tier = {f"tier{s}": activity_tier(F.col(f"n_quarter{s}"), MODEL_TIERS if s else POPULATION_TIERS) for s in suffixes}
    rows = rows.withColumns({**tier, "detailed": activity_tier(F.col("n_quarter"), DETAILED_TIERS)})
    quarter = F.col("quarter_index")
    name = "SurgeonPopulation"
    return rows.select(
        F.col("surgeonguid").alias("SurgeonGUID"),
        index_key(quarter).alias("Quarter"),
        F.col("n_quarter").alias("QuarterProcedureCount"),
        F.col("past_year").alias("Past 1 Year Procedures"),
        F.col("tier").alias(name),
        *[earlier(F.col(f"tier{s}"), 1, ordered).alias(f"-1 Quarter {name}{s}") for s in suffixes],
        *[earlier(F.col("tier"), n, ordered).alias(f"-{n} Quarter {name}") for n in (2, 3, 4)],
        F.col("detailed").alias(f"Detailed{name}"),
        *[earlier(F.col("detailed"), n, ordered).alias(f"-{n} Quarter Detailed{name}") for n in (1, 2, 3, 4)],
        F.when(is_stalled(F.col("n_quarter")), "Stalled").otherwise("Non Stalled").alias("Stalled"),
        *[
            F.when(quarter_index(F.col(f"first{s}")) <= quarter, 1).otherwise(0).alias(f"exist_flg{s}")
            for s in suffixes
        ],
    )


def population_shift(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    params: JobParams,
    calendar: DataFrame | None = None,
    count_scope: str = "global",
) -> DataFrame:
    """The full product: population by quarter with surgeon, account and team names.

    Lags are taken before the lookups, so several team rows per account repeat
    rows but cannot disturb the order of quarters.
    """
    surgeons = (
        tables["contact"]
        .select("contactguid", "fullname", "specialtyname", "surgeoncategory", "accountguid")
        .join(
            tables["account"]
            .where(F.col("recordtype") == params.record_type)
            .select("accountguid", "accountname", "customertype", "clinicalregion"),
            "accountguid",
        )
        .join(
            tables["account_team"].select("accountguid", "csdname", "csmname", "csrname", "ssmname"),
            "accountguid",
            "left",
        )
        .select(
            F.col("contactguid").alias("SurgeonGUID"),
            F.col("fullname").alias("SurgeonName"),
            F.col("specialtyname").alias("SurgeonSpeciality"),
            F.col("surgeoncategory").alias("SurgeonCategory"),
            F.col("accountguid").alias("AccountGUID"),
            F.col("accountname").alias("AccountName"),
            F.col("customertype").alias("CustomerType"),
            F.col("clinicalregion").alias("ClinicalRegion"),
            F.col("csdname").alias("CSDName"),
            F.col("csmname").alias("CSMName"),
            F.col("csrname").alias("CSRName"),
            F.col("ssmname").alias("SSMName"),
        )
    )
    return population_by_quarter(spark, tables, params, calendar, count_scope).join(surgeons, "SurgeonGUID")

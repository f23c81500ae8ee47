"""Yearly market size from statistics responses and a wide record sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstats.functions.text import SUBTOTAL_PATTERN, leading_code, plain_integer, stripped, without_match
from fieldstats.operators.combine import concat_by_name, wide_to_long
from fieldstats.sources.readers import TOTAL_CLASS, response_items

KEYS = ["Source", "Year", "Code", "DRG_Name"]


def counts_from_responses(responses: DataFrame, codes: DataFrame, total_class: str = TOTAL_CLASS) -> DataFrame:
    """Patients per year and code from landed responses; only total rows count.

    ``responses`` holds year, code and body; ``codes`` holds code and name.
    """
    totals = response_items(responses).where(F.col("class_name") == total_class)
    return (
        totals.groupBy("year", "code")
        .agg(F.sum("patients").alias("HIRA_Patients"))
        .join(codes, "code")
        .where(F.col("name").isNotNull())
        .groupBy(F.lit("HIRA").alias("Source"), F.col("year").alias("Year"), F.col("code").alias("Code"), F.col("name").alias("DRG_Name"))
        .agg(F.sum("HIRA_Patients").alias("HIRA_Patients"))
    )


def counts_from_sheet(record: DataFrame, code_map: DataFrame) -> DataFrame:
    """Patients per year and code from a wide sheet: label second, one column per year after.

    ``code_map`` holds code and name; a code listed twice repeats its rows.
    """
    label, years = F.col(f"`{record.columns[1]}`"), record.columns[2:]
    names = code_map.select(stripped(F.upper("code")).alias("Code"), F.col("name").alias("DRG_Name"))
    rows = record.where(without_match(label, SUBTOTAL_PATTERN)).withColumn("Code", leading_code(label))
    long = wide_to_long(rows.where(F.col("Code").isNotNull()), ["Code"], years, "Year", "Patients")
    number = plain_integer(F.col("Patients"), strict=False)
    # summed before the codes are looked up; a cell that is no number counts against its
    # code only, and raises only where the code is listed
    summed = long.groupBy(F.col("Year").cast("int").alias("Year"), "Code").agg(
        F.sum(number).alias("KOSIS_Patients"),
        F.min(F.when(number.isNull(), F.coalesce("Patients", F.lit("(blank)")))).alias("bad_cell"),
    )
    yearly = summed.join(names.select("Code"), "Code", "left_semi").select(
        "Year",
        "Code",
        F.when(F.col("bad_cell").isNull(), F.col("KOSIS_Patients"))
        .otherwise(F.raise_error(F.concat(F.lit("no number: "), "bad_cell")))
        .alias("KOSIS_Patients"),
    )
    return yearly.join(names, "Code", "left").select(
        F.lit("DRG").alias("Source"),
        "Year",
        "Code",
        "DRG_Name",
        F.lit(0).cast("bigint").alias("HIRA_Patients"),
        "KOSIS_Patients",
    )


def market_total(*parts: DataFrame) -> DataFrame:
    """Both sources in one frame, summed per key; rows with a missing key part drop out."""
    known = F.lit(True)
    for key in KEYS:
        known = known & F.col(key).isNotNull()

    def total(column: str):
        return F.coalesce(F.sum(column), F.lit(0)).alias(column)

    return (
        concat_by_name(parts)
        .where(known)
        .groupBy(*KEYS)
        .agg(total("HIRA_Patients"), total("KOSIS_Patients"))
        .withColumn("TotalPatients", F.col("HIRA_Patients") + F.col("KOSIS_Patients"))
    )


def first_rows(total: DataFrame, n: int = 10) -> DataFrame:
    """The first rows in key order, for a printed check."""
    return total.orderBy(*KEYS).limit(n)

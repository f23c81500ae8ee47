"""Tables, exported sheets and landed statistics responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstats.functions.text import stripped

# Field names of the statistics service's answers.
_ENVELOPE = T.StructType().add(
    "response", T.StructType().add("body", T.StructType().add("items", T.StructType().add("item", "string")))
)
_ITEMS = T.ArrayType(T.StructType().add("diagCdNm", "string").add("ptntCnt", "string"))
TOTAL_CLASS = "계"
# Headers of code and name in the code-map sheet.
CODE_MAP_COLUMNS = ("질병군분류(2)", "DRG(포괄수가제 행위 코드)")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table, with the schema its files have now."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """An exported sheet with a header line; every column is text.

    Cells may be quoted and then hold line breaks and doubled quotes.
    """
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"')


def find_column(columns: Sequence[str], token: str, position: int = 0) -> str:
    """First column whose name contains the token, else the one at a position."""
    for column in columns:
        if token in column.lower():
            return column
    return columns[min(position, len(columns) - 1)]


def matching_codes(sheet: DataFrame) -> DataFrame:
    """(code, name) of a matching sheet, found by header."""
    return sheet.select(
        F.col(f"`{find_column(sheet.columns, 'code', 0)}`").alias("code"),
        F.col(f"`{find_column(sheet.columns, 'subject', 1)}`").alias("name"),
    )


def code_map(sheet: DataFrame, columns: tuple[str, str] = CODE_MAP_COLUMNS) -> DataFrame:
    """(code, name) of a code-map sheet, from two named columns."""
    code, name = columns
    return sheet.select(F.col(f"`{code}`").alias("code"), F.col(f"`{name}`").alias("name"))


def joined_codes(codes: DataFrame) -> DataFrame:
    """(code,) of a sheet's codes compared as the joins do: trimmed and upper-cased."""
    return codes.select(stripped(F.upper("code")).alias("code"))


def repeated_codes(codes: DataFrame) -> DataFrame:
    """(code, n) of the codes that a sheet lists more than once, compared as the joins do."""
    cleaned = joined_codes(codes).where(F.col("code").isNotNull())
    return cleaned.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def read_responses(spark: SparkSession, path: str, replay: str | None = None) -> DataFrame:
    """Landed responses, one JSON line each: ``{"year", "code", "body"}``.

    ``replay``: a quarantine table (see ``quarantined``) whose bodies were mended; its rows
    are read as landed responses too.
    """
    landed = spark.read.schema("year int, code string, body string").json(path)
    if replay is None:
        return landed
    return landed.unionByName(spark.read.parquet(replay).select("year", "code", "body"))


def quarantined(responses: DataFrame, body: str = "body") -> DataFrame:
    """The responses whose items cannot be read, with the other columns, ``reason`` and the body.

    Reasons: ``no body`` (null), ``not json``, ``no items`` (the path to the items is
    missing or null), ``unreadable items`` (items that are no object or list of objects).
    These are the rows ``response_items`` skips and ``response_quality`` counts.
    """
    text = F.from_json(F.col(body), _ENVELOPE)["response"]["body"]["items"]["item"]
    items = F.from_json(text, _ITEMS)
    reason = (
        F.when(F.col(body).isNull(), "no body")
        .when(F.get_json_object(F.col(body), "$").isNull(), "not json")
        .when(text.isNull(), "no items")
        .otherwise("unreadable items")
    )
    kept = [c for c in responses.columns if c != body]
    return responses.where(items.isNull()).select(*kept, reason.alias("reason"), F.col(body))


def response_items(responses: DataFrame, body: str = "body") -> DataFrame:
    """One row per item of each response body.

    ``item`` may hold a list or a single object. Bodies that cannot be read give
    no row; a missing count is 0, a count that is no number raises.
    """
    text = F.from_json(F.col(body), _ENVELOPE)["response"]["body"]["items"]["item"]
    kept = [c for c in responses.columns if c != body]
    return responses.select(*kept, F.explode(F.from_json(text, _ITEMS)).alias("item")).select(
        *kept,
        F.col("item.diagCdNm").alias("class_name"),
        F.coalesce(F.col("item.ptntCnt"), F.lit("0")).cast("int").alias("patients"),
    )


def response_quality(responses: DataFrame, body: str = "body") -> DataFrame:
    """One row: how many responses were landed and how many have no readable items."""
    text = F.from_json(F.col(body), _ENVELOPE)["response"]["body"]["items"]["item"]
    items = F.from_json(text, _ITEMS)
    return responses.agg(
        F.count(F.lit(1)).alias("responses"),
        F.count(F.when(items.isNull(), 1)).alias("unreadable"),
    )

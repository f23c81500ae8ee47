"""Small helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workload.bindings import PARAMS

DIGITS = 4


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column, since the order of summation shows in last digits."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def order_day() -> Column:
    return F.to_date("o_orderdate")


def ship_day() -> Column:
    return F.to_date("l_shipdate")


# Literals of the run date for the SQL checks.
AS_OF = f"date '{PARAMS.as_of}'"
EXTRACTED_AT = f"timestamp '{PARAMS.extract_stamp.isoformat(sep=' ')}'"
QUARTER_FIRST = f"date '{PARAMS.quarter_first}'"
NEXT_QUARTER = f"date '{PARAMS.next_quarter_first}'"
PREVIOUS_QUARTER = f"date '{PARAMS.previous_quarter_first}'"
CUTOFF = f"date '{PARAMS.week_cutoff}'"
REGION = f"'{PARAMS.region}'"

# One row of working days, counted day by day.
CALENDAR = f"""(select {CUTOFF} as lastupdateday, count(*) as workingday,
   count(*) filter (where d <= {CUTOFF}) as dayssofar
  from (select cast(g as date) as d from generate_series(timestamp '{PARAMS.quarter_first}',
          timestamp '{PARAMS.next_quarter_first}' - interval 1 day, interval 1 day) t(g)) days
  where dayofweek(d) between 1 and 5)"""


def key_of(d: str) -> str:
    """Quarter text of a date, in SQL."""
    return f"(year({d}) || '-Q' || quarter({d}))"


def bins(x: str, tiers, empty: str = "Stalled") -> str:
    """CASE text of a tier table."""
    whens = " ".join(f"when {x} >= {low} then '{label}'" for low, label in tiers)
    return f"case {whens} when {x} is null or {x} = 0 then '{empty}' end"

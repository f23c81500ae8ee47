"""Quarter, week, zone and minute arithmetic."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# A Sunday before all data; weeks are counted from here.
WEEK_ORIGIN = date(1899, 12, 31)


def quarter_index(d: Column) -> Column:
    """Quarters as consecutive integers: ``year * 4 + quarter - 1``."""
    return F.year(d) * 4 + F.quarter(d) - 1


def quarter_key(d: Column) -> Column:
    """Sortable quarter text, ``YYYY-Qn``."""
    return F.concat(F.year(d), F.lit("-Q"), F.quarter(d))


def quarter_label(d: Column) -> Column:
    """Display form of the quarter, ``Qn-YYYY``."""
    return F.concat(F.lit("Q"), F.quarter(d), F.lit("-"), F.year(d))


def index_year(index: Column) -> Column:
    return F.floor(index / 4).cast("int")


def index_key(index: Column) -> Column:
    """``YYYY-Qn`` of a quarter index."""
    return F.concat(index_year(index), F.lit("-Q"), index % 4 + 1)


def index_start(index: Column) -> Column:
    """First day of a quarter index."""
    return F.make_date(index_year(index), (index % 4 * 3 + 1).cast("int"), F.lit(1))


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "quarter")


def shift_quarters(d: Column, n: int) -> Column:
    """First day of the quarter ``n`` quarters away."""
    return F.add_months(quarter_start(d), 3 * n)


def weekday_from_sunday(d: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(d) - 1


def week_cutoff(d: Column) -> Column:
    """Friday of the last full week before the date."""
    return F.date_sub(d, weekday_from_sunday(d) + 2)


def week_index(d: Column) -> Column:
    """Whole weeks (Sunday to Saturday) since a fixed Sunday."""
    return F.floor(F.datediff(d, F.lit(WEEK_ORIGIN)) / 7).cast("int")


def week_of_quarter(d: Column, quarter_first: Column) -> Column:
    return week_index(d) - week_index(quarter_first) + 1


def _whole_minute(ts: Column) -> Column:
    none = F.lit(0)
    return ts - F.make_dt_interval(none, none, none, F.extract(F.lit("SECOND"), ts))


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (may be negative).

    Works on wall clocks as they are; the session's zone has no part in it.
    """
    return (_whole_minute(end) - _whole_minute(start)).cast("interval minute").cast("bigint")


def shift_zone(ts: Column, source: str, target: str) -> Column:
    """Wall clock of ``ts`` moved from one zone to another."""
    return F.convert_timezone(F.lit(source), F.lit(target), ts)


def near_range(ts: Column, low: date, high: date | None = None) -> Column:
    """Timestamps from two days before ``low`` to two days after ``high``, on the bare column.

    Wall clocks of two zones differ by at most 26 hours (UTC-12 to UTC+14), so this holds
    wherever the shifted timestamp is in the range; unlike that test it reaches the scan.
    """
    low_bound = F.lit(low - timedelta(days=ZONE_MARGIN_DAYS)).cast("timestamp_ntz")
    if high is None:
        return ts >= low_bound
    return (ts >= low_bound) & (ts < F.lit(high + timedelta(days=ZONE_MARGIN_DAYS)).cast("timestamp_ntz"))


#: Days that cover the largest difference of two zones' wall clocks (26 hours).
ZONE_MARGIN_DAYS = 2


def coalesced_in_range(first: Column, second: Column, low: date, high: date) -> Column:
    """``coalesce(first, second)`` in ``[low, high)``, in a form scans can push down."""

    def inside(c: Column) -> Column:
        return (c >= F.lit(low)) & (c < F.lit(high))

    return inside(first) | (first.isNull() & inside(second))


def register_sql_functions(spark: SparkSession) -> None:
    """Make the calendar functions callable from SQL text as well."""
    for statement in (
        "create or replace temporary function quarter_key(d date) returns string "
        "return concat(year(d), '-Q', quarter(d))",
        "create or replace temporary function week_index(d date) returns int "
        "return cast(floor(datediff(d, date'1899-12-31') / 7) as int)",
        "create or replace temporary function quarter_first_day(d date) returns date "
        "return trunc(d, 'quarter')",
    ):
        spark.sql(statement)


def extract_stamp(params) -> Column:
    """The time of the extract as a timestamp without zone (the wall clock the run was given)."""
    return F.lit(params.extract_stamp.isoformat(sep=" ")).cast("timestamp_ntz")

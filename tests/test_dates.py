from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldstats.functions import dates as d
from fieldstats.params import JobParams


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return frame.select(column).first()[0]


@pytest.mark.parametrize(
    "day, cutoff",
    [
        (date(2001, 6, 20), date(2001, 6, 15)),  # Wednesday
        (date(2001, 6, 17), date(2001, 6, 15)),  # Sunday
        (date(2001, 6, 22), date(2001, 6, 15)),  # Friday
        (date(2001, 6, 23), date(2001, 6, 15)),  # Saturday
        (date(2024, 2, 29), date(2024, 2, 23)),
        (date(2024, 1, 1), date(2023, 12, 29)),
    ],
)
def test_week_cutoff_is_the_friday_of_the_last_full_week(spark, day, cutoff):
    assert one(spark, d.week_cutoff(F.col("day")), day=day) == cutoff
    assert JobParams(as_of=day, region="x").week_cutoff == cutoff
    assert cutoff.isoweekday() == 5


def test_quarter_forms_agree(spark):
    days = [date(2001, 1, 1), date(2001, 3, 31), date(2001, 4, 1), date(2001, 12, 31), date(2000, 2, 29)]
    frame = spark.createDataFrame([(x,) for x in days], "day date")
    index = d.quarter_index(F.col("day"))
    out = frame.select(
        "day",
        d.quarter_key(F.col("day")).alias("key"),
        d.index_key(index).alias("index_key"),
        d.index_start(index).alias("start"),
        d.quarter_start(F.col("day")).alias("trunc"),
        d.quarter_label(F.col("day")).alias("label"),
    ).collect()
    for row in out:
        assert row["key"] == row["index_key"]
        assert row["start"] == row["trunc"]
        assert row["label"] == f"Q{row['key'][-1]}-{row['key'][:4]}"
    assert {r["key"] for r in out} == {"2001-Q1", "2001-Q2", "2001-Q4", "2000-Q1"}


def test_params_dates():
    p = JobParams(as_of=date(2001, 1, 2), region="x")
    assert (p.quarter_first, p.next_quarter_first, p.previous_quarter_first) == (
        date(2001, 1, 1),
        date(2001, 4, 1),
        date(2000, 10, 1),
    )
    assert p.quarter_key == "2001-Q1" and p.quarter_index == 8004 and p.history_first == date(1997, 1, 1)
    assert JobParams(as_of=date(2024, 2, 29), region="x").year_ago == date(2023, 2, 28)


def test_week_of_quarter_changes_on_sunday(spark):
    first = F.lit(date(2001, 4, 1))  # a Sunday
    got = [
        one(spark, d.week_of_quarter(F.col("day"), first), day=x)
        for x in (date(2001, 4, 1), date(2001, 4, 7), date(2001, 4, 8), date(2001, 6, 30))
    ]
    assert got == [1, 1, 2, 13]


def test_minutes_count_boundaries(spark):
    frame = spark.sql(
        """select timestamp_ntz '2001-01-01 00:00:59' a, timestamp_ntz '2001-01-01 00:01:00' b
           union all select timestamp_ntz '2001-01-01 00:00:00', timestamp_ntz '2001-01-01 00:00:59'
           union all select timestamp_ntz '2001-01-01 02:00:00', timestamp_ntz '2000-12-31 23:59:59'"""
    )
    assert [r[0] for r in rows(frame.select(d.minutes_between(F.col("a"), F.col("b"))))] == [-121, 0, 1]


def test_minutes_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # clocks go forward that night
        frame = spark.sql("select timestamp_ntz '2001-04-01 01:30:00' a, timestamp_ntz '2001-04-01 03:30:10.5' b")
        assert frame.select(d.minutes_between(F.col("a"), F.col("b"))).first()[0] == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_zone_shift(spark):
    ts = datetime(2024, 1, 1, 20, 0)
    frame = spark.createDataFrame([(ts,)], "ts timestamp_ntz")
    assert frame.select(d.shift_zone(F.col("ts"), "GMT", "Asia/Seoul")).first()[0] == datetime(2024, 1, 2, 5, 0)


def test_coalesced_range_equals_coalesce_and_reaches_the_scan(spark, plan, tmp_path):
    values = [None, date(2001, 3, 31), date(2001, 4, 1), date(2001, 6, 30), date(2001, 7, 1)]
    frame = spark.createDataFrame([(a, b) for a in values for b in values], "a date, b date")
    low, high = date(2001, 4, 1), date(2001, 7, 1)
    frame.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    fast = stored.where(d.coalesced_in_range(F.col("a"), F.col("b"), low, high))
    plain = stored.where((F.coalesce("a", "b") >= F.lit(low)) & (F.coalesce("a", "b") < F.lit(high)))
    assert rows(fast) == rows(plain) and fast.count() > 0
    assert "GreaterThanOrEqual(a,2001-04-01)" in plan(fast)


def test_sql_functions(spark):
    d.register_sql_functions(spark)
    row = spark.sql(
        "select quarter_key(date'2001-06-20'), week_index(date'2001-06-17') - week_index(date'2001-06-16'), "
        "quarter_first_day(date'2001-06-20')"
    ).first()
    assert tuple(row) == ("2001-Q2", 1, date(2001, 4, 1))


def test_near_range_holds_for_the_farthest_zones(spark):
    """A wall clock of UTC+14 shifted to UTC-12 moves 26 hours; the bare range still keeps it."""
    from datetime import date, datetime

    from pyspark.sql import functions as F

    from fieldstats.functions.dates import near_range, shift_zone

    frame = spark.createDataFrame([(datetime(2001, 3, 30, 23, 0),), (datetime(2001, 7, 2, 1, 0),)], "ts timestamp_ntz")
    for source, target in (("Pacific/Kiritimati", "Etc/GMT+12"), ("Etc/GMT+12", "Pacific/Kiritimati")):
        shifted = shift_zone(F.col("ts"), source, target)
        inside = (shifted >= F.lit(date(2001, 4, 1))) & (shifted < F.lit(date(2001, 7, 1)))
        assert frame.where(inside & ~near_range(F.col("ts"), date(2001, 4, 1), date(2001, 7, 1))).count() == 0
        assert frame.where(inside).count() >= 1


def test_extract_stamp_is_the_given_time(spark):
    from datetime import date, datetime

    from fieldstats.functions.dates import extract_stamp
    from fieldstats.params import JobParams

    stamped = JobParams(as_of=date(2001, 6, 20), region="r", extracted_at=datetime(2001, 6, 20, 6, 30, 15))
    plain = JobParams(as_of=date(2001, 6, 20), region="r")
    got = spark.range(1).select(extract_stamp(stamped).alias("a"), extract_stamp(plain).alias("b")).first()
    assert (got["a"], got["b"]) == (datetime(2001, 6, 20, 6, 30, 15), datetime(2001, 6, 20))

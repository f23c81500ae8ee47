import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldstats.operators.runrate import case_volume, projected, run_rate_calendar
from fieldstats.params import JobParams
from fieldstats.plans import access, market, population, usage, utilization
from fieldstats.session import scratch_path
from fieldstats.sources import readers, sinks

ASIA = JobParams(as_of=date(2001, 6, 20), region="K", models=(("S", "S"),), spine_floor=date(2000, 1, 1))


def test_working_days_without_holidays(spark):
    assert tuple(run_rate_calendar(spark, ASIA).first()) == (date(2001, 6, 15), 65, 55)
    closed = spark.createDataFrame([(date(2001, 5, 1),), (date(2001, 6, 18),), (date(2001, 6, 16),)], "d date")
    assert tuple(run_rate_calendar(spark, ASIA, closed).first()) == (date(2001, 6, 15), 63, 54)


def test_projection_is_null_before_the_first_working_day(spark):
    first_day = JobParams(as_of=date(2001, 7, 2), region="K")
    row = run_rate_calendar(spark, first_day).withColumn("rate", projected(F.lit(5))).first()
    assert row["dayssofar"] == 0 and row["rate"] is None


def test_case_volume_compares_quarter_numbers_alone(spark):
    cases = spark.createDataFrame(
        [(1, date(2001, 6, 15), "Completed"), (2, date(2001, 6, 16), "Completed"), (3, date(2000, 12, 1), "Completed"),
         (4, date(2002, 1, 5), "Completed"), (5, date(2002, 9, 5), "Completed"), (6, date(2000, 1, 1), "Open")],
        "i int, d date, s string",
    )
    got = cases.crossJoin(run_rate_calendar(spark, ASIA)).select("i", case_volume(ASIA, F.col("d"), F.col("s")))
    assert [(i, round(v, 6)) for i, v in rows(got)] == [(1, round(65 / 55, 6)), (2, 0.0), (3, 1.0), (4, 1.0), (5, 0.0), (6, 0.0)]


@pytest.fixture(scope="module")
def people(spark):
    account = spark.createDataFrame(
        [(1, "A1", "Hospital", "K"), (2, "A2", "Hospital", "J"), (3, "A3", "Office", "K"), (4, "A4", "Hospital", "K")],
        "accountguid int, accountid string, recordtype string, capitalregion string",
    ).withColumns(
        {
            "clinicalregion": F.col("capitalregion"),
            "accountname": F.col("accountid"),
            "customertype": F.lit("t"),
            **{f"{r}networkid": F.lit(r) for r in ("csd", "csm", "csr")},
        }
    )
    team = spark.createDataFrame(
        [(1, "d1", "r2", "m1", None, None, "v", "a", "x", None), (1, "d1", "r1", None, None, "s", "v", "a", "y", "w"),
         (2, "d1", "zz", "m9", None, None, "v", None, None, None), (4, None, "r5", None, None, None, "v", "b", None, "w")],
        "accountguid int, csdnetworkid string, csrnetworkid string, csmnetworkid string, ctanetworkid string, ssmnetworkid string, "
        "cvpnetworkid string, asdnetworkid string, asmnetworkid string, avpnetworkid string",
    ).withColumns({f"{r}name": F.lit(r) for r in ("csd", "csm", "csr", "ssm")})
    return {"account": account, "account_team": team}


def test_access_lists_keep_empty_slots_and_run_lists_together(spark, people):
    got = rows(access.access_list(people, ASIA))
    everyone = "a, bd1r1, r2, m1, , sx, y"
    # levels: csd "r1, r2, m1, , s"; cvp "d1"; asd "x, y"; avp "a, b"
    assert {r[2] for r in got} == {"a, bd1r1, r2, m1, , sx, y"} == {everyone}
    assert [r for r in got if r[0] == "A1"] == [("A1", 1, everyone, "r1, r2, m1, , s, d1, x, y, "),
                                                ("A1", 1, everyone, "r1, r2, m1, , s, d1, x, y, a, b")]
    assert [r[3] for r in got if r[0] == "A2"] == ["r1, r2, m1, , s, d1, , "]
    assert {r[0] for r in got} == {"A1", "A2", "A4"}
    region = rows(access.access_list_region(people, ASIA))
    assert [r[0] for r in region] == ["A1", "A1", "A4"] and region[0][3:] == ("csd", "csm", "csr")


def brute_population(cases, params, end, hospital, weights):
    """Per surgeon and quarter: (count or None, trailing count), written as plain loops."""

    def q(d):
        return d.year * 4 + (d.month - 1) // 3

    out = {}
    for surgeon in {c["s"] for c in cases}:
        mine = [c for c in cases if c["s"] == surgeon and c["a"] in hospital and c["st"] == "Completed"]
        regional = [c for c in mine if weights.get(c["c"])]
        if not regional:
            continue
        for quarter in range(max(min(q(c["d"]) for c in regional), params.floor_index), end + 1):
            n = sum(q(c["d"]) == quarter and c["d"] <= params.week_cutoff for c in mine)
            past = sum(weights[c["c"]] for c in regional if quarter - 3 <= q(c["d"]) <= quarter)
            out[(surgeon, quarter)] = (n or None, past)
    return out


def test_population_equals_plain_loops(spark, people):
    cases = [
        {"s": s, "c": i, "a": 1 + i % 4, "st": "Completed" if i % 5 else "Open", "m": "S" if i % 2 else "T",
         "d": date(1999 + (i * 7 + s) % 3, 1 + (i * 5) % 12 if (i * 7 + s) % 3 < 2 else 1 + (i * 5) % 6, 1 + i % 28)}
        for i in range(160) for s in (1, 2, 3) if (i + s) % 4
    ]
    weights = {i: (2 if i % 10 == 3 else 1) for i in range(160) if i % 3}
    procedures = spark.createDataFrame(
        [(f"{c['s']}-{c['c']}", c["c"], c["a"], c["s"], c["st"], c["m"], c["d"]) for c in cases],
        "recordid string, casenumber int, accountguid int, surgeonguid int, status string, systemmodel string, proceduredatelocal date",
    )
    summary = spark.createDataFrame([(i, "K") for i, w in weights.items() for _ in range(w)] + [(0, "J")], "casenumber int, clinicalregion string")
    contact = spark.createDataFrame([(1, 1), (2, 4), (3, 3)], "contactguid int, accountguid int").withColumns(
        {c: F.lit("x") for c in ("fullname", "specialtyname", "surgeoncategory")}
    )
    tables = {**people, "procedures": procedures, "procedure_summary": summary, "contact": contact}
    want = brute_population(cases, ASIA, ASIA.quarter_index, {1, 2, 4}, weights)
    got = population.population_by_quarter(spark, tables, ASIA).collect()
    assert len(got) == len(want) > 0
    for r in got:
        quarter = int(r["Quarter"][:4]) * 4 + int(r["Quarter"][-1]) - 1
        n, past = want[(r["SurgeonGUID"], quarter)]
        if quarter == ASIA.quarter_index and n is not None:
            n = n / 55 * 65
        assert r["Past 1 Year Procedures"] == past
        assert r["QuarterProcedureCount"] == (None if n is None else pytest.approx(n))
        assert r["Stalled"] == ("Stalled" if n is None else "Non Stalled")
        assert r["exist_flg"] == 1
    full = population.population_shift(spark, tables, ASIA).collect()
    assert {r["SurgeonGUID"] for r in full} == {1, 2}  # surgeon 3 belongs to no hospital
    narrow = population.population_by_quarter(spark, tables, ASIA, count_scope="region")
    assert sum(r["QuarterProcedureCount"] or 0 for r in narrow.collect()) < sum(r["QuarterProcedureCount"] or 0 for r in got)


@pytest.mark.parametrize("as_of, prior, prior_exact", [
    (date(2001, 6, 20), ["2001-Q1"], "2001-Q1"),
    (date(2001, 9, 30), ["2001-Q3"], "2001-Q2"),  # 90 days back is still the third quarter
    (date(2001, 2, 1), ["2000-Q4", "2001-Q4"], "2000-Q4"),  # the year's own fourth quarter has the number too
])
def test_prior_quarter_flags(spark, as_of, prior, prior_exact):
    days = spark.createDataFrame([(date(y, 3 * q - 1, 15),) for y in (2000, 2001) for q in (1, 2, 3, 4)], "d date")
    key = F.concat(F.year("d"), F.lit("-Q"), F.quarter("d"))
    loose = days.where(usage.prior_quarter_flag(F.col("d"), as_of) == 1).select(key)
    exact = days.where(usage.prior_quarter_flag(F.col("d"), as_of, exact=True) == 1).select(key)
    assert [r[0] for r in loose.collect()] == prior
    assert [r[0] for r in exact.collect()] == [prior_exact]


def test_two_quarters_prior_over_the_year_end(spark):
    days = spark.createDataFrame([(date(y, 3 * q - 1, 15),) for y in (2000, 2001) for q in (1, 2, 3, 4)], "d date")
    for as_of, want in ((date(2001, 2, 1), date(2000, 8, 15)), (date(2001, 5, 1), date(2000, 11, 15))):
        exact = days.where(usage.two_quarters_prior_flag(F.col("d"), as_of, exact=True) == 1).collect()
        loose = days.where(usage.two_quarters_prior_flag(F.col("d"), as_of) == 1).collect()
        assert [r[0] for r in exact] == [want] and want in [r[0] for r in loose]


def test_validity_of_systems(spark):
    systems = spark.createDataFrame(
        [("1", "A", False, date(2000, 1, 5), None, date(1999, 1, 1), None),
         ("2", "A", False, date(2000, 1, 5), date(2000, 7, 1), None, None),
         ("1", "B", True, date(2000, 1, 5), None, date(2001, 1, 1), date(2001, 2, 1)),
         ("1", "C", False, None, None, None, None),
         ("1", "D", False, date(2000, 1, 5), None, None, None)],
        "accountid string, name string, inactive boolean, financeinstalleddate date, financedeinstalleddate date, installdate date, removedate date",
    )
    rules = utilization.UtilizationRules(account_overrides=(("1", "A", "1998-Q3"),), reinstalled=("B",), removed=("D",))
    got = rows(utilization.with_validity(systems, rules).select("accountid", "name", "start_quarter", "start_index", "end_index"))
    assert got == [
        ("1", "A", "1998-Q3", 7994, None), ("1", "B", "2000-Q1", 8000, 8004), ("1", "C", "9999-Q4", None, None),
        ("1", "D", "2000-Q1", 8000, 0), ("2", "A", "2000-Q1", 8000, 8002),
    ]


def test_installed_systems_match_brute_force(spark):
    """Equal rows, open ends, empty intervals, several names and models per system."""
    def first(q):
        return date(q // 4, q % 4 * 3 + 1, 1)

    data = [("n", "X", 8002, 8005), ("n", "X", 8002, 8005), ("n", "A", 8003, None), ("n", "Z", None, None), ("n", "E", 8004, 8004), ("m", "X", 8001, 8003)]
    systems = spark.createDataFrame(
        [(1, "id", a, "s", m, "System", "OR", False, None if s is None else first(s), None if e is None else first(e), None, None) for a, m, s, e in data],
        "accountguid int, accountid string, accountname string, name string, model string, type string, systemuse string, inactive boolean, "
        "financeinstalleddate date, financedeinstalleddate date, installdate date, removedate date",
    )
    rules = utilization.UtilizationRules(first_year=2000, last_year=2001)
    accounts = spark.createDataFrame([(1,)], "accountguid int")
    got = rows(utilization.installed_by_quarter(utilization.systems_by_account(systems, accounts, rules), rules, JobParams(as_of=date(2026, 12, 1), region="ASIA")).drop("accountguid", "name"))
    want = []
    for q in range(8000, 8008):
        found = [m for _, m, s, e in data if s is not None and s <= q and (e is None or q < e)]
        for model in {m for _, m, _, _ in data} if found else ():
            n = len(found) * len({a for a, m, _, _ in data if m == model})
            want.append((model, q, n, "Fleet" if n > 1 else "Others", ", ".join(sorted(set(found), reverse=True))))
    assert got == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r]) and want


BODIES = [
    (2019, "C1", '{"response":{"body":{"items":{"item":[{"diagCdNm":"계","ptntCnt":"12"},{"diagCdNm":"x","ptntCnt":9}]}}}}'),
    (2019, "C1", '{"response":{"body":{"items":{"item":{"diagCdNm":"계","ptntCnt":3}}}}}'),
    (2020, "C1", '{"response":{"body":{"items":{"item":[{"diagCdNm":"계"}]}}}}'),
    (2020, "C2", '{"response":{"body":{}}}'),
    (2020, "C2", "not json"),
    (2020, "C2", None),
]


def test_responses_landed_and_counted(spark, tmp_path):
    frame = spark.createDataFrame(BODIES, "year int, code string, body string")
    frame.write.json(str(tmp_path / "landed"))
    landed = readers.read_responses(spark, str(tmp_path / "landed"))
    assert rows(readers.response_items(landed)) == [
        (2019, "C1", "x", 9), (2019, "C1", "계", 12), (2019, "C1", "계", 3), (2020, "C1", "계", 0),
    ]
    assert tuple(readers.response_quality(landed).first()) == (6, 3)
    codes = spark.createDataFrame([("C1", "one"), ("C1", "again"), ("C2", "two")], "code string, name string")
    assert rows(market.counts_from_responses(landed, codes)) == [
        ("HIRA", 2019, "C1", "again", 15), ("HIRA", 2019, "C1", "one", 15),
        ("HIRA", 2020, "C1", "again", 0), ("HIRA", 2020, "C1", "one", 0),
    ]


def test_sheet_to_total(spark):
    record = spark.createDataFrame(
        [("g", "A010 x", "1,234", "-"), ("g", "A010 y", "1", "2"), ("g", "a010 z", "5", "5"), ("g", "소계", "9", "9"),
         ("g", None, "3", "3"), ("g", "B999 n", "4", "4")],
        "grp string, label string, `2019` string, `2020` string",
    )
    codes = spark.createDataFrame([(" a010 ", "one"), ("A010", "two"), ("C111", None)], "code string, name string")
    sheet = market.counts_from_sheet(record, codes)
    assert rows(sheet) == [
        ("DRG", 2019, "A010", "one", 0, 1235), ("DRG", 2019, "A010", "two", 0, 1235),
        ("DRG", 2020, "A010", "one", 0, 2), ("DRG", 2020, "A010", "two", 0, 2),
    ]
    unlisted = record.unionByName(spark.createDataFrame([("g", "B999 m", "n/a", "n/a")], record.schema))
    assert rows(market.counts_from_sheet(unlisted, codes)) == rows(sheet)
    listed = record.unionByName(spark.createDataFrame([("g", "A010 m", "n/a", "1")], record.schema))
    with pytest.raises(Exception, match="no number: n/a"):
        market.counts_from_sheet(listed, codes).collect()
    other = spark.createDataFrame([("HIRA", 2019, "A010", "one", 7), ("HIRA", 2019, None, "one", 9)], "Source string, Year int, Code string, DRG_Name string, HIRA_Patients long")
    total = market.market_total(other, sheet)
    assert ("HIRA", 2019, "A010", "one", 7, 0, 7) in rows(total) and total.count() == 5
    assert [tuple(r) for r in market.first_rows(total, 1).collect()] == [("DRG", 2019, "A010", "one", 0, 1235, 1235)]


def test_columns_are_found_by_token_or_place():
    assert readers.find_column(["No", "St5 CODE", "x"], "code") == "St5 CODE"
    assert readers.find_column(["No", "y"], "subject", 1) == "y"
    assert readers.find_column(["No"], "subject", 1) == "No"


def test_sinks(spark, tmp_path):
    one, two = spark.range(3).toDF("id"), spark.range(5).toDF("id")
    path = str(tmp_path / "t")
    for frame in (one, two, two):
        sinks.replace_folder(sinks.evenly_sized(frame), path)
    assert spark.read.parquet(path).count() == 5
    log = str(tmp_path / "log")
    sinks.append_snapshot(one, log, date(2001, 1, 1))
    sinks.append_snapshot(one, log, date(2001, 1, 1))
    assert spark.read.parquet(log).count() == 6
    once = str(tmp_path / "once")
    sinks.write_snapshot_once(one, once, date(2001, 1, 1))
    sinks.write_snapshot_once(two, once, date(2001, 1, 2))
    sinks.write_snapshot_once(two, once, date(2001, 1, 2))
    read = sinks.read_snapshots(spark, once)
    assert rows(read.groupBy("extract_date").count()) == [(date(2001, 1, 1), 3), (date(2001, 1, 2), 5)] and read.columns == ["id", "extract_date"]
    folder = sinks.export_dated(one, str(tmp_path), date(2001, 1, 2))
    assert folder.endswith("MarketData_2001-01-02") and spark.read.csv(folder, header=True).count() == 3
    sinks.replace_table(one, "fieldstats_sink_check")
    sinks.replace_table(two.withColumn("more", F.lit(1)), "fieldstats_sink_check")
    assert spark.table("fieldstats_sink_check").columns == ["id", "more"]
    with pytest.raises(Exception, match="broken"):
        sinks.replace_table(one.select(F.raise_error(F.lit("broken")).alias("id")), "fieldstats_sink_check")
    assert spark.table("fieldstats_sink_check").count() == 5  # a failed run leaves the table as it was
    spark.sql("drop view fieldstats_sink_check")


def test_refresh_keeps_readers_on_a_whole_version(spark, tmp_path):
    """Each refresh writes a new version, then repoints the view; old versions beyond the last two go."""
    root = str(tmp_path / "w")
    paths = [sinks.replace_table(spark.range(n).toDF("id"), "fieldstats_versions", root) for n in (1, 2, 3, 4)]
    reader = spark.table("fieldstats_versions")  # bound to the version of now
    assert reader.count() == 4
    assert sorted(os.listdir(tmp_path / "w" / "fieldstats_versions__versions")) == sorted(p.rsplit("/", 1)[1] for p in paths[-3:])
    spark.sql("drop view fieldstats_versions")


def test_day_commits_skip_failed_and_show_empty_runs(spark, tmp_path):
    """A run that fails half-way is never read; an empty run empties its day; each write runs its plan once."""
    log, full = str(tmp_path / "log"), spark.range(4).toDF("id")
    sinks.write_snapshot_once(full, log, date(2001, 1, 1))
    sinks.write_snapshot_once(full, log, date(2001, 1, 2))
    broken = full.withColumn("id", F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("half way"))).cast("bigint"))
    with pytest.raises(Exception, match="half way"):
        sinks.write_snapshot_once(broken.repartition(4), log, date(2001, 1, 1))
    sinks.write_snapshot_once(full.limit(0), log, date(2001, 1, 2))
    got = sinks.read_snapshots(spark, log, "id bigint")
    assert rows(got.groupBy("extract_date").count()) == [(date(2001, 1, 1), 4)]
    assert rows(spark.read.parquet(log + "/_commits").select("rows")) == [(0,), (4,), (4,)]


def test_scratch_folders_are_fresh(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_installed_counts_sweep_one_hot_key(spark, plan):
    """100,000 distinct intervals on one system: counts by sweep equal a count per quarter; no list per key."""
    import numpy as np

    first, last = 8000, 8103
    rng = np.random.default_rng(7)
    starts = rng.integers(first - 10, last + 5, 100_000)
    ends = starts + rng.integers(-2, 60, 100_000)
    ends = np.where(rng.random(100_000) < 0.2, -1, ends)  # open ends
    frame = spark.createDataFrame(
        [(1, "s", int(s), None if e < 0 else int(e), True) for s, e in zip(starts, ends)],
        "accountguid int, name string, start_index int, end_index int, countable boolean",
    )
    got = utilization.installed_counts(frame, ["accountguid", "name"], first, last)
    assert "collect_list" not in plan(got) and "CartesianProduct" not in plan(got)
    counted = dict((r["quarter_index"], r["n"]) for r in got.collect())
    for q in range(first, last + 1):
        want = int(np.sum((starts <= q) & ((ends < 0) | (q < ends))))
        assert counted.get(q, 0) == want, q


def test_unreadable_responses_are_quarantined_with_their_reason(spark, tmp_path):
    """Every response that gives no item goes aside once, with why; mended, it reads back as landed."""
    frame = spark.createDataFrame(BODIES + [(2021, "C3", '{"response":{"body":{"items":{"item":"text"}}}}')], "year int, code string, body string")
    frame.write.json(str(tmp_path / "landed"))
    landed = readers.read_responses(spark, str(tmp_path / "landed"))
    aside = readers.quarantined(landed)
    assert rows(aside.select("year", "code", "reason")) == [
        (2020, "C2", "no body"), (2020, "C2", "no items"), (2020, "C2", "not json"), (2021, "C3", "unreadable items"),
    ]
    assert aside.count() == readers.response_quality(landed).first()["unreadable"]
    mended = aside.where("reason = 'no items'").withColumn("body", F.lit('{"response":{"body":{"items":{"item":{"diagCdNm":"x","ptntCnt":4}}}}}'))
    mended.write.parquet(str(tmp_path / "mended"))
    again = readers.read_responses(spark, str(tmp_path / "landed"), replay=str(tmp_path / "mended"))
    assert (2020, "C2", "x", 4) in rows(readers.response_items(again))


def test_bucketed_copies_join_and_group_without_exchange(spark, plan):
    """Two tables bucketed on the same key into as many buckets: the join and the grouping read no shuffle."""
    from workload.registry import QUERIES

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large to broadcast
    try:
        got = QUERIES["join_bucketed"](spark, "/root/testdata/sf0.001")
        text = plan(got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text and "SortMergeJoin" in text
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey").distinct().count()


def test_refresh_rewrites_touched_quarters_only(spark, tmp_path):
    """A second run rewrites the quarters whose input changed (and those that look back at them); a vanished one is hidden."""
    path = str(tmp_path / "r")
    data = [(q, v) for q in (8000, 8001, 8002, 8003) for v in range(3)]

    def build(frame):
        return lambda quarters: frame.where(F.col("q").isin(quarters)).groupBy(F.col("q").alias("quarter_index")).agg(F.sum("v").alias("s"))

    first = spark.createDataFrame(data, "q int, v int")
    assert sinks.refresh_touched(build(first), first, F.col("q"), path) == [8000, 8001, 8002, 8003]
    stamp = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "r").glob("quarter_index=*/*.parquet")}
    second = spark.createDataFrame([r for r in data if r[0] != 8003] + [(8001, 10)], "q int, v int")
    assert sinks.refresh_touched(build(second), second, F.col("q"), path, reach=1) == [8001, 8002, 8003, 8004]
    assert sinks.refresh_touched(build(second), second, F.col("q"), path) == []
    kept = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "r" / "quarter_index=8000").glob("*.parquet")}
    assert kept and all(stamp[name] == t for name, t in kept.items())
    assert rows(sinks.read_refreshed(spark, path)) == [(8000, 3), (8001, 13), (8002, 3)]


def test_access_rows_hold_the_persons_of_the_text(spark):
    """The row form lists, per account, exactly the ids that WHOCANACCESS joins into text; ALLUSERS' ids are the users' table."""
    from workload.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    text = {}
    for r in QUERIES["access_list"](spark, folder).collect():
        text.setdefault(r["accountguid"], set()).update(x for x in r["WHOCANACCESS"].split(", ") if x)
    listed = {}
    for r in QUERIES["access_rows"](spark, folder).collect():
        listed.setdefault(r["accountguid"], set()).add(r["networkid"])
    assert {k: v for k, v in text.items() if v} == listed and listed
    users = {r["networkid"] for r in QUERIES["access_users"](spark, folder).collect()}
    assert users >= set().union(*listed.values())

from datetime import date

import pytest
from conftest import rows
from fieldstats import jobs
from fieldstats.jobs import JobRules, daily_refresh, yearly_market
from fieldstats.params import JobParams
from fieldstats.plans.events import event_log
from fieldstats.plans.market import counts_from_sheet
from fieldstats.plans.utilization import UtilizationRules
from fieldstats.sources.readers import read_sheet, read_table
from fieldstats.sources.sinks import export_dated, read_snapshots, write_snapshot_once
from workload.bindings import PARAMS, SourceTables
from workload.products import EVENTS, SCORECARD, SNAPSHOT, USAGE, UTILIZATION

FOLDER = "/root/testdata/sf0.001"


def test_daily_refresh_writes_all_tables_and_one_log_day(spark, tmp_path):
    spark.sql("create database if not exists fieldstats_runs")
    tables = SourceTables(spark, FOLDER, {"procedures": "procedures_typed"})
    rules = JobRules(usage=USAGE, snapshot=SNAPSHOT, scorecard=SCORECARD, utilization=UTILIZATION, events=EVENTS)
    log = str(tmp_path / "log")
    names = daily_refresh(spark, tables, PARAMS, rules, "fieldstats_runs", log)
    events = read_snapshots(spark, log).count()
    assert len(names) == 8 and all(spark.table(f"fieldstats_runs.{n}").count() for n in names) and events
    write_snapshot_once(event_log(tables, PARAMS, EVENTS), log, PARAMS.as_of)  # the same day again
    assert read_snapshots(spark, log).count() == events
    assert "Past 1 Year Procedures" in spark.table("fieldstats_runs.surgeon_population_shift").columns
    assert [r[0] for r in read_snapshots(spark, log).select("extract_date").distinct().collect()] == [PARAMS.as_of]
    spark.sql("drop database fieldstats_runs cascade")


def test_yearly_market_from_files(spark, tmp_path):
    def write(name, data, columns):
        spark.createDataFrame(data, columns).write.option("header", True).csv(str(tmp_path / name))
        return str(tmp_path / name)

    landed = str(tmp_path / "landed")
    body = '{"response":{"body":{"items":{"item":[{"diagCdNm":"계","ptntCnt":"12"}]}}}}'
    spark.createDataFrame([(2019, "Q1", body), (2020, "Q1", "broken")], "year int, code string, body string").write.json(landed)
    matching = write("matching", [("1", "Q1", "Subject one")], ["No", "St5 Code", "Subject"])
    record = write("record", [("g", "A010 x", "1,234", "-"), ("g", "소계", "9", "9")], ["group", "label", "2019", "2020"])
    mapping = write("map", [("A010", "Ten"), ("X1", "One"), (" x1", "One")], ["질병군분류(2)", "DRG(포괄수가제 행위 코드)"])
    run = yearly_market(spark, landed, matching, record, mapping, str(tmp_path), date(2025, 1, 2))
    assert (run.responses, run.unreadable, run.repeated_matching_codes, run.repeated_map_codes) == (2, 1, 0, 1)
    assert [tuple(r) for r in spark.read.parquet(run.quarantine).collect()] == [(2020, "Q1", "not json", "broken")]
    assert rows(spark.read.csv(run.folder, header=True)) == [
        ("DRG", "2019", "A010", "Ten", "0", "1234", "1234"),
        ("DRG", "2020", "A010", "Ten", "0", "0", "0"),
        ("HIRA", "2019", "Q1", "Subject one", "12", "0", "12"),
    ]


def test_yearly_market_stops_on_empty_input(spark, tmp_path):
    sheet = str(tmp_path / "sheet")
    spark.createDataFrame([("1", "Q1")], "code string, subject string").write.option("header", True).csv(sheet)
    landed = str(tmp_path / "landed")
    spark.createDataFrame([], "year int, code string, body string").write.json(landed)
    with pytest.raises(ValueError, match="no rows in responses"):
        yearly_market(spark, landed, sheet, sheet, sheet, str(tmp_path), date(2025, 1, 2))


def test_blocks_have_their_own_holidays(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(jobs, "run_rate_calendar", lambda spark, params, days: days)
    monkeypatch.setattr(jobs, "population_shift", lambda *a: seen.append(a[3:]))
    monkeypatch.setattr(jobs, "duration_population", lambda *a: seen.append(a[4:]))
    monkeypatch.setattr(jobs, "account_scorecard", lambda *a: seen.append(a[4:]))
    rules = JobRules(usage=USAGE, snapshot=SNAPSHOT, scorecard=SCORECARD, utilization=UTILIZATION, events=EVENTS)
    products = jobs.daily_products(spark, {}, PARAMS, rules, jobs.Holidays("p", "d", "t", "s"))
    for name in ("surgeon_population_shift", "procedure_duration_population", "account_scorecard"):
        products[name]()
    assert seen == [("p",), ("d", "t"), ("s",)]


def test_a_second_empty_run_clears_its_day(spark, tmp_path):
    path, full = str(tmp_path / "log"), spark.range(3).toDF("id")
    for frame, day in ((full, date(2001, 6, 19)), (full, date(2001, 6, 20)), (full.limit(0), date(2001, 6, 20))):
        write_snapshot_once(frame, path, day)
    assert [tuple(r) for r in read_snapshots(spark, path, "id bigint").groupBy("extract_date").count().collect()] == [(date(2001, 6, 19), 3)]


def test_tables_are_read_with_their_present_schema(spark, tmp_path):
    for frame in (spark.range(1), spark.range(1).selectExpr("id", "1 as more")):
        frame.write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
        assert read_table(spark, str(tmp_path), "t").columns == frame.columns


def test_sheets_hold_quoted_line_breaks(spark, tmp_path):
    data = [('two\nlines', 'a "quoted" word'), ("plain", "a,b")]
    out = export_dated(spark.createDataFrame(data, "`the\nlabel` string, other string"), str(tmp_path), date(2001, 1, 1))
    sheet = read_sheet(spark, out)
    assert sheet.columns == ["the\nlabel", "other"] and rows(sheet) == sorted(data)


def test_sheet_codes_and_cells(spark):
    record = spark.createDataFrame([("g", "A010 x", "1,234"), ("g", "B020 y", "5")], "`g` string, label string, `2019` string")
    listed = spark.createDataFrame([("A010\u00a0", "Ten"), ("\tb020", "Twenty")], "code string, name string")
    assert sorted(r["KOSIS_Patients"] for r in counts_from_sheet(record, listed).collect()) == [5, 1234]
    blank = spark.createDataFrame([("g", "A010 x", None)], record.schema)
    with pytest.raises(Exception, match="blank"):
        counts_from_sheet(blank, listed).collect()


def test_utilization_ends_with_the_run_quarter():
    assert UtilizationRules().last_index(JobParams(as_of=date(2026, 12, 1), region="K")) == 2026 * 4 + 3


def test_event_dates_reach_the_scan(spark, plan, tmp_path):
    tables = SourceTables(spark, FOLDER, {"procedures": "procedures_typed"})
    tables["event"].write.parquet(str(tmp_path / "event"))
    stored = {n: tables[n] for n in ("account", "contact", "user", "opportunity", "opportunity_line", "milestone_pathway", "record_type")}
    text = plan(event_log({**stored, "event": spark.read.parquet(str(tmp_path / "event"))}, PARAMS, EVENTS))
    assert "GreaterThanOrEqual(eventenddatetime" in text

import re
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from fieldstats.functions.text import first_like, in_class, leading_code, plain_integer, without_match
from fieldstats.operators import combine, lists, lookup, pivots, ranges, ranking, snapshot, spine


def test_lists_are_distinct_ordered_and_null_without_values(spark):
    team = spark.createDataFrame(
        [("d1", "b", "x"), ("d1", "a", None), ("d1", "b", None), ("d2", None, None), ("d2", None, "y")],
        "role string, one string, two string",
    )
    got = rows(lists.distinct_lists(team, ["role"], {"ones": "one", "twos": "two"}))
    assert got == [("d1", "a, b", "x"), ("d2", None, "y")]
    down = rows(lists.distinct_lists(team, ["role"], {"ones": "one"}, separator="", descending=True))
    assert down == [("d1", "ba"), ("d2", None)]
    assert rows(lists.distinct_lists(team, [], {"all": "one"}, "")) == [("ab",)]
    assert rows(lists.distinct_lists(team.where("false"), [], {"all": "one"}, "")) == [(None,)]


def test_list_values_are_part_of_the_shuffle_key(spark, plan):
    team = spark.createDataFrame([("d", "a")], "role string, one string")
    listed = lists.distinct_lists(team, ["role"], {"ones": "one"})
    assert re.search(r"hashpartitioning\(role#\d+, .*slot.*item", plan(listed))


RANKED = [("a", date(2001, 1, 1), "s2"), ("a", date(2001, 1, 1), "s1"), ("a", date(2001, 1, 1), "s1"),
          ("b", None, "s9"), ("b", date(2002, 1, 1), "s1"), ("c", date(2000, 1, 1), None)]


def test_top_rank_keeps_ties_and_puts_null_dates_first(spark):
    frame = spark.createDataFrame(RANKED, "k string, d date, s string")
    got = ranking.top_rank_per_key(frame, ["k"], [("d", "desc_nulls_first"), ("s", "asc_nulls_last")])
    assert rows(got) == [
        ("a", date(2001, 1, 1), "s1"), ("a", date(2001, 1, 1), "s1"), ("b", None, "s9"), ("c", date(2000, 1, 1), None),
    ]


def test_first_row_is_limited_before_the_shuffle(spark, plan):
    frame = spark.createDataFrame(RANKED, "k string, d date, s string")
    first = ranking.first_row_per_key(frame, ["k"], [F.col("d").asc_nulls_last(), F.col("s").asc_nulls_last()])
    assert rows(first) == [("a", date(2001, 1, 1), "s1"), ("b", date(2002, 1, 1), "s1"), ("c", date(2000, 1, 1), None)]
    text = plan(first)
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_activity_spine_equals_the_cartesian_form(spark):
    firsts = spark.createDataFrame([("a", 10), ("b", 3), ("c", 20), ("d", None)], "e string, f int")
    got = rows(spine.activity_spine(firsts, F.col("f"), 8, 14).select("e", "quarter_index"))
    quarters = spark.range(8, 15).select(F.col("id").cast("int").alias("q"))
    want = rows(firsts.crossJoin(quarters).where("f <= q").select("e", "q"))
    assert got == want


def test_fill_gaps_inserts_only_missing_quarters(spark):
    quarterly = spark.createDataFrame([("a", 5, 2), ("a", 8, 1), ("b", 9, 4), ("b", 12, 1)], "e string, quarter_index int, n int")
    got = rows(spine.fill_gaps(quarterly, "e", 10, ["n"]).select("e", "quarter_index", "n"))
    assert got == sorted(
        [("a", 5, 2), ("a", 6, None), ("a", 7, None), ("a", 8, 1), ("a", 9, None), ("a", 10, None),
         ("b", 9, 4), ("b", 10, None)],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_year_before_anchor_limits(spark):
    anchors = spark.createDataFrame(
        [("a", date(2001, 6, 20), 1), ("a", date(2001, 6, 20), 2), ("b", None, 3), ("c", date(2001, 6, 20), 4)],
        "k string, anchor date, tag int",
    )
    facts = spark.createDataFrame(
        [("a", date(2000, 6, 20), 1), ("a", date(2000, 6, 19), 2), ("a", date(2001, 6, 20), 3),
         ("a", date(2001, 6, 19), 4), ("a", date(2001, 6, 19), None), ("b", date(2001, 1, 1), 5)],
        "k string, day date, id int",
    )
    got = rows(ranges.count_year_before(anchors, facts, "k", "anchor", "day", "id", "n").select("k", "tag", "n"))
    assert got == [("a", 1, 2), ("a", 2, 2), ("b", 3, 0), ("c", 4, 0)]


def test_pivots_null_zero_and_total(spark):
    frame = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "y", 3), ("b", None, 4)], "k string, c string, v int")
    conditions = {"xs": F.col("c") == "x", "ys": F.col("c") == "y"}
    summed = rows(frame.groupBy("k").agg(*pivots.sums_where(conditions, F.col("v"))))
    zeroed = rows(frame.groupBy("k").agg(*pivots.sums_where(conditions, F.col("v"), empty_as_zero=True)))
    counted = rows(frame.groupBy("k").agg(*pivots.counts_where(conditions, F.col("v"))))
    firsts = rows(frame.groupBy("k").agg(*pivots.firsts_where(conditions, F.col("v"))))
    assert summed == [("a", 1, 2), ("b", None, 3)]
    assert zeroed == [("a", 1, 2), ("b", 0, 3)]
    assert counted == [("a", 1, 1), ("b", 0, 1)]
    assert firsts == [("a", 1, 2), ("b", None, 3)]


def test_overrides_first_entry_wins_and_rows_stay_single(spark):
    table = lookup.override_table(spark, [("1", "s", "X"), ("1", "s", "Y"), ("2", "s", "Z")], ["acc", "sys"], "new")
    by_system = lookup.override_table(spark, [("s", "S")], ["sys"], "new")
    frame = spark.createDataFrame([("1", "s"), ("2", "t"), ("3", "s"), (None, "u")], "acc string, sys string")
    got = lookup.with_overrides(frame, "start", F.lit("D"), [(table, ["acc", "sys"], "new"), (by_system, ["sys"], "new")])
    assert rows(got) == [(None, "u", "D"), ("1", "s", "X"), ("2", "t", "D"), ("3", "s", "S")]


def test_membership_short_and_long_lists(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert rows(lookup.keep_members(frame, "v", ["a", "z"])) == [("a",)]
    assert rows(lookup.drop_members(frame, "v", ["a"])) == [("b",)]
    for extra in ([], [f"n{i}" for i in range(5000)]):
        assert rows(lookup.keep_members(frame, "v", ["a", "z", *extra])) == [("a",)]
        assert rows(lookup.drop_members(frame, "v", ["a", "z", *extra])) == [("b",)]
        assert rows(lookup.drop_members(frame, "v", ["a", None, *extra])) == []
    assert rows(lookup.keep_members(frame, "v", frame)) == [("a",), ("b",)]


def test_one_row_is_broadcast_and_appended(spark):
    frame = spark.range(3).toDF("id")
    text = lookup.cross_one_row(frame, frame.agg(F.max(F.col("id").cast("string")).alias("t")))
    assert "ResolvedHint" in text._jdf.queryExecution().analyzed().toString()
    assert rows(text) == [(0, "2"), (1, "2"), (2, "2")]


def test_latest_rows_keep_ties(spark):
    frame = spark.createDataFrame([(1, date(2001, 1, 1)), (2, date(2001, 1, 2)), (3, date(2001, 1, 2)), (4, None)], "i int, d date")
    assert [r[0] for r in rows(snapshot.latest_rows(frame, "d"))] == [2, 3]


def test_union_pads_and_types(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType())])
    left, right = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2.5,)], "b double")
    out = combine.union_to_schema([left, right], schema)
    assert out.schema == schema and rows(out) == [(None, 2.5), ("1", None)]
    assert rows(combine.concat_by_name([left, right])) == [(None, 2.5), (1, None)]


def test_text_rules(spark):
    labels = [("A010 x",), ("a010 y",), ("소계 A",), (None,), ("B12",)]
    frame = spark.createDataFrame(labels, "v string")
    kept = frame.where(without_match(F.col("v"), "소계|계")).select("v", leading_code(F.col("v")).alias("c"))
    assert rows(kept) == [(None, None), ("A010 x", "A010"), ("B12", None), ("a010 y", None)]
    cells = spark.createDataFrame([("1,234",), ("-",), ("7",)], "v string")
    assert [r[0] for r in cells.select(plain_integer(F.col("v"))).collect()] == [1234, 0, 7]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("n/a",)], "v string").select(plain_integer(F.col("v"))).collect()


def test_like_order_over_product_lists(spark):
    from workload.products import EVENTS

    lists_ = ["unit SP,unit X,unit Xi", "unit SP,unit Xi", "unit SP,unit X", "unit X,unit Xi", "unit Xi", "unit X", "unit SP", "", "other"]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(lists_)], "i int, v string")
    got = [r[0] for r in frame.orderBy("i").select(first_like(F.col("v"), EVENTS.mix_patterns, "Others")).collect()]
    assert got == [
        "unit SP & unit X & unit Xi", "unit SP & unit Xi", "unit SP & unit X", "unit X & unit Xi", "unit Xi", "unit X",
        "unit SP", "Others", "Others",
    ]


def test_class_needs_every_part(spark):
    frame = spark.createDataFrame([("G", "V"), ("G", None), ("G", "W")], "a string, b string")
    got = frame.select(in_class([F.col("a"), F.col("b")], ["GV", "GV"], "Growth", "Others")).collect()
    assert [r[0] for r in got] == ["Growth", "Others", "Others"]


def test_a_hot_key_gives_the_same_results(spark):
    """One key with a third of all rows: ranks, lists, intervals and anchors against brute force."""
    data = [(0 if i % 3 == 0 else i % 50, i % 97, date(2001, 1, 1 + i % 28), f"m{i % 5}") for i in range(6000)]
    frame = spark.createDataFrame(data, "k int, v int, d date, m string").repartition(8)
    by_key: dict[int, list] = {}
    for row in data:
        by_key.setdefault(row[0], []).append(row)
    first = {r["k"]: r["v"] for r in ranking.first_row_per_key(frame, ["k"], [F.col("d").desc(), F.col("v").desc()]).collect()}
    assert first == {k: max((r[2], r[1]) for r in rs)[1] for k, rs in by_key.items()}
    top = ranking.top_rank_per_key(frame, ["k"], [("d", "desc_nulls_first"), ("m", "asc_nulls_last")])
    want = 0
    for rs in by_key.values():
        last = max(r[2] for r in rs)
        least = min(r[3] for r in rs if r[2] == last)
        want += sum(r[2] == last and r[3] == least for r in rs)
    assert top.count() == want
    listed = {r["k"]: r["ms"] for r in lists.distinct_lists(frame, ["k"], {"ms": "m"}).collect()}
    assert listed == {k: ", ".join(sorted({r[3] for r in rs})) for k, rs in by_key.items()}
    anchors = frame.select("k", F.col("d").alias("anchor"), "m").distinct()
    counted = ranges.count_year_before(anchors, frame, "k", "anchor", "d", "v", "n").collect()
    assert len(counted) == anchors.count()
    for r in counted:
        assert r["n"] == sum(x[2] < r["anchor"] for x in by_key[r["k"]])


def test_year_before_anchor_by_prefix_sums_on_one_key(spark, plan):
    """One key with 60,000 facts over 4,000 days and 4,000 anchors: no range join, counts exact."""
    import numpy as np

    rng = np.random.default_rng(3)
    base = date(1990, 1, 1).toordinal()
    days = rng.integers(0, 4000, 60_000)
    anchors_at = rng.choice(4200, 4000, replace=False)
    facts = spark.createDataFrame([("k", date.fromordinal(base + int(d)), i) for i, d in enumerate(days)], "k string, day date, id int")
    anchors = spark.createDataFrame([("k", date.fromordinal(base + int(a))) for a in anchors_at], "k string, anchor date")
    counted = ranges.count_year_before(anchors, facts, "k", "anchor", "day", "id", "n")
    text = plan(counted)
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
    ordinal = np.array([date.fromordinal(base + int(d)).toordinal() for d in days])
    for r in counted.collect():
        a = r["anchor"]
        lo = date(a.year - 1, a.month, a.day if not (a.month == 2 and a.day == 29) else 28).toordinal()
        assert r["n"] == int(np.sum((ordinal >= lo) & (ordinal < a.toordinal()))), a


def test_latest_rows_prune_the_scan(spark, tmp_path, plan):
    """The newest date reaches the parquet scan as a pushed filter; an empty scope gives no rows."""
    spark.createDataFrame([(1, date(2001, 1, 1)), (2, date(2001, 2, 1)), (3, date(2001, 2, 1))], "v int, d date").write.parquet(str(tmp_path / "s"))
    frame = spark.read.parquet(str(tmp_path / "s"))
    latest = snapshot.latest_rows(frame, "d")
    assert "EqualTo(d,2001-02-01)" in plan(latest).replace(" ", "") and sorted(r[0] for r in latest.collect()) == [2, 3]
    assert snapshot.latest_rows(frame, "d", scope=frame.where("v > 5")).count() == 0


def test_cross_one_row_refuses_more_rows(spark):
    frame = spark.range(3)
    assert lookup.cross_one_row(frame, spark.range(5).agg(F.sum("id").alias("s"))).count() == 3
    with pytest.raises(Exception, match="more than one row"):
        lookup.cross_one_row(frame, spark.range(2).toDF("s")).collect()


def test_rules_that_must_be_given():
    from fieldstats.plans.events import EventRules
    from fieldstats.plans.procedures import SnapshotRules

    with pytest.raises(TypeError):
        EventRules()
    with pytest.raises(ValueError, match="segment_pattern"):
        EventRules(product_patterns=(("a%", "A"),), mix_patterns=(("%A%", "A"),), segment_pattern="")
    with pytest.raises(ValueError, match="growth_classes"):
        SnapshotRules(growth_classes=(), training_type="t", growth_category="g")


def test_key_report_counts_nulls_repeats_and_orphans(spark):
    from fieldstats.operators.lookup import key_report

    rows = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 2), ("a", "x", 3), ("b", "x", 4), (None, "x", 5), ("c", None, 6), ("z", "y", 7)],
        "k string, j string, __n long",
    )
    parent = spark.createDataFrame([("a", "x", 0), ("b", "x", 0), ("b", "x", 0)], "pk string, pj string, __k0 long")
    r = key_report("t", rows, ["k", "j"], parent, ["pk", "pj"]).first().asDict()
    # keys a/x (three rows), b/x, z/y; two rows with a null key part; z/y is not in the parent
    assert r == {"table_name": "t", "rows": 7, "null_keys": 2, "distinct_keys": 3, "repeated_keys": 1, "extra_rows": 2, "orphan_keys": 1}
    plain = key_report("t", rows, ["k"]).first().asDict()
    assert (plain["distinct_keys"], plain["repeated_keys"], plain["null_keys"], plain["orphan_keys"]) == (4, 1, 1, None)


def test_key_report_on_an_empty_table_is_zeros(spark):
    from fieldstats.operators.lookup import key_report

    empty = spark.createDataFrame([], "k string")
    r = key_report("e", empty, ["k"], empty, ["k"]).collect()
    assert [x.asDict() for x in r] == [
        {"table_name": "e", "rows": 0, "null_keys": 0, "distinct_keys": 0, "repeated_keys": 0, "extra_rows": 0, "orphan_keys": 0}
    ]


def test_paged_lists_number_a_hot_key_across_partitions(spark):
    from fieldstats.operators.lists import paged_lists

    rows = [("hot", f"m{i:04d}", i) for i in range(1000)] + [("hot", "m0005", 0)]
    rows += [(None, "z", 1), (None, "a", 2), ("b", None, 3), ("b", "x", 4), ("b", "x", 5)]
    df = spark.createDataFrame(rows, "k string, m string, __m long").repartition(8)
    got = {(r.k, r.page): (r.members, r.text) for r in paged_lists(df, ["k"], "m", page_size=7).collect()}
    members = {"hot": [f"m{i:04d}" for i in range(1000)], None: ["a", "z"], "b": ["x"]}
    want = {}
    for k, ms in members.items():
        for p in range(0, len(ms), 7):
            want[(k, p // 7)] = (len(ms[p : p + 7]), ", ".join(ms[p : p + 7]))
    assert got == want
    empty = spark.createDataFrame([], "k string, m string")
    assert paged_lists(empty, ["k"], "m").collect() == []

"""Every registered query against its SQL on the smallest tables, and plan checks."""

import pytest

from __spark_entry__ import entry, oracle_sql
from compare import connect, difference, kinds
from workload import CHECKS, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS) and set(CHECKS) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    verdict = difference(df, con, oracle_sql()[name])
    assert verdict in (None, "no rows on either side")
    assert kinds(df, con, oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_no_query_filters_on_ids_or_samples():
    import inspect

    for name, function in QUERIES.items():
        source = inspect.getsource(function)
        for word in (".sample(", ".tail(", ".head(", ".take("):
            assert word not in source, name


@pytest.mark.parametrize(
    "name, pushed, columns",
    [
        ("filter_conj", "EqualTo(o_orderstatus,F)", "o_orderkey"),
        ("join_left_filtered", "EqualTo(o_orderpriority,5-LOW)", "o_orderpriority"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, plan, name, pushed, columns):
    text = plan(QUERIES[name](spark, FOLDER))
    assert pushed in text and columns in text


@pytest.mark.parametrize("name", ["tier_shift", "utilization", "account_scorecard", "activity_spine", "quarter_spine"])
def test_no_cartesian_product(spark, plan, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_population_reads_the_cases_once(spark, plan):
    text = plan(QUERIES["tier_shift"](spark, FOLDER))
    assert text.count("sf0.001/lineitem.parquet") == 1

"""The same queries on tables where single keys hold a third of all rows."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from compare import TABLES, connect, difference

FOLDER = "/root/testdata/sf0.001"

HOT = {
    "lineitem": """select case when rn % 3 = 0 then 7 else l_orderkey end as l_orderkey,
        case when rn % 3 = 0 then 11 else l_partkey end as l_partkey,
        case when rn % 3 = 0 then 3 else l_suppkey end as l_suppkey,
        * exclude (l_orderkey, l_partkey, l_suppkey, rn) from (select *, row_number() over () as rn from lineitem)""",
    "orders": """select o_orderkey, case when o_orderkey % 3 = 0 then 30 else o_custkey end as o_custkey,
        * exclude (o_orderkey, o_custkey) from orders""",
    "events": """select event_id, ts, case when event_id % 3 = 0 then 3 else user_id end as user_id,
        * exclude (event_id, ts, user_id) from events""",
}

NAMES = [
    "access_list", "tier_shift", "quarter_snapshot", "duration_population", "account_scorecard", "utilization",
    "app_usage", "event_log", "market_total", "trailing_year_count", "year_before_anchor", "validity_join",
    "prior_period_join", "latest_per_key", "earliest_per_key", "top_rank_ties", "latest_snapshot", "like_chain",
    "agg_count_distinct", "pivot_sum", "usage_rollup", "log_gap_filter", "join_inner", "join_comma",
    "join_left_enrich", "semi_exists", "semi_in", "activity_spine", "listagg_distinct", "run_rate",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    for table in TABLES:
        con.execute(f"copy ({HOT.get(table, f'select * from {table}')}) to '{folder}/{table}.parquet' (format parquet)")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query_on_skewed_tables(spark, skewed, name):
    verdict = difference(queries()[name](spark, skewed), connect(skewed), oracle_sql()[name])
    assert verdict is None


def test_hot_partition_of_a_row_level_join_is_split(spark, skewed):
    """With the size limits scaled down to the fixture, Spark splits the hot key's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.files.maxPartitionBytes": "16KB",
        "spark.sql.files.openCostInBytes": "1KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        split = tuple(name for name in ("join_inner", "join_comma", "duration_population", "tier_shift", "app_usage") if _split(spark, skewed, name))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "join_inner" in split and len(split) > 1, split


def _split(spark, folder, name) -> bool:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").repartition(16)
    lines.write.mode("overwrite").parquet(f"{folder}/../wide/lineitem.parquet")
    for table in TABLES:
        if table != "lineitem":
            spark.read.parquet(f"{folder}/{table}.parquet").write.mode("ignore").parquet(f"{folder}/../wide/{table}.parquet")
    df = queries()[name](spark, f"{folder}/../wide")
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()

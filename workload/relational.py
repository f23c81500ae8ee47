"""Projection, filter, join, aggregate, window and set operators on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstats.functions.dates import coalesced_in_range, quarter_index, quarter_key
from fieldstats.functions.text import first_like, in_class
from fieldstats.operators.combine import union_to_schema
from fieldstats.operators.lists import distinct_lists
from fieldstats.operators.lookup import cross_one_row, drop_members, keep_members, key_report
from fieldstats.operators.pivots import counts_where, firsts_where, sums_where
from fieldstats.operators.ranges import (
    as_prior_period,
    count_year_before,
    trailing_sum,
)
from fieldstats.operators.ranking import first_row_per_key, top_rank_per_key
from fieldstats.operators.snapshot import latest_rows
from fieldstats.operators.spine import activity_spine, calendar_spine, fill_gaps
from fieldstats.operators.tiers import DETAILED_TIERS, MODEL_TIERS, POPULATION_TIERS, activity_tier, volume_tier
from fieldstats.plans.events import product_mix
from fieldstats.plans.utilization import installed_by_quarter, systems_by_account, with_validity
from fieldstats.sources.readers import read_table
from fieldstats.session import scratch_path
from fieldstats.sources.sinks import bucketed_copy, read_refreshed, refresh_touched
from workload.bindings import PARAMS, SourceTables, as_ctes
from workload.common import order_day, ship_day, AS_OF, NEXT_QUARTER, QUARTER_FIRST, REGION, bins, key_of
from workload.products import EVENTS, INSTALLED_SQL, LINES_SQL, START_SQL, UTILIZATION
from workload.registry import query

#: Buckets of the copies that the bucketed join reads (the same for both tables).
BUCKETS = 8


# ------------------------------------------------------- projections and filters


@query(
    "project_alias",
    """select l_orderkey as "Case Number", l_quantity / 60 as "Duration (Hours)", l_returnflag as "GP/Others",
  l_linenumber as "# Line" from lineitem""",
)
def q_project_alias(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("Case Number"),
        (F.col("l_quantity") / 60).alias("Duration (Hours)"),
        F.col("l_returnflag").alias("GP/Others"),
        F.col("l_linenumber").alias("# Line"),
    )


@query(
    "star_extend",
    """select c.*, case when c_acctbal < 0 then 'debt' else 'credit' end as balance_side, n_name
  from customer c join nation on c_nationkey = n_nationkey""",
)
def q_star_extend(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    side = F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        customer["*"], side.alias("balance_side"), "n_name"
    )


PADDED = T.StructType(
    [
        T.StructField("branch", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("happened", T.DateType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("priority", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("props", T.StringType()),
    ]
)


@query(
    "union_padded",
    """select 'Capital' as branch, o_orderkey as id, cast(o_orderdate as date) as happened, o_totalprice as amount,
  o_orderpriority as priority, cast(null as varchar) as kind, cast(null as varchar) as props from orders
union all select 'Clinical', event_id, cast(ts as date), null, null, event_type, props from events""",
)
def q_union_padded(spark, sf_dir):
    capital = read_table(spark, sf_dir, "orders").select(
        F.lit("Capital").alias("branch"),
        F.col("o_orderkey").alias("id"),
        order_day().alias("happened"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("priority"),
    )
    clinical = read_table(spark, sf_dir, "events").select(
        F.lit("Clinical").alias("branch"),
        F.col("event_id").alias("id"),
        F.to_date("ts").alias("happened"),
        F.col("event_type").alias("kind"),
        "props",
    )
    return union_to_schema([capital, clinical], PADDED)


@query(
    "filter_conj",
    """select o_orderkey, o_custkey, o_totalprice from orders
  where o_orderstatus = 'F' and o_orderpriority = '1-URGENT' and o_totalprice > 100000""",
)
def q_filter_conj(spark, sf_dir):
    return (
        read_table(spark, sf_dir, "orders")
        .where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
        .where(F.col("o_totalprice") > 100000)
        .select("o_orderkey", "o_custkey", "o_totalprice")
    )


@query(
    "filter_quarter",
    f"""{as_ctes("procedures")} select recordid, casenumber, coalesce(proceduredatelocal, scheduledstartdate) as day
  from procedures where coalesce(proceduredatelocal, scheduledstartdate) >= {QUARTER_FIRST}
    and coalesce(proceduredatelocal, scheduledstartdate) < {NEXT_QUARTER}""",
)
def q_filter_quarter(spark, sf_dir):
    local, scheduled = F.col("proceduredatelocal"), F.col("scheduledstartdate")
    return (
        SourceTables(spark, sf_dir)["procedures"]
        .where(coalesced_in_range(local, scheduled, PARAMS.quarter_first, PARAMS.next_quarter_first))
        .select("recordid", "casenumber", F.coalesce(local, scheduled).alias("day"))
    )


@query(
    "filter_null",
    f"""{as_ctes("installbase")} select installbaseguid, name, financeinstalleddate, removedate from installbase
  where not (financeinstalleddate is null) and financedeinstalleddate is null and removedate <> financeinstalleddate""",
)
def q_filter_null(spark, sf_dir):
    return (
        SourceTables(spark, sf_dir)["installbase"]
        .where(F.col("financeinstalleddate").isNotNull() & F.col("financedeinstalleddate").isNull())
        .where(F.col("removedate") != F.col("financeinstalleddate"))
        .select("installbaseguid", "name", "financeinstalleddate", "removedate")
    )


@query(
    "filter_in",
    f"""{as_ctes("opportunity_line")} select opportunityid, dealtype, systemserialnumbercpq from opportunity_line
  where dealtype in ('Incremental', 'Trade-In', 'Trade-in') and systemserialnumbercpq not in ('1-URGENT', '5-LOW')""",
)
def q_filter_in(spark, sf_dir):
    lines = SourceTables(spark, sf_dir)["opportunity_line"]
    lines = keep_members(lines, "dealtype", ["Incremental", "Trade-In", "Trade-in"])
    return drop_members(lines, "systemserialnumbercpq", ["1-URGENT", "5-LOW"]).select(
        "opportunityid", "dealtype", "systemserialnumbercpq"
    )


@query(
    "filter_bool",
    f"""{as_ctes("opportunity_line")} select opportunityid, dealtype, case when deleted then 'gone' else 'kept' end as state
  from opportunity_line where systemline = true and not deleted""",
)
def q_filter_bool(spark, sf_dir):
    return (
        SourceTables(spark, sf_dir)["opportunity_line"]
        .where(F.col("systemline") & ~F.col("deleted"))
        .select("opportunityid", "dealtype", F.when(F.col("deleted"), "gone").otherwise("kept").alias("state"))
    )


CLASSES = ("SMALLBrand#1", "SMALLBrand#2", "LARGEBrand#3", "PROMOBrand#4", "PROMOBrand#4")


@query(
    "composite_class",
    f"""{as_ctes("procedures_typed")} select recordid, businesscategoryname, subject,
  case when businesscategoryname || subject in ('SMALLBrand#1', 'SMALLBrand#2', 'LARGEBrand#3', 'PROMOBrand#4')
    then 'Growth' else 'Others' end as bucket from procedures_typed""",
)
def q_composite_class(spark, sf_dir):
    bucket = in_class([F.col("businesscategoryname"), F.col("subject")], CLASSES, "Growth", "Others")
    return SourceTables(spark, sf_dir)["procedures_typed"].select(
        "recordid", "businesscategoryname", "subject", bucket.alias("bucket")
    )


@query(
    "like_chain",
    f"""{as_ctes("opportunity_line")}, {LINES_SQL} select opportunityid, deal_types, products, product_type from mix""",
)
def q_like_chain(spark, sf_dir):
    return product_mix(SourceTables(spark, sf_dir)["opportunity_line"], EVENTS)


@query(
    "tier_bins",
    f"""with n as (select l_suppkey, l_partkey, count(*) * 0.5 as halves, count(*) * 7 as sevens from lineitem
  group by 1, 2)
select l_suppkey, l_partkey, cast(halves as double) as halves, sevens,
  {bins("halves", POPULATION_TIERS)} as tier_of_halves, {bins("sevens", POPULATION_TIERS)} as tier,
  {bins("sevens", MODEL_TIERS)} as model_tier, {bins("sevens", DETAILED_TIERS)} as detailed from n""",
)
def q_tier_bins(spark, sf_dir):
    counted = read_table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    halves, sevens = F.col("n") * F.lit(0.5), F.col("n") * 7
    return counted.select(
        "l_suppkey",
        "l_partkey",
        halves.alias("halves"),
        sevens.alias("sevens"),
        activity_tier(halves, POPULATION_TIERS).alias("tier_of_halves"),
        activity_tier(sevens, POPULATION_TIERS).alias("tier"),
        activity_tier(sevens, MODEL_TIERS).alias("model_tier"),
        activity_tier(sevens, DETAILED_TIERS).alias("detailed"),
    )


@query(
    "label_case",
    f"""{as_ctes("account")} select accountguid, case when tier1 = true then 'Tier 1' when tier1 = false then 'Non-Tier 1' end as tier_label,
  case when tiertype = 'Tier 1' then 'Tier 1' when tiertype = 'Tier 2' then 'Tier 2' else 'Others' end as tier_group,
  case when japancustomersegment like '%Top 300%' then 'Top 200' else 'Non-Top 200' end as segment,
  case when tiertype <> 'Tier 1' and recordtype = 'Hospital' then 'open' when tiertype = 'Tier 1' then 'held'
    else 'Others' end as decision from account""",
)
def q_label_case(spark, sf_dir):
    tier = F.col("tiertype")
    return SourceTables(spark, sf_dir)["account"].select(
        "accountguid",
        F.when(F.col("tier1"), "Tier 1").when(~F.col("tier1"), "Non-Tier 1").alias("tier_label"),
        F.when(tier.isin("Tier 1", "Tier 2"), tier).otherwise("Others").alias("tier_group"),
        first_like(F.col("japancustomersegment"), [("%Top 300%", "Top 200")], "Non-Top 200").alias("segment"),
        F.when((tier != "Tier 1") & (F.col("recordtype") == "Hospital"), "open")
        .when(tier == "Tier 1", "held")
        .otherwise("Others")
        .alias("decision"),
    )


@query(
    "override_dates",
    f"""{as_ctes("installbase")} select installbaseguid, accountid, name, {START_SQL} as start_quarter from installbase i""",
)
def q_override_dates(spark, sf_dir):
    return with_validity(SourceTables(spark, sf_dir)["installbase"], UTILIZATION).select(
        "installbaseguid", "accountid", "name", "start_quarter"
    )


def _key_report_sql(name: str, rows: str, keys: list[str], parent: str | None = None) -> str:
    """The counters of ``key_report`` for one table in SQL; ``parent`` selects the same key columns."""
    cols = ", ".join(keys)
    unknown = " or ".join(f"{k} is null" for k in keys)
    held = (
        f"left join (select distinct {cols}, true as held from ({parent})) p using ({cols})"
        if parent
        else "cross join (select cast(null as boolean) as held) p"
    )
    orphans = "count(case when not nul and held is null then 1 end)" if parent else "null"
    return f"""select '{name}' as table_name, cast(coalesce(sum(n), 0) as bigint) as rows,
  cast(coalesce(sum(case when nul then n end), 0) as bigint) as null_keys,
  cast(count(case when not nul then 1 end) as bigint) as distinct_keys,
  cast(count(case when not nul and n > 1 then 1 end) as bigint) as repeated_keys,
  cast(coalesce(sum(case when not nul and n > 1 then n - 1 end), 0) as bigint) as extra_rows,
  cast({orphans} as bigint) as orphan_keys
from (select {cols}, ({unknown}) as nul, count(*) as n from ({rows}) group by all) g {held}"""


def _values_sql(rows, names: list[str]) -> str:
    listed = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return f"select * from (values {listed}) t({', '.join(names)})"


_CODE_MAP_SQL = """select ' a' || lpad(cast(p_size as varchar), 3, '0') || ' ' as code from (select distinct p_size from part where p_size <= 40)
  union all select ' a020 ' from part where p_size = 20 group by p_size"""

KEY_SQL = f"""{as_ctes("installbase")}
{_key_report_sql("account_overrides", _values_sql(UTILIZATION.account_overrides, ["accountid", "name", "start"]), ["accountid", "name"],
                 "select accountid, name from installbase")}
union all
{_key_report_sql("system_overrides", _values_sql(UTILIZATION.system_overrides, ["name", "start"]), ["name"], "select name from installbase")}
union all
{_key_report_sql("code_map", _CODE_MAP_SQL, ["code"])}"""


@query("key_constraints", KEY_SQL)
def q_key_constraints(spark, sf_dir):
    """Key counters of the lookups the products join: the two override lists (against the installed base) and the code map."""
    from workload.files import code_map

    systems = SourceTables(spark, sf_dir)["installbase"]
    account = spark.createDataFrame(list(UTILIZATION.account_overrides), "accountid string, name string, start string")
    system = spark.createDataFrame(list(UTILIZATION.system_overrides), "name string, start string")
    return (
        key_report("account_overrides", account, ["accountid", "name"], systems, ["accountid", "name"])
        .unionByName(key_report("system_overrides", system, ["name"], systems, ["name"]))
        .unionByName(key_report("code_map", code_map(spark, sf_dir), ["code"]))
    )


@query(
    "lateral_alias",
    """select o_custkey, n, 'n=' || n as label, length('n=' || n)::int as label_length, n * 2 + 1 as twice
  from (select o_custkey, count(*) as n from orders group by 1)""",
)
def q_lateral_alias(spark, sf_dir):
    return spark.sql(
        """select o_custkey, count(*) as n, 'n=' || n as label, length(label) as label_length, n * 2 + 1 as twice
           from {orders} group by o_custkey""",
        orders=read_table(spark, sf_dir, "orders"),
    )


@query(
    "cast_compare",
    f"""select o_orderkey, {key_of("o_orderdate")} as quarter, cast(o_orderdate as date) as day from orders
  where cast(left({key_of("o_orderdate")}, 4) as int) >= 1998
    and cast(o_orderdate as date) >= cast((year({AS_OF}) - 4) || '-01-01' as date)""",
)
def q_cast_compare(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").withColumn("day", order_day()).withColumn("quarter", quarter_key(order_day()))
    first_day = F.concat(F.lit(PARAMS.as_of.year - 4), F.lit("-01-01")).cast("date")
    return orders.where((F.left("quarter", F.lit(4)).cast("int") >= 1998) & (F.col("day") >= first_day)).select(
        "o_orderkey", "quarter", "day"
    )


# ------------------------------------------------------------------------- joins


@query(
    "join_inner",
    """select l_orderkey, l_linenumber, o_custkey, o_orderpriority from lineitem
  inner join orders on l_orderkey = o_orderkey""",
)
def q_join_inner(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return (
        read_table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "l_linenumber", "o_custkey", "o_orderpriority")
    )


@query(
    "join_comma",
    """select l_orderkey, l_linenumber, c_name, p_type, o_orderpriority from lineitem, orders, customer, part
  where l_orderkey = o_orderkey and o_custkey = c_custkey and l_partkey = p_partkey""",
)
def q_join_comma(spark, sf_dir):
    return spark.sql(
        """select l_orderkey, l_linenumber, c_name, p_type, o_orderpriority
           from {lineitem}, {orders}, {customer}, {part}
           where l_orderkey = o_orderkey and o_custkey = c_custkey and l_partkey = p_partkey""",
        **{name: read_table(spark, sf_dir, name) for name in ("lineitem", "orders", "customer", "part")},
    )


@query(
    "join_left_enrich",
    """select o_orderkey, c_name, n_name, r_name, p.s_name as partner from orders left join customer on o_custkey = c_custkey
  left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey
  left join supplier p on o_custkey = p.s_suppkey""",
)
def q_join_left_enrich(spark, sf_dir):
    table = {n: read_table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "region", "supplier")}
    where = (
        table["customer"]
        .join(table["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    return (
        table["orders"]
        .join(where, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(table["supplier"], F.col("o_custkey") == F.col("s_suppkey"), "left")
        .select("o_orderkey", "c_name", "n_name", "r_name", F.col("s_name").alias("partner"))
    )


@query(
    "join_left_filtered",
    """select l_orderkey, l_linenumber, o_orderpriority from lineitem left join orders on l_orderkey = o_orderkey
  where o_orderpriority = '5-LOW' and o_totalprice > 400000""",
)
def q_join_left_filtered(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return (
        read_table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .where("o_orderpriority = '5-LOW' and o_totalprice > 400000")
        .select("l_orderkey", "l_linenumber", "o_orderpriority")
    )


@query(
    "join_bucketed",
    """select o_orderkey, o_orderpriority, count(*) as lines, sum(l_quantity) as quantity
  from orders join lineitem on o_orderkey = l_orderkey group by 1, 2""",
)
def q_join_bucketed(spark, sf_dir):
    """Orders and their lines from copies bucketed on the order key: join and grouping shuffle nothing."""
    tag = uuid.uuid4().hex[:12]
    orders = bucketed_copy(read_table(spark, sf_dir, "orders"), f"orders_by_key_{tag}", "o_orderkey", BUCKETS)
    lines = bucketed_copy(read_table(spark, sf_dir, "lineitem"), f"lineitem_by_key_{tag}", "l_orderkey", BUCKETS)
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_orderkey", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    )


#: The quarter whose returned lines arrive late in ``refresh_by_quarter``.
LATE_QUARTER = 1995 * 4 + 1


def _lines_by_quarter(lines):
    return lines.groupBy(quarter_index(ship_day()).alias("quarter_index"), "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    "refresh_by_quarter",
    """select cast(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 as int) as quarter_index, l_returnflag, count(*) as n,
  round(sum(l_quantity), 2) as quantity from lineitem group by 1, 2""",
)
def q_refresh_by_quarter(spark, sf_dir):
    """Lines per ship quarter kept by quarter: a first run before the returned lines of one quarter came in, a second
    after; the second rewrites that quarter only, and the table equals a full run."""
    lines = read_table(spark, sf_dir, "lineitem")
    late = (F.col("l_returnflag") == "R") & (quarter_index(ship_day()) == LATE_QUARTER)
    path = scratch_path(spark, "by_quarter")
    for now in (lines.where(~late), lines):
        refresh_touched(
            lambda quarters, now=now: _lines_by_quarter(now.where(quarter_index(ship_day()).isin(quarters))),
            now,
            quarter_index(ship_day()),
            path,
        )
    return read_refreshed(spark, path)


@query(
    "join_full",
    """select u.user_id, v.c_custkey, u.n as events, v.n as orders from
  (select user_id, count(*) as n from events group by 1) u full join
  (select o_custkey + 75 as c_custkey, count(*) as n from orders group by 1) v on u.user_id = v.c_custkey""",
)
def q_join_full(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("events"))
    orders = (
        read_table(spark, sf_dir, "orders")
        .groupBy((F.col("o_custkey") + 75).alias("c_custkey"))
        .agg(F.count("*").alias("orders"))
    )
    return events.join(orders, F.col("user_id") == F.col("c_custkey"), "full")


@query(
    "cross_scalar",
    """select c_custkey, c_mktsegment, total_orders, urgent from customer
  cross join (select count(o_orderkey) as total_orders, count(case when o_orderpriority = '1-URGENT' then 1 end) as urgent
    from orders)""",
)
def q_cross_scalar(spark, sf_dir):
    totals = read_table(spark, sf_dir, "orders").agg(
        F.count("o_orderkey").alias("total_orders"),
        *counts_where({"urgent": F.col("o_orderpriority") == "1-URGENT"}, F.lit(1)),
    )
    return cross_one_row(read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), totals)


@query(
    "quarter_spine",
    f"""{as_ctes("account")} select accountguid, q.quarter, cast(q.i as int) as quarter_index from account cross join
  (select distinct year(g) || '-Q' || quarter(g) as quarter, year(g) * 4 + quarter(g) - 1 as i
   from generate_series(timestamp '1995-01-01', timestamp '2005-12-31', interval 1 day) t(g)
   where year(g) between 1995 and 2001) q
  where accountguid in (select accountguid from account where clinicalregion = {REGION})""",
)
def q_quarter_spine(spark, sf_dir):
    accounts = SourceTables(spark, sf_dir)["account"].where(F.col("clinicalregion") == PARAMS.region)
    return calendar_spine(accounts.select("accountguid"), 1995 * 4, 2001 * 4 + 3)


@query(
    "activity_spine",
    f"""with f as (select o_custkey, min(cast(o_orderdate as date)) as first_day from orders group by 1),
  q as (select distinct {key_of("g")} as quarter, year(g) * 4 + quarter(g) - 1 as i
    from generate_series(timestamp '1997-01-01', timestamp '2001-06-30', interval 1 month) t(g))
select o_custkey, first_day, quarter, cast(i as int) as quarter_index from f cross join q
where {key_of("first_day")} <= quarter""",
)
def q_activity_spine(spark, sf_dir):
    firsts = read_table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(order_day()).alias("first_day"))
    return activity_spine(firsts, quarter_index(F.col("first_day")), 1997 * 4, PARAMS.quarter_index)


@query(
    "join_multikey",
    """with a as (select o_custkey, o_orderpriority, count(*) as orders from orders group by 1, 2),
  b as (select o_custkey, o_orderpriority, max(o_totalprice) as largest from orders group by 1, 2)
select a.o_custkey, a.o_orderpriority, a.orders, b.largest from a left join b
  on a.o_custkey = b.o_custkey and a.o_orderpriority = b.o_orderpriority""",
)
def q_join_multikey(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    keys = ["o_custkey", "o_orderpriority"]
    largest = orders.groupBy(*keys).agg(F.max("o_totalprice").alias("largest"))
    return orders.groupBy(*keys).agg(F.count("*").alias("orders")).join(largest, keys, "left")


@query(
    "trailing_year_count",
    f"""with quarters as (select cast(g as date) as qs, year(g) * 4 + quarter(g) - 1 as i
   from generate_series(timestamp '1996-01-01', timestamp '2001-04-01', interval 3 month) t(g)),
 firsts as (select l_suppkey, min(cast(l_shipdate as date)) as f from lineitem group by 1),
 spine as (select l_suppkey, qs, i from firsts cross join quarters where {key_of("f")} <= {key_of("qs")})
select s.l_suppkey, cast(s.i as int) as quarter_index, count(l.l_orderkey) as past_year from spine s left join lineitem l
  on l.l_suppkey = s.l_suppkey and l.l_shipdate >= s.qs - interval 9 month and l.l_shipdate < s.qs + interval 3 month
group by 1, 2""",
)
def q_trailing_year_count(spark, sf_dir):
    quarterly = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", quarter_index(ship_day()).alias("quarter_index"))
        .agg(F.count("l_orderkey").alias("n"))
    )
    filled = fill_gaps(quarterly, "l_suppkey", PARAMS.quarter_index, ["n"])
    counted = filled.withColumn("past_year", F.coalesce(trailing_sum("l_suppkey", F.col("n")), F.lit(0)))
    return counted.where(F.col("quarter_index") >= 1996 * 4).select("l_suppkey", "quarter_index", "past_year")


@query(
    "year_before_anchor",
    """with anchors as (select distinct o_custkey, cast(o_orderdate as date) as anchor from orders)
select a.o_custkey, a.anchor, count(o.o_orderkey) as before_anchor from anchors a left join orders o
  on a.o_custkey = o.o_custkey and a.anchor > cast(o.o_orderdate as date)
  and a.anchor - interval 1 year <= cast(o.o_orderdate as date) group by 1, 2""",
)
def q_year_before_anchor(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    anchors = orders.select("o_custkey", order_day().alias("anchor")).distinct()
    return count_year_before(anchors, orders, "o_custkey", "anchor", "o_orderdate", "o_orderkey", "before_anchor")


@query(
    "validity_join",
    f"""{INSTALLED_SQL} select accountguid, name, system_model, cast(flag as int) as quarter_index, number_of_ib,
  fleet_or_not, combination from fleet""",
)
def q_validity_join(spark, sf_dir):
    tables = SourceTables(spark, sf_dir)
    region = tables["account"].where(F.col("clinicalregion") == PARAMS.region).select("accountguid")
    return installed_by_quarter(systems_by_account(tables["installbase"], region, UTILIZATION), UTILIZATION, PARAMS)


@query(
    "prior_period_join",
    """with n as (select l_suppkey, l_returnflag, year(l_shipdate) * 4 + quarter(l_shipdate) - 1 as i, count(*) as n
  from lineitem group by 1, 2, 3)
select c.l_suppkey, c.l_returnflag, cast(c.i as int) as quarter_index, c.n, p.n as previous from n c left join n p
  on p.l_suppkey = c.l_suppkey and p.l_returnflag = c.l_returnflag and p.i + 1 = c.i""",
)
def q_prior_period_join(spark, sf_dir):
    counted = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_returnflag", quarter_index(ship_day()).alias("quarter_index"))
        .agg(F.count("*").alias("n"))
    )
    previous = as_prior_period(counted, "quarter_index", {"n": "previous"})
    return counted.join(previous, ["l_suppkey", "l_returnflag", "quarter_index"], "left")


@query(
    "semi_exists",
    f"""{as_ctes("account")} select o_orderkey, o_custkey from orders o where exists
  (select 1 from account a where a.accountguid = o.o_custkey and a.capitalregion = {REGION} and a.recordtype = 'Hospital')""",
)
def q_semi_exists(spark, sf_dir):
    tables = SourceTables(spark, sf_dir)
    hospitals = tables["account"].where(
        (F.col("capitalregion") == PARAMS.region) & (F.col("recordtype") == PARAMS.record_type)
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(hospitals, orders["o_custkey"] == hospitals["accountguid"], "left_semi")


@query(
    "semi_in",
    """select l_orderkey, l_linenumber, l_partkey from lineitem
  where l_partkey in (select p_partkey from part where p_type = 'PROMO' and p_size < 10)""",
)
def q_semi_in(spark, sf_dir):
    parts = read_table(spark, sf_dir, "part").where("p_type = 'PROMO' and p_size < 10").select("p_partkey")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return keep_members(lines, "l_partkey", parts)


@query(
    "latest_snapshot",
    f"""{as_ctes("account", "third_party_volume")},
 scoped as (select * from third_party_volume where accountguid in (select accountguid from account where capitalregion = {REGION}))
select accountguid, cast(sum(totalvolume) as bigint) as total from (select distinct accountguid, proceduresubject, totalvolume, date
  from scoped where date = (select max(date) from scoped)) group by 1""",
)
def q_latest_snapshot(spark, sf_dir):
    tables = SourceTables(spark, sf_dir)
    region = tables["account"].where(F.col("capitalregion") == PARAMS.region).select("accountguid")
    volumes = tables["third_party_volume"]
    newest = volumes.groupBy("accountguid").agg(F.max("date").alias("date")).join(region, "accountguid", "left_semi")
    latest = latest_rows(volumes, "date", scope=newest).distinct()
    summed = latest.groupBy("accountguid").agg(F.sum("totalvolume").alias("total"))
    return summed.join(region, "accountguid", "left_semi")


@query(
    "join_computed_key",
    f"""{as_ctes("procedures", "account_quota")},
 q as (select accountguid, fiscalyear || '-' || quarter as k, round(sum(coalesce(forecast, 0)), 2) as forecast from account_quota group by 1, 2)
select p.recordid, {key_of("coalesce(p.proceduredatelocal, p.scheduledstartdate)")} as quarter, round(q.forecast, 2) as forecast
from procedures p left join q on q.accountguid = p.accountguid
  and q.k = {key_of("coalesce(p.proceduredatelocal, p.scheduledstartdate)")}""",
)
def q_join_computed_key(spark, sf_dir):
    tables = SourceTables(spark, sf_dir)
    quota = (
        tables["account_quota"]
        .groupBy("accountguid", F.concat("fiscalyear", F.lit("-"), "quarter").alias("quarter"))
        .agg(F.round(F.sum(F.coalesce("forecast", F.lit(0.0))), 2).alias("forecast"))
    )
    day = F.coalesce("proceduredatelocal", "scheduledstartdate")
    cases = tables["procedures"].select("recordid", "accountguid", quarter_key(day).alias("quarter"))
    return cases.join(quota, ["accountguid", "quarter"], "left").select("recordid", "quarter", "forecast")


@query(
    "join_role_playing",
    """select e.event_id, a.c_name as assigned_to, b.c_name as created_by from events e
  left join customer a on e.user_id = a.c_custkey left join customer b on e.user_id + 100 = b.c_custkey""",
)
def q_join_role_playing(spark, sf_dir):
    names = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    events = read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", (F.col("user_id") + 100).alias("created_id")
    )
    return (
        events.join(names.toDF("user_id", "assigned_to"), "user_id", "left")
        .join(names.toDF("created_id", "created_by"), "created_id", "left")
        .select("event_id", "assigned_to", "created_by")
    )


# ------------------------------------------------------------------ aggregations


@query(
    "agg_count",
    f"""{as_ctes("procedures")} select surgeonguid, count(*) as cases, count(proceduredatelocal) as dated
  from procedures group by 1""",
)
def q_agg_count(spark, sf_dir):
    return (
        SourceTables(spark, sf_dir)["procedures"]
        .groupBy("surgeonguid")
        .agg(F.count("*").alias("cases"), F.count("proceduredatelocal").alias("dated"))
    )


@query(
    "agg_count_distinct",
    """select l_suppkey, count(distinct l_orderkey) as orders, count(l_orderkey) as lines from lineitem group by 1""",
)
def q_agg_count_distinct(spark, sf_dir):
    return (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.count_distinct("l_orderkey").alias("orders"), F.count("l_orderkey").alias("lines"))
    )


@query(
    "agg_sum",
    """select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as quantity, round(sum(l_extendedprice), 2) as price,
  cast(sum(l_linenumber) as bigint) as numbers from lineitem group by 1, 2""",
)
def q_agg_sum(spark, sf_dir):
    return (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.sum("l_quantity"), 2).alias("quantity"),
            F.round(F.sum("l_extendedprice"), 2).alias("price"),
            F.sum("l_linenumber").alias("numbers"),
        )
    )


@query(
    "agg_min_max",
    """select o_custkey, min(cast(o_orderdate as date)) as first_day, max(cast(o_orderdate as date)) as last_day,
  max(o_totalprice) as largest from orders group by 1""",
)
def q_agg_min_max(spark, sf_dir):
    return (
        read_table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min(order_day()).alias("first_day"), F.max(order_day()).alias("last_day"), F.max("o_totalprice").alias("largest"))
    )


@query(
    "pivot_count",
    f"""select o_custkey, count(case when o_orderdate >= {QUARTER_FIRST} and o_orderdate < {NEXT_QUARTER} then o_orderkey end) as running,
  count(case when o_orderdate < {QUARTER_FIRST} and o_orderdate >= {QUARTER_FIRST} - interval 3 month then o_orderkey end) as previous,
  count(case when year(o_orderdate) = year({AS_OF}) - 1 then o_orderkey end) as last_year from orders group by 1""",
)
def q_pivot_count(spark, sf_dir):
    first, following = F.lit(PARAMS.quarter_first), F.lit(PARAMS.next_quarter_first)
    conditions = {
        "running": (order_day() >= first) & (order_day() < following),
        "previous": (order_day() >= F.lit(PARAMS.previous_quarter_first)) & (order_day() < first),
        "last_year": F.year(order_day()) == PARAMS.as_of.year - 1,
    }
    orders = read_table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(*counts_where(conditions, F.col("o_orderkey")))


@query(
    "pivot_sum",
    """select user_id, cast(sum(case when event_type = 'view' then 1 end) as bigint) as views,
  cast(sum(case when event_type = 'purchase' and value > 100 then 1 end) as bigint) as large_purchases,
  cast(sum(case when event_type = 'purchase' and value > 100 then 1 else 0 end) as bigint) as large_or_zero from events group by 1""",
)
def q_pivot_sum(spark, sf_dir):
    large = (F.col("event_type") == "purchase") & (F.col("value") > 100)
    return (
        read_table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            *sums_where({"views": F.col("event_type") == "view", "large_purchases": large}, F.lit(1)),
            *sums_where({"large_or_zero": large}, F.lit(1), empty_as_zero=True),
        )
    )


@query(
    "pivot_first_date",
    """select l_suppkey, min(cast(l_shipdate as date)) as first_any,
  min(case when p_type = 'SMALL' then cast(l_shipdate as date) end) as first_small,
  min(case when p_type = 'PROMO' and p_size > 48 then cast(l_shipdate as date) end) as first_promo
from lineitem join part on l_partkey = p_partkey group by 1""",
)
def q_pivot_first_date(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    lines = read_table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    conditions = {
        "first_any": F.lit(True),
        "first_small": F.col("p_type") == "SMALL",
        "first_promo": (F.col("p_type") == "PROMO") & (F.col("p_size") > 48),
    }
    return lines.groupBy("l_suppkey").agg(*firsts_where(conditions, ship_day()))


@query(
    "listagg_distinct",
    f"""{as_ctes("account_team")} select csmnetworkid, string_agg(distinct csdnetworkid, ', ' order by csdnetworkid desc) as directors,
  string_agg(distinct ssmnetworkid, ', ' order by ssmnetworkid desc) as managers from account_team group by 1""",
)
def q_listagg_distinct(spark, sf_dir):
    team = SourceTables(spark, sf_dir)["account_team"]
    lists = {"directors": "csdnetworkid", "managers": "ssmnetworkid"}
    return distinct_lists(team, ["csmnetworkid"], lists, descending=True)


@query("distinct_rows", "select distinct l_suppkey, l_returnflag, year(l_shipdate)::int as year from lineitem")
def q_distinct_rows(spark, sf_dir):
    return (
        read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", F.year(ship_day()).alias("year")).distinct()
    )


@query(
    "group_forms",
    f"""select {key_of("o_orderdate")} as quarter, o_orderstatus, o_orderpriority, count(*) as n from orders group by all""",
)
def q_group_forms(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    by_expression = spark.sql(
        """select year(o_orderdate) || '-Q' || quarter(o_orderdate) as quarter, o_orderstatus, o_orderpriority, count(*) as n
           from {orders} group by year(o_orderdate) || '-Q' || quarter(o_orderdate), o_orderstatus, o_orderpriority""",
        orders=orders,
    )
    return spark.sql(
        "select quarter, o_orderstatus, o_orderpriority, sum(n) as n from {grouped} group by all", grouped=by_expression
    )


@query(
    "agg_then_bin",
    f"""with n as (select l_suppkey, {key_of("l_shipdate")} as quarter, count(distinct l_orderkey) as n, sum(l_quantity) / 60 as v
  from lineitem group by 1, 2)
select l_suppkey, quarter, case when n >= 13 then 'Sustainable+' when n >= 7 then 'Bubble' when n = 0 then 'Non-Active' else 'Dabbler' end as by_count,
  case when v >= 13 then 'Sustainable+' when v >= 7 then 'Bubble' when v = 0 then 'Non-Active' else 'Dabbler' end as by_volume from n""",
)
def q_agg_then_bin(spark, sf_dir):
    grouped = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", quarter_key(ship_day()).alias("quarter"))
        .agg(F.count_distinct("l_orderkey").alias("n"), (F.sum("l_quantity") / 60).alias("v"))
    )
    return grouped.select(
        "l_suppkey",
        "quarter",
        volume_tier(F.col("n")).alias("by_count"),
        volume_tier(F.col("v")).alias("by_volume"),
    )


# ----------------------------------------------------------- windows and ordering


@query(
    "latest_per_key",
    """select o_custkey, o_orderkey, cast(o_orderdate as date) as day, o_orderstatus from (select *,
  row_number() over (partition by o_custkey order by cast(o_orderdate as date) desc, o_orderkey) as rn from orders) where rn = 1""",
)
def q_latest_per_key(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", order_day().alias("day"), "o_orderstatus")
    return first_row_per_key(orders, ["o_custkey"], [F.col("day").desc_nulls_first(), F.col("o_orderkey").asc()])


@query(
    "earliest_per_key",
    f"""select o_custkey, o_orderkey, cast(o_orderdate as date) as day from (select *,
  row_number() over (partition by o_custkey order by cast(o_orderdate as date), o_orderkey) as rn from orders) where rn = 1""",
)
def q_earliest_per_key(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", order_day().alias("day"))
    return first_row_per_key(orders, ["o_custkey"], [F.col("day").asc(), F.col("o_orderkey").asc()])


@query(
    "top_rank_ties",
    f"""{as_ctes("installbase")} select accountguid, installbaseguid, financedeinstalleddate, name from (select *,
  rank() over (partition by accountguid order by financedeinstalleddate desc nulls first, name nulls last) as r from installbase) where r = 1""",
)
def q_top_rank_ties(spark, sf_dir):
    systems = SourceTables(spark, sf_dir)["installbase"].select(
        "accountguid", "installbaseguid", "financedeinstalleddate", "name"
    )
    order = [("financedeinstalleddate", "desc_nulls_first"), ("name", "asc_nulls_last")]
    return top_rank_per_key(systems, ["accountguid"], order)


@query(
    "head_sorted",
    """select l_suppkey, l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2, 3
  order by l_suppkey, l_returnflag, l_linestatus limit 10""",
)
def q_head_sorted(spark, sf_dir):
    keys = ["l_suppkey", "l_returnflag", "l_linestatus"]
    grouped = read_table(spark, sf_dir, "lineitem").groupBy(*keys).agg(F.count("*").alias("n"))
    return grouped.orderBy(*keys).limit(10)

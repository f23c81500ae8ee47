"""Scalar functions, calendar rules and single domain operators on the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fieldstats.functions.dates import (
    index_key,
    index_start,
    minutes_between,
    quarter_index,
    quarter_key,
    quarter_label,
    quarter_start,
    shift_quarters,
    shift_zone,
    week_cutoff,
    week_index,
    week_of_quarter,
)
from fieldstats.functions.text import (

    SUBTOTAL_PATTERN,
    extract_or_null,
    leading_code,
    plain_integer,
    without_match,
)
from fieldstats.operators.lookup import cross_one_row
from fieldstats.operators.runrate import projected, run_rate_calendar
from fieldstats.plans.population import quarterly_activity
from fieldstats.plans.procedures import prior_quarter_cohort
from fieldstats.plans.usage import page_usage, prior_quarter_flag, two_quarters_prior_flag
from fieldstats.sources.readers import read_table
from workload.bindings import PARAMS, SourceTables, as_ctes
from workload.common import order_day, AS_OF, CUTOFF, PREVIOUS_QUARTER, QUARTER_FIRST, REGION, key_of, rounded
from workload.products import USAGE
from workload.registry import query



@query(
    "fn_string",
    """select c_custkey, c_name || '/' || c_mktsegment as joined, case when c_acctbal > 0 then c_name end || '!' as null_kept,
  cast(length(c_name) as int) as name_length, left(c_name, 8) as head, cast(c_custkey as varchar) as key_text,
  upper(trim(' ' || lower(c_mktsegment) || ' ')) as cleaned from customer""",
)
def q_fn_string(spark, sf_dir):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return read_table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(name, F.lit("/"), segment).alias("joined"),
        F.concat(F.when(F.col("c_acctbal") > 0, name), F.lit("!")).alias("null_kept"),
        F.length(name).alias("name_length"),
        F.left(name, F.lit(8)).alias("head"),
        F.col("c_custkey").cast("string").alias("key_text"),
        F.upper(F.trim(F.concat(F.lit(" "), F.lower(segment), F.lit(" ")))).alias("cleaned"),
    )


@query(
    "fn_date",
    f"""select o_orderkey, cast(year(o_orderdate) as int) as y, cast(quarter(o_orderdate) as int) as q,
  cast(date_trunc('quarter', o_orderdate) as date) as quarter_first,
  cast(date_trunc('quarter', o_orderdate) - interval 3 month as date) as previous_first,
  cast(cast(o_orderdate as date) - interval 9 month as date) as nine_months_back,
  cast(o_orderdate as date) - 90 as ninety_days_back, cast(cast(o_orderdate as date) - interval 1 year as date) as year_back,
  'Q' || quarter(o_orderdate) || '-' || year(o_orderdate) as label from orders""",
)
def q_fn_date(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year(order_day()).alias("y"),
        F.quarter(order_day()).alias("q"),
        quarter_start(order_day()).alias("quarter_first"),
        shift_quarters(order_day(), -1).alias("previous_first"),
        F.add_months(order_day(), -9).alias("nine_months_back"),
        F.date_sub(order_day(), 90).alias("ninety_days_back"),
        F.add_months(order_day(), -12).alias("year_back"),
        quarter_label(order_day()).alias("label"),
    )


@query(
    "fn_timezone",
    """select event_id, ts + interval 9 hour as seoul, ts - interval 8 hour as los_angeles,
  cast(ts + interval 9 hour as date) as local_day from events""",
)
def q_fn_timezone(spark, sf_dir):
    seoul = shift_zone(F.col("ts"), "GMT", "Asia/Seoul")
    return read_table(spark, sf_dir, "events").select(
        "event_id",
        seoul.alias("seoul"),
        shift_zone(F.col("ts"), "GMT", "America/Los_Angeles").alias("los_angeles"),
        F.to_date(seoul).alias("local_day"),
    )


@query(
    "fn_null",
    f"""{as_ctes("installbase")} select installbaseguid, coalesce(financeinstalleddate, installdate) as installed,
  coalesce(removedate, financedeinstalleddate, date '9999-12-31') as ended,
  case when removedate is null then 'open' else 'ended' end as state from installbase""",
)
def q_fn_null(spark, sf_dir):
    return SourceTables(spark, sf_dir)["installbase"].select(
        "installbaseguid",
        F.coalesce("financeinstalleddate", "installdate").alias("installed"),
        F.coalesce("removedate", "financedeinstalleddate", F.lit(date(9999, 12, 31))).alias("ended"),
        F.when(F.col("removedate").isNull(), "open").otherwise("ended").alias("state"),
    )


@query(
    "fn_math",
    f"""{as_ctes("procedures")} select recordid, round(proceduredurationinseconds / 60, 6) as minutes,
  round(proceduredurationinseconds / 60 / 60, 6) as hours, round(proceduredurationinseconds * 4 - 100 + 1, 6) as mixed from procedures""",
)
def q_fn_math(spark, sf_dir):
    seconds = F.col("proceduredurationinseconds")
    cases = SourceTables(spark, sf_dir)["procedures"].select(
        "recordid",
        (seconds / 60).alias("minutes"),
        (seconds / 60 / 60).alias("hours"),
        (seconds * 4 - 100 + 1).alias("mixed"),
    )
    return rounded(cases, 6)


@query(
    "fn_quarter_key",
    f"""select o_orderkey, {key_of("o_orderdate")} as quarter, cast(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 as int) as quarter_index,
  {key_of("o_orderdate")} as quarter_of_index, cast(date_trunc('quarter', o_orderdate) as date) as first_day
from orders where {key_of("o_orderdate")} >= '1998-Q2'""",
)
def q_fn_quarter_key(spark, sf_dir):
    index = F.col("quarter_index")
    return (
        read_table(spark, sf_dir, "orders")
        .select("o_orderkey", quarter_key(order_day()).alias("quarter"), quarter_index(order_day()).alias("quarter_index"))
        .where(F.col("quarter") >= "1998-Q2")
        .withColumns({"quarter_of_index": index_key(index), "first_day": index_start(index)})
    )


@query(
    "week_cutoff",
    """select distinct cast(o_orderdate as date) as day,
  cast(o_orderdate as date) - cast(dayofweek(o_orderdate) as int) - 2 as cutoff from orders""",
)
def q_week_cutoff(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(order_day().alias("day"), week_cutoff(order_day()).alias("cutoff")).distinct()


@query(
    "week_of_quarter",
    """with d as (select distinct cast(o_orderdate as date) as day, cast(date_trunc('quarter', o_orderdate) as date) as qf from orders)
select day, cast(((day - dayofweek(day)::int) - date '1899-12-31') / 7 as int) as week,
  cast(((day - dayofweek(day)::int) - (qf - dayofweek(qf)::int)) / 7 + 1 as int) as week_of_quarter from d""",
)
def q_week_of_quarter(spark, sf_dir):
    return (
        read_table(spark, sf_dir, "orders")
        .select(order_day().alias("day"))
        .distinct()
        .select(
            "day",
            week_index(F.col("day")).alias("week"),
            week_of_quarter(F.col("day"), quarter_start(F.col("day"))).alias("week_of_quarter"),
        )
    )


@query(
    "run_rate",
    f"""with holidays as (select distinct cast(o_orderdate as date) as h from orders where day(o_orderdate) = 1),
 k as (select count(*) as workingday, count(*) filter (where d <= {CUTOFF}) as dayssofar, {CUTOFF} as lastupdateday
  from (select cast(g as date) as d from generate_series(timestamp '2001-04-01', timestamp '2001-06-30', interval 1 day) t(g)) x
  where dayofweek(d) between 1 and 5 and d not in (select h from holidays)),
 n as (select l_suppkey, count(case when l_shipdate <= {CUTOFF} then 1 end) as n from lineitem
  where l_shipdate >= {QUARTER_FIRST} and l_shipdate < date '2001-07-01' group by 1)
select l_suppkey, n, lastupdateday, workingday, dayssofar, round(n / dayssofar * workingday, 4) as run_rate from n cross join k""",
)
def q_run_rate(spark, sf_dir):
    holidays = read_table(spark, sf_dir, "orders").where(F.dayofmonth(order_day()) == 1).select(order_day().alias("day")).distinct()
    shipped = F.to_date("l_shipdate")
    counted = (
        read_table(spark, sf_dir, "lineitem")
        .where((shipped >= F.lit(PARAMS.quarter_first)) & (shipped < F.lit(PARAMS.next_quarter_first)))
        .groupBy("l_suppkey")
        .agg(F.count(F.when(shipped <= F.lit(PARAMS.week_cutoff), 1)).alias("n"))
    )
    rows = cross_one_row(counted, run_rate_calendar(spark, PARAMS, holidays))
    return rounded(rows.withColumn("run_rate", projected(F.col("n"))))


@query(
    "exist_flags",
    f"""{as_ctes("account", "procedures_typed", "procedure_summary")},
cases as (select p.* from procedures_typed p join procedure_summary s on p.casenumber = s.casenumber
  where p.accountguid in (select accountguid from account where recordtype = 'Hospital')
    and p.status = 'Completed' and s.clinicalregion = {REGION}),
q as (select distinct surgeonguid, {key_of("proceduredatelocal")} as quarter from procedures_typed p where p.status = 'Completed'
    and p.proceduredatelocal is not null and p.accountguid in (select accountguid from account where recordtype = 'Hospital')),
f as (select surgeonguid, min(proceduredatelocal) as f, min(case when systemmodel = 'SMALL' then proceduredatelocal end) as fs from cases group by 1)
select q.surgeonguid, q.quarter, case when {key_of("f")} <= q.quarter then 1 else 0 end as exist_flg,
  case when {key_of("fs")} <= q.quarter then 1 else 0 end as exist_flg_small from q left join f on q.surgeonguid = f.surgeonguid""",
)
def q_exist_flags(spark, sf_dir):
    activity = quarterly_activity(SourceTables(spark, sf_dir, {"procedures": "procedures_typed"}), PARAMS)
    firsts = activity.groupBy("surgeonguid").agg(F.min("first").alias("f"), F.min("first_SMALL").alias("fs"))
    index = F.col("quarter_index")

    def ever(first: str):
        return F.when(quarter_index(F.col(first)) <= index, 1).otherwise(0)

    return (
        activity.select("surgeonguid", "quarter_index")
        .join(firsts, "surgeonguid", "left")
        .select(
            "surgeonguid",
            index_key(index).alias("quarter"),
            ever("f").alias("exist_flg"),
            ever("fs").alias("exist_flg_small"),
        )
    )


@query(
    "prior_quarter_cohort",
    f"""{as_ctes("procedures")} select surgeonid, count(casenumber) as n_previous,
  case when count(casenumber) >= 13 then 'Sustainable' when count(casenumber) >= 7 then 'Bubble' else 'Dabbler' end as cohort
from procedures where coalesce(proceduredatelocal, scheduledstartdate) >= {PREVIOUS_QUARTER}
  and coalesce(proceduredatelocal, scheduledstartdate) < {QUARTER_FIRST} and status = 'Completed' group by 1""",
)
def q_prior_quarter_cohort(spark, sf_dir):
    return prior_quarter_cohort(SourceTables(spark, sf_dir)["procedures"], PARAMS)


@query(
    "prior_quarter_flags",
    f"""select o_orderkey, case when (year(o_orderdate) = 2001 and quarter({AS_OF} - 90) = quarter(o_orderdate))
    or (year(o_orderdate) = year({AS_OF} - 365) and quarter({AS_OF}) = 1 and quarter(o_orderdate) = 4) then 1 else 0 end as prior,
  case when (year(o_orderdate) = 2001 and quarter({AS_OF} - 180) = quarter(o_orderdate))
    or (year(o_orderdate) = year({AS_OF} - 365) and quarter({AS_OF}) = 1 and quarter(o_orderdate) = 3)
    or (year(o_orderdate) = year({AS_OF} - 365) and quarter({AS_OF}) = 2 and quarter(o_orderdate) = 4) then 1 else 0 end as two_prior,
  case when o_orderdate >= {PREVIOUS_QUARTER} and o_orderdate < {QUARTER_FIRST} then 1 else 0 end as prior_exact,
  case when o_orderdate >= {PREVIOUS_QUARTER} - interval 3 month and o_orderdate < {PREVIOUS_QUARTER} then 1 else 0 end as two_prior_exact
from orders""",
)
def q_prior_quarter_flags(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        prior_quarter_flag(order_day(), PARAMS.as_of).alias("prior"),
        two_quarters_prior_flag(order_day(), PARAMS.as_of).alias("two_prior"),
        prior_quarter_flag(order_day(), PARAMS.as_of, exact=True).alias("prior_exact"),
        two_quarters_prior_flag(order_day(), PARAMS.as_of, exact=True).alias("two_prior_exact"),
    )


@query(
    "log_gap_filter",
    """with starts as (select user_id, cast(ts as date) as day, min(ts) as started from events where event_type = 'purchase' group by 1, 2)
select e.event_id, e.user_id, s.started, cast(date_diff('minute', s.started, e.ts) as bigint) as minutes from events e
  join starts s on e.user_id = s.user_id and cast(e.ts as date) = s.day
where e.event_type = 'click' and date_diff('minute', s.started, e.ts) >= -120""",
)
def q_log_gap_filter(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    starts = events.where("event_type = 'purchase'").groupBy("user_id", "day").agg(F.min("ts").alias("started"))
    return (
        events.where("event_type = 'click'")
        .join(starts, ["user_id", "day"])
        .withColumn("minutes", minutes_between(F.col("started"), F.col("ts")))
        .where("minutes >= -120")
        .select("event_id", "user_id", "started", "minutes")
    )


@query(
    "usage_rollup",
    f"""{as_ctes("web_analytics", "app_user")} select u.sk_user_id, f.umaid_derived, f.class as casenumber,
  min(event_date) as first_viewed_date, count(*) as number_of_views_bysurgeon,
  count(distinct session_id) as number_of_sessions_bysurgeon
from web_analytics f join app_user u on f.umaid_derived = u.uma_user_id
where f.appname_outer = 'APP' and f.kingdom = 'case_details' and f.family = 'load' and f.class is not null group by 1, 2, 3""",
)
def q_usage_rollup(spark, sf_dir):
    return page_usage(SourceTables(spark, sf_dir), USAGE)


LABELS = """select p_partkey, case when p_size >= 45 then '소계 ' || p_brand
    when p_size between 7 and 12 then 'a' || lpad(cast(p_size as string), 3, '0') || ' ' || p_name
    when p_size = 13 then null
    else 'A' || lpad(cast(p_size as string), 3, '0') || ' ' || p_name end as label,
  case when p_size between 20 and 25 then '-' else cast(p_size as string) || ',' || lpad(cast(p_partkey % 1000 as string), 3, '0') end as cell
from {part}"""


@query(
    "regex_clean",
    f"""with l as ({LABELS.format(part="part")})
select p_partkey, label, nullif(regexp_extract(label, '^([A-Z][0-9][0-9][0-9])', 1), '') as code,
  upper(nullif(regexp_extract(label, '([a-z]+)$', 1), '')) as last_word,
  cast(case when cell = '-' then '0' else replace(cell, ',', '') end as bigint) as patients
from l where not coalesce(contains(label, '계'), false)""",
)
def q_regex_clean(spark, sf_dir):
    rows = spark.sql(LABELS, part=read_table(spark, sf_dir, "part"))
    label = F.col("label")
    return rows.where(without_match(label, SUBTOTAL_PATTERN)).select(
        "p_partkey",
        "label",
        leading_code(label).alias("code"),
        F.upper(extract_or_null(label, "([a-z]+)$")).alias("last_word"),
        plain_integer(F.col("cell")).alias("patients"),
    )

"""Sources, sinks and the yearly market job on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstats.plans.market import counts_from_responses, counts_from_sheet, first_rows, market_total
from fieldstats.session import scratch_path
from fieldstats.sources.readers import matching_codes, quarantined, read_sheet, read_table, response_items
from fieldstats.sources.sinks import append_snapshot, export_dated, read_snapshots, replace_table, write_snapshot_once
from workload.bindings import PARAMS
from workload.common import AS_OF
from workload.registry import query

# Each event becomes one landed response: its total row with another class row, or a
# single object, or a total without a count, or a body without items.
BODY = """case when value < 1 then '{"response":{"body":{}}}'
    when event_type = 'error' then '{"response":{"body":{"items":{"item":{"diagCdNm":"계","ptntCnt":' || k || '}}}}}'
    when event_type = 'signup' then '{"response":{"body":{"items":{"item":[{"diagCdNm":"계"}]}}}}'
    else '{"response":{"body":{"items":{"item":[{"diagCdNm":"계","ptntCnt":"' || k || '"},{"diagCdNm":"x","ptntCnt":5}]}}}}'
  end"""


def responses(spark, sf_dir) -> DataFrame:
    events = read_table(spark, sf_dir, "events").withColumn("k", F.regexp_extract("props", "([0-9]+)", 1))
    return events.select(
        (F.col("event_id") % 6 + 2019).cast("int").alias("year"),
        F.concat(F.lit("C"), F.col("user_id")).alias("code"),
        F.expr(BODY).alias("body"),
    )


def code_sheet(spark, sf_dir) -> DataFrame:
    """Matching codes of the customers of four segments; the fifth is not listed."""
    listed = read_table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'")
    return matching_codes(
        listed.select(
            F.col("c_mktsegment").alias("No"),
            F.concat(F.lit("C"), F.col("c_custkey")).alias("St5 Code"),
            F.col("c_name").alias("Subject Name"),
        )
    )


@query(
    "json_flatten",
    """with e as (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events where value >= 1)
select cast(2019 + event_id % 6 as int) as year, 'C' || user_id as code, '계' as class_name,
  case when event_type = 'signup' then 0 else k end as patients from e
union all select cast(2019 + event_id % 6 as int), 'C' || user_id, 'x', 5 from e where event_type not in ('error', 'signup')""",
)
def q_json_flatten(spark, sf_dir):
    return response_items(responses(spark, sf_dir))


COUNTS_SQL = """select 'HIRA' as "Source", cast(2019 + event_id % 6 as int) as "Year", 'C' || user_id as "Code",
  c_name as "DRG_Name",
  cast(sum(case when event_type = 'signup' then 0 else cast(regexp_extract(props, '([0-9]+)', 1) as int) end) as bigint) as "HIRA_Patients"
from events join customer on user_id = c_custkey where value >= 1 and c_mktsegment <> 'MACHINERY' group by 1, 2, 3, 4"""


@query(
    "response_quarantine",
    f"""with r as (select cast(2019 + event_id % 6 as int) as year, 'C' || user_id as code, {BODY} as body
  from (select *, regexp_extract(props, '([0-9]+)', 1) as k from events))
select year, code, case when body is null then 'no body' when not json_valid(body) then 'not json'
  when json_extract(body, '$.response.body.items.item') is null
    or json_type(json_extract(body, '$.response.body.items.item')) = 'NULL' then 'no items'
  else 'unreadable items' end as reason, body
from r where body is null or not json_valid(body)
  or json_extract(body, '$.response.body.items.item') is null
  or json_type(json_extract(body, '$.response.body.items.item')) not in ('OBJECT', 'ARRAY')""",
)
def q_response_quarantine(spark, sf_dir):
    return quarantined(responses(spark, sf_dir))


@query("market_json_counts", COUNTS_SQL)
def q_market_json_counts(spark, sf_dir):
    return counts_from_responses(responses(spark, sf_dir), code_sheet(spark, sf_dir))


YEARS = range(1995, 2002)


def record_sheet(spark, sf_dir) -> DataFrame:
    """Shipments per part size and brand: one column per year, numbers as formatted text."""
    shipped = read_table(spark, sf_dir, "lineitem").join(
        read_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    size = F.col("p_size")
    code = F.concat(F.when(size.between(9, 12), "a").otherwise("A"), F.lpad(size.cast("string"), 3, "0"))
    label = F.when(size >= 38, F.concat(F.lit("소계 "), code)).otherwise(F.concat(code, F.lit(" "), F.col("p_brand")))
    counts = (
        shipped.withColumn("year", F.year("l_shipdate"))
        .groupBy(F.lit("row").alias("group"), label.alias("label"))
        .pivot("year", list(YEARS))
        .agg(F.count("l_orderkey"))
    )
    cells = [
        F.when(F.col(f"`{y}`").isNull(), "-").otherwise(F.format_number(F.col(f"`{y}`") * 37, 0)).alias(str(y))
        for y in YEARS
    ]
    return counts.select("group", "label", *cells)


def code_map(spark, sf_dir) -> DataFrame:
    """Codes of part sizes up to 40, untidy; size 20 is listed under two names."""
    size = F.col("p_size")
    sizes = read_table(spark, sf_dir, "part").where(size <= 40).select("p_size").distinct()
    code = F.concat(F.lit(" a"), F.lpad(size.cast("string"), 3, "0"), F.lit(" "))
    names = F.when(size == 20, F.array(F.lit("Size 20"), F.lit("Twenty"))).otherwise(F.array(F.concat(F.lit("Size "), size)))
    return sizes.select(code.alias("code"), F.explode(names).alias("name"))


SHEET_SQL = """select 'DRG' as "Source", y.y as "Year", 'A' || lpad(cast(p_size as varchar), 3, '0') as "Code", n.name as "DRG_Name",
  cast(0 as bigint) as "HIRA_Patients", cast(count(l_orderkey) * 37 as bigint) as "KOSIS_Patients"
from (select distinct p_size from part where p_size <= 40 and p_size < 38 and p_size not between 9 and 12
    and p_partkey in (select l_partkey from lineitem)) s
  cross join (select cast(unnest(range(1995, 2002)) as int) as y) y
  join (select distinct p_size as ps, 'Size ' || p_size as name from part
    union all select distinct p_size, 'Twenty' from part where p_size = 20) n on n.ps = s.p_size
  left join (select l_orderkey, p_size as ls, year(l_shipdate) as ly from lineitem join part on l_partkey = p_partkey) l
    on l.ls = s.p_size and l.ly = y.y
group by 1, 2, 3, 4"""


@query("market_wide_to_long", SHEET_SQL)
def q_market_wide_to_long(spark, sf_dir):
    return counts_from_sheet(record_sheet(spark, sf_dir), code_map(spark, sf_dir))


def _total(spark, sf_dir) -> DataFrame:
    return market_total(
        counts_from_responses(responses(spark, sf_dir), code_sheet(spark, sf_dir)),
        counts_from_sheet(record_sheet(spark, sf_dir), code_map(spark, sf_dir)),
    )


TOTAL_SQL = f"""select "Source", "Year", "Code", "DRG_Name", cast(sum(coalesce("HIRA_Patients", 0)) as bigint) as "HIRA_Patients",
  cast(sum(coalesce("KOSIS_Patients", 0)) as bigint) as "KOSIS_Patients",
  cast(sum(coalesce("HIRA_Patients", 0)) + sum(coalesce("KOSIS_Patients", 0)) as bigint) as "TotalPatients"
from (select * from ({COUNTS_SQL}) union all by name select * from ({SHEET_SQL})) group by 1, 2, 3, 4"""


@query("market_total", TOTAL_SQL)
def q_market_total(spark, sf_dir):
    return _total(spark, sf_dir)


@query("market_head", f"""{TOTAL_SQL} order by 1, 2, 3, 4 limit 10""")
def q_market_head(spark, sf_dir):
    return first_rows(_total(spark, sf_dir))


# --------------------------------------------------------------- files and sinks


@query(
    "wide_file_read",
    """select cast(c_custkey as varchar) as code, c_name as name from customer""",
)
def q_wide_file_read(spark, sf_dir):
    path = scratch_path(spark, "sheet")
    customer = read_table(spark, sf_dir, "customer")
    sheet = customer.select(
        F.col("c_name").alias("The Subject"), F.col("c_custkey").alias("St5 CODE"), F.col("c_acctbal").alias("Balance")
    )
    sheet.write.option("header", True).csv(path)
    return matching_codes(read_sheet(spark, path))


@query(
    "sink_roundtrip",
    """select o_orderpriority, o_orderstatus, count(*) as n, 'table' as sink from orders group by 1, 2
union all select o_orderpriority, o_orderstatus, count(*), 'export' from orders group by 1, 2""",
)
def q_sink_roundtrip(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    result = orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    name, root = f"refresh_{uuid.uuid4().hex}", scratch_path(spark, "refresh")
    replace_table(orders.select("o_orderkey").where("o_orderstatus = 'F'"), name, root)
    replace_table(result, name, root)  # the second run replaces the first one whole
    try:  # a run that fails leaves the table as it was
        replace_table(result.withColumn("n", F.raise_error(F.lit("failed run")).cast("bigint")), name, root)
    except Exception as error:  # noqa: BLE001
        if "failed run" not in str(error):
            raise
    exported = export_dated(result, scratch_path(spark, "export"), PARAMS.as_of)
    schema = "o_orderpriority string, o_orderstatus string, n bigint"
    return (
        spark.table(name)
        .withColumn("sink", F.lit("table"))
        .unionByName(spark.read.schema(schema).csv(exported, header=True).withColumn("sink", F.lit("export")))
    )


@query(
    "append_snapshot",
    f"""select o_orderstatus, count(*) as n, {AS_OF} - 1 as extract_date from orders group by 1
union all select o_orderstatus, count(*), {AS_OF} from orders group by 1
union all select o_orderstatus, count(*), {AS_OF} from orders group by 1""",
)
def q_append_snapshot(spark, sf_dir):
    result = read_table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    path = scratch_path(spark, "log")
    for back in (1, 0, 0):  # a plain append keeps both runs of the second day
        append_snapshot(result, path, PARAMS.as_of.fromordinal(PARAMS.as_of.toordinal() - back))
    return spark.read.parquet(path)


@query(
    "append_idempotent",
    f"""select o_orderstatus, count(*) as n, {AS_OF} - 1 as extract_date from orders group by 1
union all select o_orderstatus, count(*), {AS_OF} from orders group by 1""",
)
def q_append_idempotent(spark, sf_dir):
    result = read_table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    path = scratch_path(spark, "log")
    for back, rows in ((1, result), (0, result), (0, result), (2, result), (2, result.limit(0))):
        # the second run of a day replaces that day; an empty one leaves it empty
        write_snapshot_once(rows, path, PARAMS.as_of.fromordinal(PARAMS.as_of.toordinal() - back))
    try:  # a run that fails half-way is never committed
        write_snapshot_once(result.withColumn("n", F.raise_error(F.lit("failed run")).cast("bigint")), path, PARAMS.as_of)
    except Exception as error:  # noqa: BLE001
        if "failed run" not in str(error):
            raise
    return read_snapshots(spark, path, "o_orderstatus string, n bigint")

"""The source tables of the jobs, shaped from the given test tables.

Each binding is one plain SQL text in a form that Spark and DuckDB both read;
``{lineitem}`` and the like stand for the given tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from fieldstats.params import JobParams
from fieldstats.sources.readers import read_table

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

PARAMS = JobParams(
    as_of=date(2001, 6, 20),
    region="ASIA",
    country="ASIA",
    models=(("SMALL", "SMALL"), ("LARGE", "LARGE"), ("MEDIUM", "MEDIUM"), ("PROMO", "PROMO")),
    spine_floor=date(1996, 1, 1),
    source_zone="GMT",
    local_zone="Asia/Seoul",
    extracted_at=datetime(2001, 6, 20, 6, 30, 15),
)

_CUSTOMER = """{customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey"""

_ORDERS = """{orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
  join {region} on n_regionkey = r_regionkey"""

_TEAM = """
  case when c_acctbal < 0 then null else n_name end as csdnetworkid,
  n_name || '/' || c_mktsegment as csrnetworkid,
  c_mktsegment as csmnetworkid,
  'T' || cast(c_custkey % 10 as string) as ctanetworkid,
  case when c_custkey % 4 = 0 then null else 'S' || cast(c_custkey % 3 as string) end as ssmnetworkid,
  r_name as cvpnetworkid,
  'D' || cast(c_nationkey % 5 as string) as asdnetworkid,
  'M' || cast(c_nationkey % 7 as string) as asmnetworkid,
  case when c_custkey % 9 = 0 then null else 'V' || cast(c_nationkey % 2 as string) end as avpnetworkid
"""

BINDINGS = {
    "account": f"""select c_custkey as accountguid, 'AC-' || cast(c_custkey as string) as accountid,
  c_name as accountname,
  case when c_mktsegment = 'MACHINERY' then 'Office' else 'Hospital' end as recordtype,
  r_name as capitalregion,
  case when c_acctbal < -800 then null else r_name end as clinicalregion,
  c_mktsegment as customertype, c_mktsegment as customersegmentation,
  case when c_acctbal >= 6000 then 'Tier 1' when c_acctbal >= 2000 then 'Tier 2'
       when c_acctbal >= 0 then 'Tier 3' end as tiertype,
  case when c_acctbal >= 0 then c_acctbal >= 6000 end as tier1,
  case when c_custkey % 7 = 0 then c_mktsegment || ' Top 300' else c_mktsegment end as japancustomersegment,
  r_name || ' group' as parentaccountname, n_name as endcustomerstateprovince,
  r_name as endcustomercountry, 'KAD ' || n_name as keycustomerdirectoridn, {_TEAM}
from {_CUSTOMER}""",
    "account_team": f"""select c_custkey as accountguid, {_TEAM},
  'csd ' || n_name as csdname, 'csm ' || c_mktsegment as csmname, 'csr ' || n_name as csrname,
  'ssm ' || cast(c_custkey % 3 as string) as ssmname, 'asd ' || cast(c_nationkey % 5 as string) as asdname,
  'asm ' || cast(c_nationkey % 7 as string) as asmname
from {_CUSTOMER}""",
    "contact": """select s_suppkey as contactguid, 'S-' || cast(s_suppkey as string) as contactid,
  s_name as fullname, n_name as specialtyname, s_suppkey * 15 as accountguid,
  'AC-' || cast(s_suppkey * 15 as string) as accountid,
  case when s_acctbal >= 5000 then 'A' when s_acctbal >= 0 then 'B' end as surgeoncategory,
  r_name as endcustomermailingcountry,
  case when s_acctbal < 1000 then 'Inactive' else 'Active' end as status,
  case when s_suppkey % 3 = 0 then 'Chief Surgeon' when s_suppkey % 3 = 1 then 'Surgeon' else 'Nurse' end as isititle
from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "user": """select s_suppkey as userid, 'User ' || s_name as fullname from {supplier}""",
    "procedures": """select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as recordid,
  l_orderkey as casenumber, o_custkey as accountguid, l_suppkey as surgeonguid,
  'S-' || cast(l_suppkey as string) as surgeonid,
  case when l_linestatus = 'F' then 'Completed' when l_returnflag = 'R' then 'OnSite' else 'Scheduled' end as status,
  case when l_linestatus = 'O' and l_returnflag = 'N' then null else cast(l_shipdate as date) end as proceduredatelocal,
  cast(l_shipdate as date) as scheduledstartdate,
  l_quantity * 90 as proceduredurationinseconds,
  cast(o_custkey as string) || '-' || o_orderpriority || '-' || o_orderstatus as installedbaseguid
from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "procedures_typed": """select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as recordid,
  l_orderkey as casenumber, o_custkey as accountguid, l_suppkey as surgeonguid,
  'S-' || cast(l_suppkey as string) as surgeonid,
  case when l_linestatus = 'F' then 'Completed' when l_returnflag = 'R' then 'OnSite' else 'Scheduled' end as status,
  case when l_linestatus = 'O' and l_returnflag = 'N' then null else cast(l_shipdate as date) end as proceduredatelocal,
  cast(l_shipdate as date) as scheduledstartdate,
  l_quantity * 90 as proceduredurationinseconds,
  cast(o_custkey as string) || '-' || o_orderpriority || '-' || o_orderstatus as installedbaseguid,
  p_type as systemmodel, case when p_size > 45 then null else p_type end as businesscategoryname,
  p_brand as subject, p_name as procedurename
from {lineitem} join {orders} on l_orderkey = o_orderkey left join {part} on l_partkey = p_partkey""",
    "procedure_summary": f"""select o_orderkey as casenumber, o_orderkey as procedureguid,
  o_custkey as accountguid, c_name as accountname,
  case when c_acctbal < -800 then null else r_name end as clinicalregion,
  o_orderpriority as systemname, cast(o_orderdate as date) as localproceduredate,
  cast(floor(o_totalprice / 1000) as double) as runrate, o_orderstatus as category, c_mktsegment as customersegmentation,
  o_orderpriority as proceduresubject, 'cvp ' || r_name as cvp, 'csd ' || n_name as csd,
  'ug ' || n_name as ugsrname, 'sp ' || n_name as spsmname,
  case when c_acctbal >= 6000 then 'Tier 1' else 'Other' end as tiertype,
  'M' || substr(o_orderpriority, 1, 1) as systemmodelname, c_nationkey as calqtroffset
from {_ORDERS}""",
    "installbase": f"""select cast(o_custkey as string) || '-' || o_orderpriority || '-' || o_orderstatus as installbaseguid,
  o_custkey as accountguid, 'AC-' || cast(o_custkey as string) as accountid, c_name as accountname,
  o_orderpriority as name,
  case when o_orderstatus = 'F' then 'Xi'
       when o_orderstatus = 'O' then case when o_orderpriority = '5-LOW' then 'Sim' else 'X' end
       else case when o_orderpriority = '1-URGENT' then 'SP' else 'Si' end end as model,
  'System' as type, r_name as country,
  case when o_orderpriority = '4-NOT SPECIFIED' then 'Training' else 'OR' end as systemuse,
  max(o_totalprice) > 450000 as inactive,
  cast(min(o_orderdate) as date) as installdate,
  case when count(*) > 2 then cast(max(o_orderdate) as date) end as removedate,
  case when min(o_totalprice) < 20000 then null else cast(min(o_orderdate) as date) end as financeinstalleddate,
  case when count(*) > 1 and max(o_orderdate) < date '2000-01-01'
       then cast(max(o_orderdate) as date) end as financedeinstalleddate
from {_ORDERS}
group by o_custkey, c_name, r_name, o_orderpriority, o_orderstatus""",
    "account_quota": """select o_custkey as accountguid,
  case when o_orderpriority = '1-URGENT' then 'General Surgery' when o_orderpriority = '2-HIGH' then 'Other'
       when o_orderpriority = '3-MEDIUM' then 'Growth' when o_orderpriority = '5-LOW' then null
       else o_orderpriority end as businesscategory,
  cast(year(o_orderdate) as string) as fiscalyear, 'Q' || cast(quarter(o_orderdate) as string) as quarter,
  case when o_orderstatus = 'P' then null else o_totalprice end as forecast
from {orders}""",
    "certification": """select cast(o_orderdate as date) as certificationdate,
  case when o_orderstatus = 'P' then null else o_custkey % 10 end as csr,
  case when o_orderpriority < '4' then 'Technology Training' else 'Other' end as eventtype,
  cast((o_custkey - o_custkey % 15) / 15 as bigint) as contact, o_orderkey as eventregistration,
  case when o_orderstatus = 'O' then 'Nurse' else 'Surgeon' end as role
from {orders}""",
    "event_registration": """select o_orderkey as recordid,
  cast((o_custkey - o_custkey % 15) / 15 as bigint) as csrguid,
  case when o_totalprice > 50000 then 'Completed' else 'Open' end as eventstatus
from {orders}""",
    "opportunity": """select 'O-' || cast(o_orderkey as string) as opportunityid,
  'Opp ' || cast(o_orderkey as string) as name, o_custkey as accountguid,
  cast(o_orderdate as date) as closedate, o_totalprice > 490000 as deleted, o_orderstatus as status,
  cast(o_orderdate as date) - 30 as createddate, o_orderstatus = 'F' as closed, o_totalprice > 250000 as won,
  case when o_orderstatus = 'O' then 'Pipeline' when o_orderstatus = 'F' then 'Closed' else 'Commit' end
    as forecastcategory,
  o_orderstatus || ' name' as forecastcategoryname, o_orderpriority as transactionstructure,
  case when o_orderstatus = 'P' then null else 'call' end as avpcall, o_orderpriority as stage,
  o_totalprice as amount, o_totalprice as expectedamount, cast(o_custkey % 100 as double) as probability,
  cast(1 as double) as quantity, o_orderstatus as financingpartnername, o_orderpriority as budgetcycle,
  o_orderstatus as money, o_orderpriority as method, o_orderstatus as product, o_orderpriority as productfamily,
  o_orderstatus as producttype, o_orderpriority as opportunitytype,
  case when o_orderpriority = '1-URGENT' then true when o_orderpriority = '5-LOW' then null else false end
    as greenfield
from {orders}""",
    "opportunity_line": """select 'O-' || cast(l_orderkey as string) as opportunityid,
  case when l_linenumber = 1 then '1-URGENT' when l_linenumber = 2 then '2-HIGH' when l_linenumber = 3 then '3-MEDIUM'
       when l_linenumber = 4 then '4-NOT SPECIFIED' when l_linenumber = 5 then '5-LOW' end as systemserialnumbercpq,
  case when l_returnflag = 'A' then 'Incremental' when l_returnflag = 'N' then 'Trade-In'
       when l_linenumber = 7 then null when l_linenumber > 4 then 'Trade-in' else 'Non System Deal' end as dealtype,
  l_quantity > 45 as deleted, l_linestatus = 'F' as systemline,
  case when p_type = 'STANDARD' then 'unit Xi base' when p_type = 'SMALL' then 'unit X base'
       when p_type = 'LARGE' then 'unit SP base' else p_type end as systemconfigurationcpq
from {lineitem} left join {part} on l_partkey = p_partkey""",
    "milestone_pathway": """select 'P-' || cast(p_partkey as string) as milestonepathwayguid,
  cast((p_partkey - p_partkey % 20) / 20 as bigint) as surgeonguid,
  case when p_size > 40 then null else p_name end as pathwayname, p_size % 5 as recordtypeid
from {part}""",
    "record_type": """select r_regionkey as recordtypeid,
  case when r_regionkey = 0 then 'Advanced Technology' else r_name end as recordtypename
from {region}""",
    "event": """select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as activityid,
  case when l_linestatus = 'F' then 'O-' || cast(l_orderkey as string)
       else 'P-' || cast(l_partkey as string) end as relatedtoid,
  case when l_linestatus = 'F' then 'Opportunity' else 'Pathway' end as relatedobjecttype,
  o_custkey as accountid,
  case when l_linestatus = 'F' then
    case when l_linenumber = 1 then 'Operational Roll Out' when l_linenumber = 2 then 'Clinical Validation'
         when l_linenumber = 3 then 'Market Awareness' when l_linenumber = 4 then 'Quantify the Impact'
         else 'Executive Validation' end
  else
    case when l_linenumber = 1 then 'Discover' when l_linenumber = 2 then 'Validate'
         when l_linenumber = 3 then 'Contract' when l_linenumber = 4 then 'Deliver'
         when l_linenumber = 5 then 'Pivot' end
  end as pillar,
  case when l_returnflag = 'R' then 'Open' else 'Completed' end as eventstatus,
  case when l_quantity < 15 then 'Business Alignment Meeting' when l_quantity < 25 then 'Directional QTI'
       when l_quantity < 35 then 'Peer-to-peer event' else 'Call' end as salesstep,
  l_shipdate + l_linenumber * interval '5' hour as enddatetime,
  l_shipdate + l_linenumber * interval '5' hour as eventenddatetime,
  cast(l_shipdate as date) as duedateonly, l_tax > 0.07 as deleted,
  'Visit ' || cast(l_linenumber as string) as subject, l_suppkey as assignedtoid, l_suppkey as contact,
  l_suppkey + 1 as createdbyid, l_suppkey as nameid,
  case when l_discount > 0.05 then null else 'note' end as description,
  l_returnflag as salessteptype, l_linestatus as priority
from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "third_party_volume": """select o_custkey as accountguid, o_orderpriority as proceduresubject,
  cast(floor(o_totalprice) as bigint) as totalvolume,
  cast(date_trunc('year', o_orderdate) as date) as date
from {orders}""",
    "tier_lookup": """select 'AC-' || cast(c_custkey as string) as accountid, 'Seg ' || c_mktsegment as tiersegmentaion
from {customer} where c_acctbal > 1000""",
    "app_user": """select s_suppkey as sk_user_id, 'S-' || cast(s_suppkey as string) as sfdc_contact_id,
  s_suppkey as uma_user_id, s_name as contact_name, n_name as surgeon_specialty,
  case when s_acctbal > 500 then date '2001-01-05' end as registration_completed_date,
  'title ' || cast(s_suppkey % 3 as string) as isi_title, n_name as mailing_country,
  cast(s_suppkey % 2 as int) as invited_flag
from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "app_procedure": """select o_orderkey as procedure_name, o_orderpriority as subject__c, o_orderkey as casenumber,
  o_orderpriority as sk_system_install_id, o_custkey as sk_account_id,
  cast((o_custkey - o_custkey % 15) / 15 as bigint) as sk_user_id, cast(o_orderdate as date) as procedure_date_local
from {orders}""",
    "app_system_install": """select o_orderpriority as sk_system_install_id, 'SYS ' || o_orderpriority as system_name
from {orders} group by o_orderpriority""",
    "app_account": """select c_custkey as sk_account_id, 'AC-' || cast(c_custkey as string) as sfdc_account_id,
  c_name as account_name, n_name as billing_country
from {customer} join {nation} on c_nationkey = n_nationkey""",
    "app_system": """select 'SYS ' || o_orderpriority as system_name,
  cast(min(o_orderdate) as date) + 365 * cast(substr(o_orderpriority, 1, 1) as int) as cloud_login_enabled_date
from {orders} group by o_orderpriority""",
    "web_analytics": """select user_id as umaid_derived, event_id - event_id % 2 as class, props as session_id,
  case when event_type = 'error' then 'OTHER' else 'APP' end as appname_outer, 'case_details' as kingdom,
  case when event_type = 'signup' then 'click' else 'load' end as family, cast(ts as date) as event_date
from {events}""",
    "surgeon_details": """select 'S-' || cast(l_suppkey as string) as sfdc_contact_id, l_orderkey as casenumber,
  l_linenumber as line, cast(l_shipdate as date) as procedure_date_local__c,
  case when l_tax > 0.06 then null else l_shipdate end as first_cloud_login
from {lineitem}""",
    "telemetry_log": """select event_id as procedureid, user_id as uuid,
  ts - 9497 * interval '1' day as logontimestampgmt
from {events}""",
    "telemetry_summary": """select o_orderkey as procedureid, o_orderkey as caseuid, 'SYS ' || o_orderpriority as systemname,
  o_orderdate + interval '3' hour as starttimegmt
from {orders}""",
    "telemetry_meta": """select o_orderkey as caseuid, 'R-' || cast(o_orderkey as string) as meta_procedureid
from {orders}""",
    "telemetry_case": """select 'R-' || cast(o_orderkey as string) as remotefe_procedure_id__c, o_orderkey as name,
  cast(o_orderdate as date) as procedure_date_gmt__c, cast(o_orderdate as date) as procedure_date_local__c,
  case when o_orderstatus = 'F' then 'Completed' when o_orderstatus = 'P' then 'OnSite' else 'Open' end as status__c
from {orders}""",
}


class SourceTables(Mapping):
    """Source tables by name, shaped on first use."""

    def __init__(self, spark: SparkSession, folder: str, names: dict[str, str] | None = None):
        self._spark, self._folder = spark, folder
        self._names = names or {}
        self._given: dict[str, DataFrame] = {}
        self._shaped: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        if name not in self._given:
            self._given[name] = read_table(self._spark, self._folder, name)
        return self._given[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._shaped:
            text = BINDINGS[self._names.get(name, name)]
            frames = {given: self.given(given) for given in GIVEN if f"{{{given}}}" in text}
            self._shaped[name] = self._spark.sql(text, **frames)
        return self._shaped[name]

    def __iter__(self):
        return iter(BINDINGS)

    def __len__(self) -> int:
        return len(BINDINGS)


def as_ctes(*names: str) -> str:
    """``WITH`` list of bindings for the SQL checks; continue it with a comma."""
    given = {name: name for name in GIVEN}
    parts = []
    for name in names:
        alias, _, binding = name.partition("=")
        parts.append(f'"{alias}" as ({BINDINGS[binding or alias].format(**given)})')
    return "with " + ",\n".join(parts)

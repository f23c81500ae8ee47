"""One wide row per account: market size, pipeline, activity, systems, run-rate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldstats.functions.dates import near_range, quarter_key, shift_zone
from fieldstats.operators.lookup import cross_one_row
from fieldstats.operators.pivots import counts_where, sums_where
from fieldstats.operators.ranges import count_year_before
from fieldstats.operators.ranking import first_row_per_key
from fieldstats.operators.runrate import projected, run_rate_calendar
from fieldstats.operators.snapshot import on_date
from fieldstats.params import JobParams


@dataclass(frozen=True)
class ScorecardRules:
    """Lists and labels of the scorecard."""

    pillars: Sequence[str] = (
        "Operational Roll Out",
        "Clinical Validation",
        "Executive Validation",
        "Market Awareness",
        "Quantify the Impact",
    )
    pathway_pillars: Sequence[str] = ("Discover", "Validate", "Contract", "Deliver", "Pivot")
    meeting_pillar: str = "Executive Validation"
    meeting_step: str = "Business Alignment Meeting"
    meetings_since: date = date(2021, 2, 8)
    newest_models: Sequence[str] = ()
    older_models: Sequence[str] = ()
    segment_pattern: str = "%Top%"
    title_pattern: str = "%Surgeon%"
    open_category: str = "Pipeline"
    inactive_status: str = "Inactive"
    deal_type: str = "Incremental"
    greenfield_label: str = "Greenfield"
    tiers: Sequence[str] = ("Tier 1", "Tier 2")


def _hospitals(tables: Mapping[str, DataFrame], params: JobParams, region_column: str = "capitalregion") -> DataFrame:
    return tables["account"].where(
        (F.col("recordtype") == params.record_type) & (F.col(region_column) == params.region)
    )


def base_accounts(tables: Mapping[str, DataFrame], params: JobParams, rules: ScorecardRules) -> DataFrame:
    tier = F.col("tiertype")
    label = F.lit("Others")
    for name in rules.tiers:
        label = F.when(tier == name, F.lit(name)).otherwise(label)
    return (
        _hospitals(tables, params)
        .join(
            tables["account_team"].select("accountguid", "asdname", "asmname", "csdname", "csmname", "csrname"),
            "accountguid",
            "left",
        )
        .join(tables["tier_lookup"].select("accountid", "tiersegmentaion"), "accountid", "left")
        .select(
            "accountguid",
            F.col("accountid").alias("AccountID"),
            F.col("accountname").alias("AccountName"),
            F.col("customertype").alias("CustomerType"),
            F.col("endcustomerstateprovince").alias("Prefecture"),
            F.col("asdname").alias("ASDName"),
            F.col("asmname").alias("ASMName"),
            F.col("csdname").alias("CSDName"),
            F.col("csmname").alias("CSMName"),
            F.col("csrname").alias("CSRName"),
            F.col("keycustomerdirectoridn").alias("KAD"),
            F.col("parentaccountname").alias("IDN"),
            F.col("customersegmentation").alias("CUSTOMERSEGMENTATION"),
            label.alias("Tier 1"),
            "tiersegmentaion",
            F.when(F.col("japancustomersegment").like(rules.segment_pattern), "Top 200")
            .otherwise("Non-Top 200")
            .alias("Top 200"),
        )
    )


def market_volume(tables: Mapping[str, DataFrame], params: JobParams) -> DataFrame:
    """Distinct third-party volumes of the latest date, summed per account.

    The date must be the latest for the region's hospitals both by clinical and
    by capital region. Volumes are reduced to dates per account before they meet
    the accounts, and to the latest date before they are summed.
    """
    accounts = tables["account"].where(F.col("recordtype") == params.record_type)
    flagged = accounts.select(
        "accountguid",
        (F.col("clinicalregion") == params.region).alias("clinical"),
        (F.col("capitalregion") == params.region).alias("capital"),
    ).where("clinical or capital")
    volumes = tables["third_party_volume"].select("accountguid", "proceduresubject", "totalvolume", "date")
    newest = (
        volumes.groupBy("accountguid")
        .agg(F.max("date").alias("date"))
        .join(flagged, "accountguid")
        .agg(
            F.max(F.when(F.col("clinical"), F.col("date"))).alias("newest_clinical"),
            F.max(F.when(F.col("capital"), F.col("date"))).alias("newest_capital"),
        )
    )
    # The date is read first, so that the scan of the volumes keeps the rows of one date only.
    clinical, capital = newest.first()
    latest = on_date(volumes, "date", clinical if clinical == capital else None)
    return (
        latest.select("accountguid", "proceduresubject", "totalvolume", "date")
        .distinct()
        .groupBy("accountguid")
        .agg(F.sum("totalvolume").alias("TAM"))
        .join(flagged.where("clinical and capital"), "accountguid", "left_semi")
    )


def nearest_opportunity(tables: Mapping[str, DataFrame], params: JobParams, rules: ScorecardRules) -> DataFrame:
    accounts = tables["account"].where(F.col("endcustomercountry") == params.country)
    opportunities = tables["opportunity"].where(
        (F.col("forecastcategory") == rules.open_category) & (F.col("closedate") >= F.lit(params.quarter_first))
    )
    first = first_row_per_key(
        opportunities.select("accountguid", "closedate", "opportunityid"),
        ["accountguid"],
        [F.col("closedate").asc(), F.col("opportunityid").asc()],
    )
    near = first.join(accounts.select("accountguid"), "accountguid", "left_semi")
    return near.select("accountguid", F.col("closedate").alias("MinCloseDate"))


def opportunity_activity(tables: Mapping[str, DataFrame], params: JobParams, rules: ScorecardRules) -> DataFrame:
    """Pillar counts of the past year and meetings of the past year, per account.

    Both read the same events, so they share one scan and one shuffle; whether an
    opportunity is open is looked up once.
    """
    opportunities = (
        tables["opportunity"]
        .groupBy(F.col("opportunityid").alias("relatedtoid"))
        .agg(F.coalesce(F.bool_or(F.col("forecastcategory") == rules.open_category), F.lit(False)).alias("is_open"))
    )
    year_ago = F.lit(params.year_ago).cast("timestamp_ntz")
    local_end = shift_zone(F.col("enddatetime"), params.source_zone, params.local_zone)
    counted = F.col("is_open") & (F.col("enddatetime") >= year_ago)
    meeting = (
        (F.col("pillar") == rules.meeting_pillar)
        & (F.col("salesstep") == rules.meeting_step)
        & (local_end >= year_ago)
        & (local_end >= F.lit(rules.meetings_since).cast("timestamp_ntz"))
    )
    events = (
        tables["event"]
        .where(
            (F.col("relatedobjecttype") == "Opportunity")
            & (F.col("eventstatus") == params.completed)
            & F.col("pillar").isin([*rules.pillars, rules.meeting_pillar])
            & near_range(F.col("enddatetime"), params.year_ago)
        )
        .select("activityid", F.col("accountid").alias("accountguid"), "relatedtoid", "pillar", "salesstep", "enddatetime")
        .join(opportunities, "relatedtoid")
    )
    per_account = events.groupBy("accountguid").agg(
        *sums_where({p: counted & (F.col("pillar") == p) for p in rules.pillars}, F.lit(1)),
        F.nullif(F.count(F.when(meeting, F.col("activityid"))), F.lit(0)).alias("BAM Volume (Past 1 Year)"),
    )
    return per_account.join(_hospitals(tables, params).select("accountguid"), "accountguid", "left_semi")


def pathway_activity(tables: Mapping[str, DataFrame], params: JobParams, rules: ScorecardRules) -> DataFrame:
    surgeons = (
        tables["contact"]
        .where(
            F.col("isititle").like(rules.title_pattern) & (F.col("endcustomermailingcountry") == params.country)
        )
        .select(F.col("contactguid").alias("surgeonguid"), "accountguid")
        .join(_hospitals(tables, params).select("accountguid"), "accountguid", "left_semi")
    )
    pathways = (
        tables["milestone_pathway"]
        .select(F.col("milestonepathwayguid").alias("relatedtoid"), "surgeonguid")
        .join(surgeons, "surgeonguid")
    )
    events = tables["event"].where(
        (F.col("relatedobjecttype") == "Pathway")
        & (F.col("eventstatus") == params.completed)
        & F.col("pillar").isin(list(rules.pathway_pillars))
        & (F.col("enddatetime") >= F.lit(params.year_ago).cast("timestamp_ntz"))
    )
    return (
        events.select("relatedtoid", "pillar")
        .join(pathways, "relatedtoid")
        .groupBy("accountguid")
        .agg(*sums_where({p: F.col("pillar") == p for p in rules.pathway_pillars}, F.lit(1)))
    )


def surgeon_contacts(tables: Mapping[str, DataFrame], params: JobParams, rules: ScorecardRules) -> DataFrame:
    return (
        tables["contact"]
        .where(
            (F.col("endcustomermailingcountry") == params.country)
            & (F.col("status") != rules.inactive_status)
            & F.col("isititle").like(rules.title_pattern)
        )
        .groupBy("accountguid")
        .agg(F.count("accountid").alias("Number of Surgeon Contacts"))
    )


def installed_systems(tables: Mapping[str, DataFrame], params: JobParams, rules: ScorecardRules) -> DataFrame:
    """Systems in use by generation, and the last install date."""
    in_use = tables["installbase"].where(
        (F.col("type") == "System")
        & (F.col("country") == params.country)
        & (F.col("systemuse") == "OR")
        & F.col("financedeinstalleddate").isNull()
        & ~F.col("inactive")
    )
    model = F.col("model")
    per_account = in_use.groupBy("accountguid").agg(
        *sums_where(
            {
                "# GEN 4": model.isin(list(rules.newest_models)),
                "# GEN 3": model.isin(list(rules.older_models)),
            },
            F.lit(1),
        ),
        F.max("financeinstalleddate").alias("latestinstalleddate"),
    )
    return per_account.join(_hospitals(tables, params).select("accountguid"), "accountguid", "left_semi")


def case_counts(tables: Mapping[str, DataFrame], params: JobParams) -> DataFrame:
    """Completed cases per account: running quarter, previous quarter, previous year."""
    day = F.col("proceduredatelocal")
    cases = tables["procedures"].where(
        (F.col("status") == params.completed) & (day >= F.lit(date(params.as_of.year - 1, 1, 1)))
    )
    hospitals = tables["account"].where(
        (F.col("recordtype") == params.record_type) & (F.col("clinicalregion") == params.region)
    )
    per_account = cases.groupBy("accountguid").agg(
        *counts_where(
            {
                "Completed Procedures": (day >= F.lit(params.quarter_first)) & (day <= F.lit(params.week_cutoff)),
                "P.Q. Completed Procedures": (day >= F.lit(params.previous_quarter_first))
                & (day < F.lit(params.quarter_first)),
                "P.Y. Completed Procedures": F.year(day) == params.as_of.year - 1,
            },
            F.col("recordid"),
        )
    )
    return per_account.join(hospitals.select("accountguid"), "accountguid", "left_semi")


def account_run_rate(
    tables: Mapping[str, DataFrame], params: JobParams, calendar: DataFrame
) -> DataFrame:
    accounts = _hospitals(tables, params).select("accountguid")
    rows = cross_one_row(accounts.join(case_counts(tables, params), "accountguid", "left"), calendar)
    return rows.select(
        "accountguid",
        "Completed Procedures",
        "`P.Q. Completed Procedures`",
        "`P.Y. Completed Procedures`",
        F.col("lastupdateday").alias("LastUpdatedDay"),
        F.col("workingday").alias("WorkingDay"),
        F.col("dayssofar").alias("DaysSoFar"),
        projected(F.col("Completed Procedures")).alias("Runrate"),
    )


def before_last_install(tables: Mapping[str, DataFrame], rules: ScorecardRules) -> DataFrame:
    """Cases in the year before each account's top-ranked incremental install, ties kept.

    Equal items are merged before they are ranked, so what can tie at the first
    rank is a few models and categories per account, never its repeated lines.
    """
    lines = tables["opportunity_line"].where(
        F.col("systemserialnumbercpq").isNotNull()
        & ~F.col("deleted")
        & F.col("systemline")
        & (F.col("dealtype") == rules.deal_type)
    )
    systems = tables["installbase"].select(
        F.col("name").alias("systemserialnumbercpq"), "accountguid", "financeinstalleddate", "model"
    ).distinct()
    # stated here, so that both uses of the items below are the same plan and run once
    owned = tables["opportunity"].where(F.col("accountguid").isNotNull())
    category = F.when(F.col("greenfield"), F.lit(rules.greenfield_label)).otherwise(F.col("dealtype"))
    items = (
        lines.select("opportunityid", "systemserialnumbercpq", "dealtype")
        .join(owned.select("opportunityid", "accountguid", "greenfield"), "opportunityid")
        .select("accountguid", "systemserialnumbercpq", category.alias("category"))
        .distinct()
        .join(systems, ["systemserialnumbercpq", "accountguid"], "left")
        .distinct()
    )
    order = [F.col("financeinstalleddate").desc_nulls_first(), F.col("systemserialnumbercpq").asc_nulls_last()]
    top = (
        items.withColumn("position", F.rank().over(Window.partitionBy("accountguid").orderBy(*order)))
        .where((F.col("position") == 1) & (F.col("category") == rules.deal_type))
        .drop("position")
    )
    cases = (
        tables["procedure_summary"]
        .select("accountguid", "localproceduredate", "procedureguid")
        .join(top.select("accountguid"), "accountguid", "left_semi")
    )
    return count_year_before(
        top,
        cases,
        "accountguid",
        "financeinstalleddate",
        "localproceduredate",
        "procedureguid",
        "procedure_1year_before",
    ).select("accountguid", "procedure_1year_before")


def account_scorecard(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    params: JobParams,
    rules: ScorecardRules,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """All metric blocks, each reduced to one row per account, joined on the account.

    Blocks meet each other before they meet the team rows. The run-rate block holds
    exactly the accounts of the base, so a left join keeps what a full join would.
    """
    calendar = run_rate_calendar(spark, params) if calendar is None else calendar
    metrics = account_run_rate(tables, params, calendar)
    for block in (
        market_volume(tables, params),
        nearest_opportunity(tables, params, rules),
        opportunity_activity(tables, params, rules),
        pathway_activity(tables, params, rules),
        installed_systems(tables, params, rules),
        surgeon_contacts(tables, params, rules),
        before_last_install(tables, rules),
    ):
        metrics = metrics.join(block, "accountguid", "left")
    rows = base_accounts(tables, params, rules).join(metrics, "accountguid", "left")

    systems = F.coalesce("# GEN 4", F.lit(0)) + F.coalesce("# GEN 3", F.lit(0))
    last_quarter = F.col("`P.Q. Completed Procedures`") * 4
    projected_year = F.col("Runrate") * 4
    return rows.select(
        "AccountID",
        F.col("accountguid").alias("AccountGUID"),
        "AccountName",
        "TAM",
        "CustomerType",
        "Prefecture",
        "ASDName",
        "ASMName",
        "CSDName",
        "CSMName",
        "CSRName",
        "KAD",
        "IDN",
        "CUSTOMERSEGMENTATION",
        "Tier 1",
        "tiersegmentaion",
        "Top 200",
        "MinCloseDate",
        quarter_key(F.col("MinCloseDate")).alias("Pipeline Quarter (Nearest)"),
        *rules.pillars,
        "# GEN 4",
        "# GEN 3",
        "Completed Procedures",
        "LastUpdatedDay",
        "WorkingDay",
        "DaysSoFar",
        "Runrate",
        last_quarter.alias("LastQuarterProcedure * 4"),
        F.col("`P.Y. Completed Procedures`").alias("LastYearProcedure"),
        projected_year.alias("Runrate * 4"),
        (projected_year - systems).alias("Overflow/Underflow - Runrate * 4"),
        (last_quarter - systems).alias("Overflow/Underflow - LastQuarterProcedure * 4"),
        *rules.pathway_pillars,
        "Number of Surgeon Contacts",
        "BAM Volume (Past 1 Year)",
        "procedure_1year_before",
        "latestinstalleddate",
    )

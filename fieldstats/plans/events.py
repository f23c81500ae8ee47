"""Event history: capital and clinical activities of the quarter in one log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstats.functions.dates import extract_stamp, near_range, quarter_key, shift_zone
from fieldstats.functions.text import first_like
from fieldstats.operators.combine import union_to_schema
from fieldstats.operators.lists import distinct_lists
from fieldstats.params import JobParams

# Columns of the log in their order.
EVENT_LOG = T.StructType(
    [
        T.StructField(name, kind)
        for kind, names in (
            (T.StringType(), ["CAPITAL_OR_CLINICAL"]),
            (T.TimestampNTZType(), ["ExtractedDate"]),
            (T.StringType(), ["activityid", "relatedtoid", "RelatedObjectType", "OpportunityName"]),
            (T.DateType(), ["CloseDate"]),
            (T.StringType(), ["CloseQuarter"]),
            (T.BooleanType(), ["OPPORTUNITY_ISDELETED"]),
            (T.StringType(), ["OPPORTUNITY_STATUS"]),
            (T.DateType(), ["CreatedDate"]),
            (T.BooleanType(), ["ClosedFlag", "IsWonFlag"]),
            (
                T.StringType(),
                ["ForecastCategory", "ForecastCategoryName", "TransactionStructure", "AVPCall", "Color"],
            ),
            (T.DoubleType(), ["Amount", "ExpectedAmount", "ProbabilityPercent", "Quantity"]),
            (
                T.StringType(),
                [
                    "FinancePartner",
                    "BudgetCycle",
                    "Money",
                    "Method",
                    "ProductName",
                    "ProductFamily",
                    "ProductType",
                    "OpportunityType",
                    "CapitalCustomerType",
                    "accountguid",
                    "AccountName",
                    "CustomerType",
                    "top_Tier",
                    "Top_GF",
                    "subject",
                    "assignedtoid",
                    "AssignedTo",
                    "contact",
                    "ContactPersonName",
                    "SurgeonSpeciality",
                    "SurgeonCategory",
                    "type",
                    "SurgeonGUID",
                ],
            ),
            (T.BooleanType(), ["event_isdeleted"]),
            (
                T.StringType(),
                ["PathwayName_or_OpporunityName", "PathwayType", "createdbyid", "CreatedBy", "SalesStep"],
            ),
            (T.TimestampNTZType(), ["EventEndDateTime"]),
            (T.StringType(), ["eventstatus", "description", "pillar", "salessteptype", "priority"]),
        )
        for name in names
    ]
)


# The opportunity columns whose distinct rows count as one opportunity.
OPPORTUNITY_COLUMNS = [
    "opportunityid",
    "name",
    "accountguid",
    "closedate",
    "deleted",
    "status",
    "createddate",
    "closed",
    "won",
    "forecastcategory",
    "forecastcategoryname",
    "transactionstructure",
    "avpcall",
    "stage",
    "amount",
    "expectedamount",
    "probability",
    "quantity",
    "financingpartnername",
    "budgetcycle",
    "money",
    "method",
    "product",
    "productfamily",
    "producttype",
    "opportunitytype",
    "greenfield",
]


@dataclass(frozen=True)
class EventRules:
    """Names and ordered patterns of the event log; the patterns must be given and not be empty."""

    # system configuration prefix pattern -> product name, first match wins
    product_patterns: Sequence[tuple[str, str]]
    # pattern over the ordered product list -> product mix, first match wins
    mix_patterns: Sequence[tuple[str, str]]
    segment_pattern: str
    other_mix: str = "Others"
    excluded_deal: str = "Non System Deal"
    deal_corrections: tuple[tuple[str, str], ...] = (("Trade-In", "Trade-in"),)
    top_tier: str = "Tier 1"
    meeting_step: str = "Business Alignment Meeting"
    pathway_steps: Sequence[str] = ("Directional QTI", "Peer-to-peer event")
    technology_type: str = "Advanced Technology"

    def __post_init__(self) -> None:
        missing = [name for name in ("product_patterns", "mix_patterns", "segment_pattern") if not getattr(self, name)]
        if missing:
            raise ValueError(f"EventRules needs {', '.join(missing)}")


def product_mix(lines: DataFrame, rules: EventRules) -> DataFrame:
    """Per opportunity: ordered deal types and the label of its product mix."""
    deal = F.col("dealtype")
    for wrong, right in rules.deal_corrections:
        deal = F.when(F.col("dealtype") == wrong, F.lit(right)).otherwise(deal)
    kept = lines.where(~F.col("deleted") & F.col("systemline") & (F.col("dealtype") != rules.excluded_deal))
    named = kept.select(
        "opportunityid",
        deal.alias("deal"),
        first_like(F.col("systemconfigurationcpq"), rules.product_patterns).alias("product"),
    )
    listed = distinct_lists(named, ["opportunityid"], {"deal_types": "deal", "products": "product"}, ",")
    return listed.withColumn("product_type", first_like(F.col("products"), rules.mix_patterns, rules.other_mix))


def capital_events(tables: Mapping[str, DataFrame], params: JobParams, rules: EventRules) -> DataFrame:
    """Activities on opportunities of the region's accounts."""
    end = shift_zone(F.col("eventenddatetime"), params.source_zone, params.local_zone)
    events = tables["event"].where(
        (F.col("relatedobjecttype") == "Opportunity")
        & near_range(F.col("eventenddatetime"), params.quarter_first, params.next_quarter_first)
        & (end >= F.lit(params.quarter_first).cast("timestamp_ntz"))
        & (end < F.lit(params.next_quarter_first).cast("timestamp_ntz"))
    )
    tier = F.col("tiertype")
    green = F.col("greenfield")
    segment = F.col("japancustomersegment").like(rules.segment_pattern)
    accounts = (
        tables["account"]
        .where(F.col("capitalregion") == params.region)
        .select("accountguid", "accountname", "customertype", "tiertype", "japancustomersegment")
    )
    # opportunity, account and line items first: each event then takes one join for them
    opportunities = (
        tables["opportunity"]
        .select(*OPPORTUNITY_COLUMNS)
        .distinct()
        .join(accounts, "accountguid")
        .join(product_mix(tables["opportunity_line"], rules), "opportunityid", "left")
        .withColumnsRenamed({"status": "opportunity_status", "name": "opportunity_name"})
    )
    contacts = tables["contact"].select(
        F.col("contactguid").alias("contact"), "fullname", "specialtyname", "surgeoncategory"
    )
    users = tables["user"].select("userid", F.col("fullname").alias("user_name"))
    rows = (
        events.join(opportunities, events["relatedtoid"] == opportunities["opportunityid"])
        .join(contacts, "contact", "left")
        .join(users.toDF("assignedtoid", "assigned_name"), "assignedtoid", "left")
        .join(users.toDF("createdbyid", "created_name"), "createdbyid", "left")
    )
    return rows.select(
        F.lit("Capital").alias("CAPITAL_OR_CLINICAL"),
        extract_stamp(params).alias("ExtractedDate"),
        "activityid",
        "relatedtoid",
        F.col("relatedobjecttype").alias("RelatedObjectType"),
        F.col("opportunity_name").alias("OpportunityName"),
        F.col("closedate").alias("CloseDate"),
        quarter_key(F.col("closedate")).alias("CloseQuarter"),
        opportunities["deleted"].alias("OPPORTUNITY_ISDELETED"),
        F.col("opportunity_status").alias("OPPORTUNITY_STATUS"),
        F.col("createddate").alias("CreatedDate"),
        F.col("closed").alias("ClosedFlag"),
        F.col("won").alias("IsWonFlag"),
        F.col("forecastcategory").alias("ForecastCategory"),
        F.col("forecastcategoryname").alias("ForecastCategoryName"),
        F.col("transactionstructure").alias("TransactionStructure"),
        F.col("avpcall").alias("AVPCall"),
        F.col("stage").alias("Color"),
        F.col("amount").alias("Amount"),
        F.col("expectedamount").alias("ExpectedAmount"),
        F.col("probability").alias("ProbabilityPercent"),
        F.col("quantity").alias("Quantity"),
        F.col("financingpartnername").alias("FinancePartner"),
        F.col("budgetcycle").alias("BudgetCycle"),
        F.col("money").alias("Money"),
        F.col("method").alias("Method"),
        F.col("product_type").alias("ProductName"),
        F.col("productfamily").alias("ProductFamily"),
        F.col("producttype").alias("ProductType"),
        F.when(green, "Greenfield").otherwise(F.col("deal_types")).alias("OpportunityType"),
        F.when(~green & (tier == rules.top_tier), "Existing - Tier 1")
        .when(~green & (tier != rules.top_tier), "Existing - Non-Tier 1")
        .when(green & (tier == rules.top_tier), "Greenfield - Tier 1")
        .when(green & segment, "Greenfield - Top 300")
        .when(green, "Greenfield - Other GF")
        .otherwise("Others")
        .alias("CapitalCustomerType"),
        "accountguid",
        F.col("accountname").alias("AccountName"),
        F.col("customertype").alias("CustomerType"),
        F.when(tier == rules.top_tier, "Tier 1").when(tier != rules.top_tier, "Non-Tier 1").alias("top_Tier"),
        F.when(segment, "Top 300").otherwise("Non-Top 300").alias("Top_GF"),
        "subject",
        "assignedtoid",
        F.col("assigned_name").alias("AssignedTo"),
        "contact",
        F.col("fullname").alias("ContactPersonName"),
        F.col("specialtyname").alias("SurgeonSpeciality"),
        F.col("surgeoncategory").alias("SurgeonCategory"),
        "createdbyid",
        F.col("created_name").alias("CreatedBy"),
        F.col("salesstep").alias("SalesStep"),
        end.alias("EventEndDateTime"),
        "eventstatus",
        "description",
        "pillar",
        "salessteptype",
        "priority",
    )


def clinical_events(tables: Mapping[str, DataFrame], params: JobParams, rules: EventRules) -> DataFrame:
    """Activities on pathways, and on opportunities, seen by the clinical team."""
    events = tables["event"].where(
        F.col("relatedobjecttype").isin("Opportunity", "Pathway")
        & (F.col("duedateonly") >= F.lit(params.quarter_first))
        & (F.col("duedateonly") < F.lit(params.next_quarter_first))
    )
    region = tables["account"].select("accountguid", "capitalregion")
    surgeon_account = (
        tables["contact"]
        .select(F.col("contactguid").alias("pathway_surgeon"), "accountguid")
        .join(region.withColumn("pathway_account", F.col("accountguid")), "accountguid", "left")
        .select("pathway_surgeon", "pathway_account", F.col("capitalregion").alias("pathway_region"))
    )
    pathways = (
        tables["milestone_pathway"]
        .select(
            F.col("milestonepathwayguid").alias("relatedtoid"),
            "pathwayname",
            F.col("surgeonguid").alias("pathway_surgeon"),
            "recordtypeid",
        )
        .join(tables["record_type"].select("recordtypeid", "recordtypename"), "recordtypeid", "left")
        .join(surgeon_account, "pathway_surgeon", "left")
        .drop("recordtypeid")
    )
    opportunities = (
        tables["opportunity"]
        .select(
            F.col("opportunityid").alias("relatedtoid"),
            F.col("accountguid").alias("opportunity_account"),
            F.col("name").alias("opportunity_name"),
        )
        .distinct()
        .join(region.toDF("opportunity_account", "opportunity_region"), "opportunity_account", "left")
    )
    named = tables["contact"].select(F.col("contactguid").alias("nameid"), F.col("contactguid").alias("named_contact"))
    # what an event can relate to, in one lookup: each event is joined to it once
    related = pathways.join(opportunities, "relatedtoid", "full")
    rows = (
        events.join(related, "relatedtoid", "left")
        .where(F.coalesce("pathway_region", "opportunity_region") == params.region)
        .join(named, "nameid", "left")
    )
    pathway = F.col("relatedobjecttype") == "Pathway"
    meeting = (F.col("relatedobjecttype") == "Opportunity") & (F.col("salesstep") == rules.meeting_step)
    return rows.select(
        F.lit("Clinical").alias("CAPITAL_OR_CLINICAL"),
        extract_stamp(params).alias("ExtractedDate"),
        "activityid",
        "relatedtoid",
        F.col("relatedobjecttype").alias("RelatedObjectType"),
        F.when(pathway, F.col("pathway_account")).when(meeting, F.col("opportunity_account")).alias("accountguid"),
        "subject",
        "assignedtoid",
        F.when(pathway & F.col("salesstep").isin(list(rules.pathway_steps)), "Pathway")
        .when(meeting, "BAM")
        .when(F.col("recordtypename") == rules.technology_type, F.lit(rules.technology_type))
        .when(pathway & F.col("pathwayname").isNotNull(), "Pathway")
        .alias("type"),
        F.when(pathway, F.col("pathway_surgeon")).when(meeting, F.col("named_contact")).alias("SurgeonGUID"),
        F.col("deleted").alias("event_isdeleted"),
        F.coalesce("pathwayname", "opportunity_name").alias("PathwayName_or_OpporunityName"),
        F.col("recordtypename").alias("PathwayType"),
        "createdbyid",
        F.col("salesstep").alias("SalesStep"),
        F.col("duedateonly").cast("timestamp_ntz").alias("EventEndDateTime"),
        "eventstatus",
        "description",
        "pillar",
        "salessteptype",
        "priority",
    )


def event_log(tables: Mapping[str, DataFrame], params: JobParams, rules: EventRules) -> DataFrame:
    """Both branches in the declared columns; absent columns are NULL."""
    return union_to_schema(
        [capital_events(tables, params, rules), clinical_events(tables, params, rules)], EVENT_LOG
    )

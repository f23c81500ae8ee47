"""App usage per case."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstats.functions.dates import minutes_between, quarter_index, quarter_label
from fieldstats.operators.lookup import cross_one_row, drop_members
from fieldstats.operators.tiers import productivity_group
from fieldstats.params import JobParams


@dataclass(frozen=True)
class UsageRules:
    """Names and limits of the usage sources."""

    app: str
    page: str = "case_details"
    action: str = "load"
    cases_since: date = date(2023, 1, 1)
    excluded_users: Sequence[str] = ()
    done_statuses: Sequence[str] = ("OnSite", "Complete", "Completed")
    earliest_minutes: int = -120


def _quarter(day: date) -> int:
    return (day.month - 1) // 3 + 1


def prior_quarter_flag(day: Column, as_of: date, exact: bool = False) -> Column:
    """1 where the day lies in the quarter before ``as_of``, found by going back 90 days.

    In the last days of a long quarter, 90 days back is still the same quarter;
    ``exact`` counts quarters instead.
    """
    if exact:
        hit = quarter_index(day) == as_of.year * 4 + _quarter(as_of) - 2
    else:
        same_year = (F.year(day) == as_of.year) & (F.quarter(day) == _quarter(as_of - timedelta(90)))
        last_year = F.lit(_quarter(as_of) == 1) & (F.quarter(day) == 4)
        hit = same_year | ((F.year(day) == (as_of - timedelta(365)).year) & last_year)
    return F.when(hit, 1).otherwise(0)


def two_quarters_prior_flag(day: Column, as_of: date, exact: bool = False) -> Column:
    """1 where the day lies two quarters before ``as_of``, found by going back 180 days."""
    if exact:
        hit = quarter_index(day) == as_of.year * 4 + _quarter(as_of) - 3
    else:
        same_year = (F.year(day) == as_of.year) & (F.quarter(day) == _quarter(as_of - timedelta(180)))
        wanted = {1: 3, 2: 4}.get(_quarter(as_of))
        last_year = F.lit(False) if wanted is None else F.quarter(day) == wanted
        hit = same_year | ((F.year(day) == (as_of - timedelta(365)).year) & last_year)
    return F.when(hit, 1).otherwise(0)


def case_details(tables: Mapping[str, DataFrame], rules: UsageRules) -> DataFrame:
    """Cases with system, account and summary, since a first day."""
    summary = tables["procedure_summary"].where(F.col("localproceduredate") >= F.lit(rules.cases_since))
    fact = tables["app_procedure"].select(
        "procedure_name", "subject__c", "casenumber", "sk_system_install_id", "sk_account_id"
    )
    return (
        fact.join(
            summary.select(
                F.col("casenumber").alias("procedure_name"),
                "runrate",
                "category",
                "customersegmentation",
                "proceduresubject",
                "clinicalregion",
                "calqtroffset",
                "cvp",
                "csd",
                "ugsrname",
                "spsmname",
                "tiertype",
                "systemmodelname",
            ),
            "procedure_name",
        )
        .join(tables["app_system_install"].select("sk_system_install_id", "system_name"), "sk_system_install_id")
        .join(
            tables["app_account"].select("sk_account_id", "sfdc_account_id", "account_name", "billing_country"),
            "sk_account_id",
        )
    )


def productivity(tables: Mapping[str, DataFrame], params: JobParams) -> DataFrame:
    """Productivity group per app user by distinct cases of the last full quarter."""
    day = F.col("procedure_date_local")
    cases = tables["app_procedure"].where(
        (day >= F.lit(params.previous_quarter_first)) & (day < F.lit(params.quarter_first))
    )
    users = tables["app_user"].select("sk_user_id", "sfdc_contact_id", "contact_name")
    counted = cases.groupBy("sk_user_id").agg(F.count_distinct("casenumber").alias("cnts"))
    return counted.join(users, "sk_user_id").withColumn("productivity_group", productivity_group(F.col("cnts")))


def page_usage(tables: Mapping[str, DataFrame], rules: UsageRules) -> DataFrame:
    """First view, views and distinct sessions per user and case."""
    views = tables["web_analytics"].where(
        (F.col("appname_outer") == rules.app)
        & (F.col("kingdom") == rules.page)
        & (F.col("family") == rules.action)
        & F.col("class").isNotNull()
    )
    used = views.groupBy("umaid_derived", F.col("class").alias("casenumber")).agg(
        F.min("event_date").alias("first_viewed_date"),
        F.count(F.lit(1)).alias("number_of_views_bysurgeon"),
        F.count_distinct("session_id").alias("number_of_sessions_bysurgeon"),
    )
    users = tables["app_user"].select("sk_user_id", F.col("uma_user_id").alias("umaid_derived"))
    return used.join(users, "umaid_derived")


def logged_cases(tables: Mapping[str, DataFrame], rules: UsageRules) -> DataFrame:
    """Cases with a log-on no earlier than the limit before the case start."""
    gap = minutes_between(F.col("starttimegmt"), F.col("logontimestampgmt"))
    cases = tables["telemetry_case"].where(F.col("status__c").isin(list(rules.done_statuses)))
    return (
        tables["telemetry_log"]
        .where(F.col("uuid") > 0)
        .join(tables["telemetry_summary"], "procedureid")
        .withColumn("timediff_between_sources", gap)
        .where(F.col("timediff_between_sources") >= rules.earliest_minutes)
        .join(tables["telemetry_meta"], "caseuid")
        .join(cases, F.col("remotefe_procedure_id__c") == F.col("meta_procedureid"))
        .join(
            tables["app_system"].select(F.col("system_name").alias("systemname"), "cloud_login_enabled_date"),
            "systemname",
        )
        .where(F.col("procedure_date_gmt__c") >= F.col("cloud_login_enabled_date"))
        .select("name", "procedure_date_local__c", "timediff_between_sources")
    )


def app_usage(tables: Mapping[str, DataFrame], params: JobParams, rules: UsageRules) -> DataFrame:
    """Surgeon details of the region's cases with user, case, usage and log-on columns."""
    users = tables["app_user"].select(
        "sfdc_contact_id",
        "uma_user_id",
        "registration_completed_date",
        "isi_title",
        "surgeon_specialty",
        "mailing_country",
    )
    cases = case_details(tables, rules).where(F.col("clinicalregion") == params.region)
    cases = cases.drop("sk_system_install_id", "sk_account_id").withColumnRenamed("casenumber", "__case")
    groups = productivity(tables, params).select("sfdc_contact_id", "productivity_group")
    usage = page_usage(tables, rules).select(
        F.col("umaid_derived").alias("uma_user_id"),
        F.col("casenumber").alias("__case"),
        "first_viewed_date",
        "number_of_views_bysurgeon",
        "number_of_sessions_bysurgeon",
    )
    logged = logged_cases(tables, rules).select(
        F.col("name").alias("procedure_name"),
        F.col("name").alias("log_casenumber"),
        F.col("procedure_date_local__c").alias("log_procedure_date_local"),
    )
    registered = (
        tables["app_user"]
        .where(F.col("registration_completed_date").isNotNull() & (F.col("invited_flag") == 1))
        .agg(F.count("sfdc_contact_id").alias("registration_count"))
    )
    details = drop_members(tables["surgeon_details"], "sfdc_contact_id", rules.excluded_users)
    day = F.to_date("procedure_date_local__c")
    # cases with their log-ons, and users with their groups, are put together first:
    # the detail rows then take one join for each
    cases = cases.join(logged, "procedure_name", "left").withColumnRenamed("procedure_name", "casenumber")
    users = users.join(groups, "sfdc_contact_id", "left")
    rows = (
        details.join(cases, "casenumber")
        .join(users, "sfdc_contact_id", "left")
        .join(usage, ["uma_user_id", "__case"], "left")
        .withColumns(
            {
                "prior_completed_quarter_flag": prior_quarter_flag(day, params.as_of),
                "two_prior_completed_quarters_flag": two_quarters_prior_flag(day, params.as_of),
                "First_Cloud_Login_Quarter": quarter_label(F.to_date("first_cloud_login")),
            }
        )
        .drop("__case", "uma_user_id")
    )
    return cross_one_row(rows, registered)

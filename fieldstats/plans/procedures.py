"""Row-level procedure products: the current quarter, and durations with tiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstats.functions.dates import coalesced_in_range, extract_stamp, index_key, quarter_index, quarter_key, week_index, week_of_quarter
from fieldstats.functions.text import in_class
from fieldstats.operators.lookup import cross_one_row
from fieldstats.operators.pivots import sums_where
from fieldstats.operators.ranking import first_row_per_key
from fieldstats.operators.runrate import case_periods, case_volume, run_rate_calendar
from fieldstats.operators.tiers import NO_PRIOR_ACTIVITY, cohort_tier, volume_tier
from fieldstats.params import JobParams


@dataclass(frozen=True)
class SnapshotRules:
    """Lists the procedure products depend on; the first three must be given and not be empty."""

    growth_classes: Sequence[str]
    training_type: str
    growth_category: str
    training_role: str = "Surgeon"
    training_since: date = date(2019, 1, 1)
    onsite_status: str = "OnSite"

    def __post_init__(self) -> None:
        missing = [name for name in ("growth_classes", "training_type", "growth_category") if not getattr(self, name)]
        if missing:
            raise ValueError(f"SnapshotRules needs {', '.join(missing)}")


def prior_quarter_cohort(procedures: DataFrame, params: JobParams) -> DataFrame:
    """Tier of each surgeon id by its completed cases of the previous quarter."""
    recent = coalesced_in_range(
        F.col("proceduredatelocal"),
        F.col("scheduledstartdate"),
        params.previous_quarter_first,
        params.quarter_first,
    )
    return (
        procedures.where(recent & (F.col("status") == params.completed))
        .groupBy("surgeonid")
        .agg(F.count("casenumber").alias("n_previous"))
        .withColumn("cohort", cohort_tier(F.col("n_previous")))
    )


def latest_training(tables: Mapping[str, DataFrame], params: JobParams, rules: SnapshotRules) -> DataFrame:
    """The latest finished training per attendee, with its trainer."""
    registration = tables["event_registration"].where(F.col("eventstatus") == params.completed)
    attendees = tables["contact"].where(F.col("endcustomermailingcountry") == params.country)
    done = (
        tables["certification"]
        .where(
            (F.col("eventtype") == rules.training_type)
            & (F.col("role") == rules.training_role)
            & (F.col("certificationdate") >= F.lit(rules.training_since))
        )
        .join(registration.select(F.col("recordid").alias("eventregistration"), "csrguid"), "eventregistration")
        .join(attendees.select(F.col("contactguid").alias("contact")), "contact", "left_semi")
        .select("contact", "certificationdate", "csr", "csrguid", F.coalesce("csr", "csrguid").alias("trainer"))
    )
    order = [F.col("certificationdate").desc_nulls_first(), F.col("trainer").asc_nulls_last(), F.col("csrguid").asc_nulls_last()]
    latest = first_row_per_key(done, ["contact"], order)
    user = tables["user"].select("userid", "fullname")
    own = user.toDF("csr", "own_name")
    registered = user.toDF("csrguid", "registered_name")
    return (
        latest.join(own, "csr", "left")
        .join(registered, "csrguid", "left")
        .select(
            F.col("contact").alias("contactguid"),
            F.coalesce("own_name", "registered_name").alias("TrainedFrom"),
            F.col("trainer").alias("TrainingCSRGUID"),
            F.col("certificationdate").alias("EndDateTime"),
            F.lit("Completed").alias("EventStatus"),
        )
    )


def quota_by_quarter(
    tables: Mapping[str, DataFrame], params: JobParams, rules: SnapshotRules, only_current: bool = False
) -> DataFrame:
    """Forecast sums per hospital of the region and quarter, by bucket; of the running quarter only, if so wanted."""
    hospitals = tables["account"].where(
        (F.col("capitalregion") == params.region) & (F.col("recordtype") == params.record_type)
    )
    bucket = F.when(F.col("businesscategory") == rules.growth_category, "Growth").otherwise(F.col("businesscategory"))
    quota = tables["account_quota"]
    if only_current:  # on the columns themselves, so that it reaches the scan
        year, quarter = params.quarter_key.split("-")
        quota = quota.where((F.col("fiscalyear") == F.lit(year)) & (F.col("quarter") == F.lit(quarter)))
    summed = quota.groupBy("accountguid", F.concat("fiscalyear", F.lit("-"), "quarter").alias("quarter_key")).agg(
        *sums_where(
            {
                "Other - Forecast": F.coalesce(bucket == "Other", F.lit(False)),
                "Growth - Forecast": F.coalesce(bucket == "Growth", F.lit(False)),
                "All - Forecast": F.lit(True),
            },
            F.coalesce("forecast", F.lit(0)),
            empty_as_zero=True,
        )
    )
    return summed.join(hospitals, "accountguid", "left_semi")


def quarter_snapshot(tables: Mapping[str, DataFrame], params: JobParams, rules: SnapshotRules) -> DataFrame:
    """Every procedure of the running quarter with its account, surgeon and forecast.

    All account lookups are joined to each other first and all surgeon lookups
    likewise, so the procedures themselves take part in two joins only.
    """
    low, high = params.quarter_first, params.next_quarter_first
    account = (
        tables["account"]
        .where((F.col("capitalregion") == params.region) & (F.col("recordtype") == params.record_type))
        .select("accountid", "accountguid", "accountname", "endcustomerstateprovince")
        .join(
            tables["account_team"].select("accountguid", "ssmname", "csdname", "csmname", "csrname"),
            "accountguid",
            "left",
        )
        .join(
            quota_by_quarter(tables, params, rules, only_current=True).drop("quarter_key"),
            "accountguid",
            "left",
        )
    )
    surgeon = (
        tables["contact"]
        .select("contactguid", "contactid", "fullname", "specialtyname", "surgeoncategory")
        .join(
            prior_quarter_cohort(tables["procedures"], params).select(F.col("surgeonid").alias("contactid"), "cohort"),
            "contactid",
            "left",
        )
        .join(latest_training(tables, params, rules), "contactguid", "left")
    )
    day = F.coalesce("proceduredatelocal", "scheduledstartdate")
    current = tables["procedures"].where(
        coalesced_in_range(F.col("proceduredatelocal"), F.col("scheduledstartdate"), low, high)
    )
    rows = current.join(account, "accountguid").join(
        surgeon, F.col("surgeonguid") == F.col("contactguid"), "left"
    )
    return rows.select(
        extract_stamp(params).alias("ExtractedDate"),
        F.col("businesscategoryname").alias("BusinessCategory"),
        F.col("subject").alias("Subject"),
        F.col("procedurename").alias("ProcedureName"),
        (F.col("proceduredurationinseconds") / 60).alias("ProcedureDurationMin"),
        quarter_key(day).alias("Quarter"),
        week_index(day).alias("Week"),
        week_of_quarter(day, F.lit(low)).alias("Week of the Quarter"),
        day.alias("ProcedureDateLocal"),
        F.col("status").alias("Status"),
        in_class(
            [F.col("businesscategoryname"), F.col("subject")], rules.growth_classes, "Growth", "Others"
        ).alias("GP/Others"),
        F.col("casenumber").alias("ProcedureNumber"),
        F.col("recordid").alias("ProcedureGUID"),
        F.col("accountid").alias("AccountID"),
        F.col("accountguid").alias("AccountGUID"),
        F.col("accountname").alias("AccountName"),
        F.col("endcustomerstateprovince").alias("Prefecture"),
        F.col("ssmname").alias("SSMName"),
        F.col("csdname").alias("CSDName"),
        F.col("csmname").alias("CSMName"),
        F.col("csrname").alias("CSRName"),
        F.col("fullname").alias("SurgeonName"),
        F.col("contactguid").alias("ContactGUID"),
        F.col("specialtyname").alias("SurgeonSpeciality"),
        F.col("surgeoncategory").alias("SurgeonCategory"),
        F.when(F.col("status") == rules.onsite_status, F.lit(rules.onsite_status))
        .otherwise(F.coalesce("cohort", F.lit(NO_PRIOR_ACTIVITY)))
        .alias("SurgeonPopulation(LastQuarter)"),
        "TrainedFrom",
        "TrainingCSRGUID",
        "EndDateTime",
        "EventStatus",
        "Other - Forecast",
        "Growth - Forecast",
        "All - Forecast",
    )


def surgeon_volume(cases: DataFrame, params: JobParams, calendar: DataFrame) -> DataFrame:
    """Per surgeon and quarter: tiers by distinct cases and by projected volume.

    Cases are counted as whole numbers and projected once per group, so no
    rounding of single weights can move a group over a limit.
    """
    running, earlier = case_periods(params, F.col("proceduredatelocal"), F.col("status"))
    counted = cases.groupBy("surgeonguid", quarter_index(F.col("proceduredatelocal")).alias("quarter_index")).agg(
        F.count_distinct("recordid").alias("n_cases"),
        F.count(F.when(running, 1)).alias("n_running"),
        F.count(F.when(~running & earlier, 1)).alias("n_earlier"),
    )
    so_far = F.try_divide(F.col("n_running") * F.col("workingday"), "dayssofar")
    volume = F.col("n_earlier") + F.when(F.col("n_running") > 0, so_far).otherwise(F.lit(0.0))
    return cross_one_row(counted, calendar).select(
        "surgeonguid",
        "quarter_index",
        volume_tier(F.col("n_cases")).alias("by_cases"),
        volume_tier(volume).alias("by_volume"),
    )


def duration_population(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    params: JobParams,
    rules: SnapshotRules,
    calendar: DataFrame | None = None,
    tier_calendar: DataFrame | None = None,
) -> DataFrame:
    """Procedures of the last years with duration, projected volume and surgeon tier.

    ``tier_calendar`` is the working-day row used for the tiers, where it differs
    from the one used for the rows.

    The lookups are joined to the procedures from the narrowest to the widest, the
    account with its team last, so that no later join shuffles the account's columns.
    """
    calendar = run_rate_calendar(spark, params) if calendar is None else calendar
    hospitals = tables["account"].where(F.col("recordtype") == params.record_type)
    recent = tables["procedures"].where(F.col("proceduredatelocal") >= F.lit(params.history_first))
    volume = case_volume(params, F.col("proceduredatelocal"), F.col("status"))

    tiers = surgeon_volume(
        recent.join(hospitals.select("accountguid"), "accountguid", "left_semi"),
        params,
        calendar if tier_calendar is None else tier_calendar,
    )

    account = hospitals.select(
        "accountguid",
        "accountid",
        "accountname",
        "capitalregion",
        "customertype",
        "endcustomerstateprovince",
        "parentaccountname",
        F.when(F.col("tier1"), "Tier 1").when(~F.col("tier1"), "Non-Tier 1").alias("tier_label"),
    ).join(
        tables["account_team"].select(
            "accountguid", "asdname", "asmname", "csdname", "csmname", "csrname", "ssmname"
        ),
        "accountguid",
        "left",
    )
    contact = tables["contact"].select("contactguid", "fullname", "specialtyname")
    system = tables["installbase"].select(
        "installbaseguid", "name", "model", "financeinstalleddate"
    )
    # Every row of a hospital has its surgeon and quarter among the tiers, so the names are joined to those.
    surgeon = tiers.join(contact, F.col("surgeonguid") == F.col("contactguid"), "left").drop("contactguid")
    rows = recent.withColumn("quarter_index", quarter_index(F.col("proceduredatelocal")))
    rows = rows.join(system, F.col("installedbaseguid") == F.col("installbaseguid"), "left")
    rows = rows.join(surgeon, ["surgeonguid", "quarter_index"], "left")
    rows = rows.join(account, "accountguid")
    rows = cross_one_row(rows, calendar)
    minutes = F.col("proceduredurationinseconds") / 60
    return rows.select(
        F.col("capitalregion").alias("Region"),
        F.col("casenumber").alias("CaseNumber"),
        F.col("recordid").alias("ProcedureGUID"),
        F.col("surgeonguid").alias("SurgeonGUID"),
        F.col("businesscategoryname").alias("BusinessCategory"),
        F.col("subject").alias("Subject"),
        F.col("procedurename").alias("ProcedureName"),
        minutes.alias("ProcedureMins"),
        (minutes / 60).alias("ProcedureHour"),
        F.col("proceduredatelocal").alias("ProcedureDateLocal"),
        index_key(F.col("quarter_index")).alias("Quarter"),
        F.col("status").alias("Status"),
        F.col("fullname").alias("SurgeonName"),
        F.col("by_cases").alias("SurgeonPopulation"),
        F.col("by_volume").alias("SurgeonPopulation (Runrate)"),
        F.col("specialtyname").alias("SurgeonSpeciality"),
        F.col("endcustomerstateprovince").alias("Prefecture"),
        F.col("accountid").alias("AccountID"),
        F.col("accountguid").alias("AccountGUID"),
        F.col("accountname").alias("AccountName"),
        F.col("customertype").alias("CustomerType"),
        F.col("tier_label").alias("Tier 1"),
        F.col("asdname").alias("ASDName"),
        F.col("asmname").alias("ASMName"),
        F.col("csdname").alias("CSDName"),
        F.col("csmname").alias("CSMName"),
        F.col("csrname").alias("CSRName"),
        F.col("ssmname").alias("SSMName"),
        F.col("name").alias("Name"),
        F.col("model").alias("Model"),
        F.col("installbaseguid").alias("InstallBaseGUID"),
        F.col("financeinstalleddate").alias("FinanceInstalledDate"),
        F.col("parentaccountname").alias("IDN"),
        volume.alias("Procedure Volume (RR for CQ)"),
        in_class(
            [F.col("businesscategoryname"), F.col("subject")], rules.growth_classes, "Growth", "Others"
        ).alias("Bucket"),
    )

"""System utilization by quarter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstats.functions.dates import quarter_index, quarter_key
from fieldstats.operators.lookup import override_table, with_overrides
from fieldstats.operators.ranges import as_prior_period
from fieldstats.operators.spine import calendar_spine
from fieldstats.params import JobParams

# Fixed value: start quarter of systems without an install date.
NEVER = "9999-Q4"


@dataclass(frozen=True)
class UtilizationRules:
    """Corrections and limits of the system dates."""

    account_overrides: Sequence[tuple[str, str, str]] = ()  # account id, system, start quarter
    system_overrides: Sequence[tuple[str, str]] = ()  # system, start quarter
    reinstalled: Sequence[str] = ()  # systems dated by install and removal
    removed: Sequence[str] = ()  # systems that end with their removal
    uncounted_models: Sequence[str] = ()
    hidden_models: Sequence[str] = ()
    first_year: int = 2000
    last_year: int | None = None  # else the quarters end with that of the run date

    def last_index(self, params: JobParams) -> int:
        """The last quarter to be listed."""
        return params.quarter_index if self.last_year is None else self.last_year * 4 + 3


def _index_of_key(key: Column) -> Column:
    return F.left(key, F.lit(4)).cast("int") * 4 + F.right(key, F.lit(1)).cast("int") - 1


def with_validity(systems: DataFrame, rules: UtilizationRules) -> DataFrame:
    """Add ``start_quarter`` (text), ``start_index`` and ``end_index`` to each system.

    The start is the override of (account, system), else of the system, else the
    dated rule. The end is exclusive; NULL means still open. A removal that should
    end the interval but has no date leaves it empty.
    """
    spark = systems.sparkSession
    again = F.col("name").isin(list(rules.reinstalled))
    rule = (
        F.when(again & F.col("inactive"), quarter_key(F.col("financeinstalleddate")))
        .when(again & ~F.col("inactive"), quarter_key(F.col("installdate")))
        .when(F.col("financeinstalleddate").isNull(), F.lit(NEVER))
        .otherwise(quarter_key(F.col("financeinstalleddate")))
    )
    overrides = []
    if rules.account_overrides:
        table = override_table(spark, rules.account_overrides, ["accountid", "name"], "start")
        overrides.append((table, ["accountid", "name"], "start"))
    if rules.system_overrides:
        overrides.append((override_table(spark, rules.system_overrides, ["name"], "start"), ["name"], "start"))
    dated = with_overrides(systems, "start_quarter", rule, overrides)
    removal = (again & F.col("inactive")) | F.col("name").isin(list(rules.removed))
    start = F.when(F.col("start_quarter") != NEVER, _index_of_key(F.col("start_quarter")))
    return dated.withColumn("start_index", start).withColumn(
        "end_index",
        F.when(removal, F.coalesce(quarter_index(F.col("removedate")), F.lit(0))).otherwise(
            quarter_index(F.col("financedeinstalleddate"))
        ),
    )


def systems_by_account(installbase: DataFrame, accounts: DataFrame, rules: UtilizationRules) -> DataFrame:
    """The system rows of the given accounts with their dates, one row per system row.

    Adds ``start_quarter``, ``start_index``, ``end_index`` (see ``with_validity``) and ``countable``.
    """
    countable = (
        (F.col("type") == "System") & (F.col("systemuse") == "OR") & ~F.col("model").isin(list(rules.uncounted_models))
    )
    rows = with_validity(installbase.join(accounts, "accountguid", "left_semi"), rules)
    return rows.withColumn("countable", F.coalesce(countable, F.lit(False))).select(
        "accountguid", "name", "accountname", "model", "start_quarter", "start_index", "end_index", "countable"
    )


def installed_counts(systems: DataFrame, keys: list[str], first: int, last: int) -> DataFrame:
    """(keys, quarter_index, n): countable rows installed in each quarter of [first, last] where n > 0.

    A sweep: every interval, clipped to the range, adds +1 at its start and -1 at its end;
    the changes are summed per key and quarter (at most one row per quarter, however many
    intervals a key has), and a running sum in quarter order gives the count, which holds up
    to the next change.
    """
    start = F.greatest(F.col("start_index"), F.lit(first))
    end = F.least(F.coalesce(F.col("end_index"), F.lit(last + 1)), F.lit(last + 1))
    spans = systems.where(F.col("countable") & F.col("start_index").isNotNull()).select(*keys, start.alias("s"), end.alias("e")).where(F.col("s") < F.col("e"))
    deltas = spans.select(*keys, F.col("s").alias("q"), F.lit(1).alias("d")).unionByName(
        spans.where(F.col("e") <= last).select(*keys, F.col("e").alias("q"), F.lit(-1).alias("d"))
    )
    changes = deltas.groupBy(*keys, "q").agg(F.sum("d").alias("d"))
    order = Window.partitionBy(*keys).orderBy("q")
    running = changes.select(
        *keys,
        "q",
        F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("n"),
        F.coalesce(F.lead("q").over(order), F.lit(last + 1)).alias("next"),
    )
    return running.where(F.col("n") > 0).select(
        *keys, F.explode(F.sequence(F.col("q"), F.col("next") - 1)).alias("quarter_index"), F.col("n").cast("bigint").alias("n")
    )


def listed_models(systems: DataFrame) -> DataFrame:
    """(accountguid, name, system_model, n_names): the distinct account names listed with each model of a system."""
    listed = systems.select("accountguid", "name", "accountname", F.col("model").alias("system_model")).distinct()
    return listed.groupBy("accountguid", "name", "system_model").agg(F.count(F.lit(1)).alias("n_names"))


def installed_by_quarter(systems: DataFrame, rules: UtilizationRules, params: JobParams) -> DataFrame:
    """Installed systems per account, system and quarter, with fleet flag and models.

    A system is installed from its start quarter up to before its end quarter. Every
    account name listed for a model counts the rows once more, as the distinct
    listing does. Counts and the models installed come from sweeps over the intervals.
    """
    first, last = rules.first_year * 4, rules.last_index(params)
    keys = ["accountguid", "name"]
    counts = installed_counts(systems, keys, first, last)
    models = installed_counts(systems, [*keys, "model"], first, last)
    combination = models.groupBy(*keys, "quarter_index").agg(
        F.array_join(F.sort_array(F.collect_set("model"), asc=False), ", ").alias("combination")
    )
    number = F.col("n") * F.col("n_names")
    return (
        counts.join(combination, [*keys, "quarter_index"])
        .join(listed_models(systems), keys)
        .select(
            *keys,
            "system_model",
            "quarter_index",
            number.alias("number_of_ib"),
            F.when(number > 1, "Fleet").otherwise("Others").alias("fleet_or_not"),
            "combination",
        )
    )


def utilization(tables: Mapping[str, DataFrame], params: JobParams, rules: UtilizationRules) -> DataFrame:
    """Run-rate over last quarter's installed count, per system and quarter; the flag is the offset from the running quarter.

    Installed counts of this and the last quarter come from one sweep per system; the
    spine of quarters meets them, the distinct name counts, start labels and listed
    models by key, each a table of at most a few rows per system.
    """
    region = tables["account"].where(F.col("clinicalregion") == params.region).select("accountguid")
    systems = systems_by_account(tables["installbase"], region, rules)
    first, last = rules.first_year * 4, rules.last_index(params)
    keys = ["accountguid", "name", "quarter_index"]
    quarter = F.col("quarter_index")
    system = ["accountguid", "name"]
    counts = installed_counts(systems, system, first, last)
    listed = listed_models(systems)
    names = listed.select(*system, "n_names").distinct()
    spine = (
        calendar_spine(systems.select(*system).distinct(), first, last)
        .join(counts.withColumnRenamed("n", "cq"), keys, "left")
        .join(as_prior_period(counts, "quarter_index", {"n": "pq"}), keys, "left")
        .join(names.withColumnRenamed("n_names", "n1"), system)
        .join(names.withColumnRenamed("n_names", "n2"), system)
        .select(*keys, "quarter", (F.col("n1") * F.col("cq")).alias("CQ_IB"), (F.col("n2") * F.col("pq")).alias("PQ_IB"))
        .distinct()
    )
    spine = (
        spine.join(systems.select(*system, F.col("start_quarter").alias("InstalldateQ")).distinct(), system)
        .join(systems.select(*system, "accountname", "model").distinct(), system)
        .where(~F.col("model").isin(list(rules.hidden_models)))
    )
    active = (
        tables["procedure_summary"]
        .where(F.col("clinicalregion") == params.region)
        .groupBy(
            "accountguid",
            "accountname",
            F.col("systemname").alias("name"),
            quarter_index(F.col("localproceduredate")).alias("quarter_index"),
        )
        .agg(F.lit(1).alias("n_active"), F.sum("runrate").alias("run_rate"))
        .select(*keys, "n_active", "run_rate")
        .distinct()
    )
    rows = spine.join(active.withColumnsRenamed({"n_active": "CQ_AS", "run_rate": "CQ_RR"}), keys, "left").join(
        as_prior_period(active, "quarter_index", {"n_active": "PQ_AS", "run_rate": "PQ_RR"}), keys, "left"
    )
    ratio = F.try_divide("CQ_RR", F.coalesce("PQ_IB", F.lit(1)))
    return rows.select(
        "quarter",
        "accountguid",
        "accountname",
        (quarter - params.quarter_index).alias("CURRENT_QUARTER_FLAG"),
        F.col("name").alias("SystemName"),
        F.col("model").alias("SystemModel"),
        "InstalldateQ",
        "PQ_IB",
        "CQ_IB",
        "CQ_AS",
        "PQ_AS",
        "PQ_RR",
        "CQ_RR",
        F.when((F.col("PQ_IB") == 0) & (F.col("CQ_RR") == 0), F.lit(0.0)).otherwise(ratio).alias("SystemUtilization"),
    )

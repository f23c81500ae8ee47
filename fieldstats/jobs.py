"""The two runs: the daily refresh of all result tables, and the yearly market export."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldstats.operators.runrate import run_rate_calendar
from fieldstats.params import JobParams
from fieldstats.plans.access import access_list, access_list_region
from fieldstats.plans.events import EventRules, event_log
from fieldstats.plans.market import counts_from_responses, counts_from_sheet, market_total
from fieldstats.plans.population import population_shift
from fieldstats.plans.procedures import SnapshotRules, duration_population, quarter_snapshot
from fieldstats.plans.scorecard import ScorecardRules, account_scorecard
from fieldstats.plans.usage import UsageRules, app_usage
from fieldstats.plans.utilization import UtilizationRules, utilization
from fieldstats.operators.lookup import key_report
from fieldstats.sources.readers import code_map, joined_codes, matching_codes, quarantined, read_responses, read_sheet
from fieldstats.sources.sinks import evenly_sized, export_dated, replace_table, write_snapshot_once


@dataclass(frozen=True)
class JobRules:
    """Lists and labels of all daily products."""

    usage: UsageRules
    snapshot: SnapshotRules
    scorecard: ScorecardRules
    utilization: UtilizationRules
    events: EventRules


@dataclass(frozen=True)
class Holidays:
    """Days off per block that projects the running quarter; None has none."""

    population: DataFrame | None = None
    duration: DataFrame | None = None
    duration_tiers: DataFrame | None = None
    scorecard: DataFrame | None = None


@dataclass(frozen=True)
class MarketRun:
    """Where the yearly export went, and what its input was like."""

    folder: str
    responses: int
    unreadable: int
    repeated_matching_codes: int
    repeated_map_codes: int
    quarantine: str  # the unreadable responses: year, code, reason, body (read again with ``replay``)
    keys: tuple = ()  # key counters of the code sheets, one dict per sheet (see ``key_report``)


def daily_products(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    params: JobParams,
    rules: JobRules,
    holidays: Holidays = Holidays(),
) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the result tables by name, in the order of the run."""

    def calendar(days: DataFrame | None) -> DataFrame:
        return run_rate_calendar(spark, params, days)

    return {
        "account_access": lambda: access_list(tables, params),
        "account_access_region": lambda: access_list_region(tables, params),
        "surgeon_population_shift": lambda: population_shift(spark, tables, params, calendar(holidays.population)),
        "procedures_current_quarter": lambda: quarter_snapshot(tables, params, rules.snapshot),
        "procedure_duration_population": lambda: duration_population(
            spark, tables, params, rules.snapshot, calendar(holidays.duration), calendar(holidays.duration_tiers)
        ),
        "account_scorecard": lambda: account_scorecard(spark, tables, params, rules.scorecard, calendar(holidays.scorecard)),
        "system_utilization": lambda: utilization(tables, params, rules.utilization),
        "app_usage": lambda: app_usage(tables, params, rules.usage),
    }


def daily_refresh(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    params: JobParams,
    rules: JobRules,
    database: str,
    event_log_path: str,
    holidays: Holidays = Holidays(),
) -> list[str]:
    """Replace every result table, then write the day's events; returns the table names.

    Tables are replaced one after the other. A failure ends the run and leaves the
    tables before it in their new state; running again is safe, also for the log.
    """
    written = []
    for name, build in daily_products(spark, tables, params, rules, holidays).items():
        replace_table(evenly_sized(build()), f"{database}.{name}")
        written.append(name)
    write_snapshot_once(event_log(tables, params, rules.events), event_log_path, params.as_of)
    return written


def yearly_market(
    spark: SparkSession,
    responses: str,
    matching: str,
    record: str,
    mapping: str,
    folder: str,
    day: date,
    replay: str | None = None,
) -> MarketRun:
    """Market size from landed responses and exported sheets, in a dated folder.

    Raises where nothing was landed or a sheet has no rows. Responses that cannot
    be read are written to a quarantine table beside the export (its path is in the
    result, and a mended copy can be given back as ``replay``); they and codes that
    are listed twice are counted in the result.
    """
    landed = read_responses(spark, responses, replay)
    sheets = {"matching": read_sheet(spark, matching), "record": read_sheet(spark, record), "mapping": read_sheet(spark, mapping)}
    # One pass over the landed files counts them and writes the unreadable ones aside, with their reason.
    seen = Observation(f"landed_{day.isoformat()}_{uuid.uuid4().hex}")
    counted = landed.observe(seen, F.count(F.lit(1)).alias("responses"))
    quarantine = f"{folder.rstrip('/')}/Quarantine_{day.isoformat()}_{uuid.uuid4().hex[:8]}"
    aside = Observation(f"unreadable_{day.isoformat()}_{uuid.uuid4().hex}")
    quarantined(counted).observe(aside, F.count(F.lit(1)).alias("unreadable")).write.parquet(quarantine)
    quality = {"responses": int(seen.get["responses"]), "unreadable": int(aside.get["unreadable"])}
    empty = [name for name, sheet in sheets.items() if sheet.isEmpty()] + ([] if quality["responses"] else ["responses"])
    if empty:
        raise ValueError(f"no rows in {', '.join(empty)}")
    codes, names = matching_codes(sheets["matching"]), code_map(sheets["mapping"])
    total = market_total(counts_from_responses(landed, codes), counts_from_sheet(sheets["record"], names))
    # Both sheets' key counters in one job: codes listed twice, and codes of the map the matching sheet lacks.
    checks = key_report("matching", joined_codes(codes), ["code"]).unionByName(
        key_report("mapping", joined_codes(names), ["code"], joined_codes(codes), ["code"])
    )
    keys = {r["table_name"]: r.asDict() for r in checks.collect()}
    return MarketRun(
        export_dated(total, folder, day),
        quality["responses"],
        quality["unreadable"],
        keys["matching"]["repeated_keys"],
        keys["mapping"]["repeated_keys"],
        quarantine,
        (keys["matching"], keys["mapping"]),
    )

"""Volume tiers and their shift over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

Tiers = Sequence[tuple[int, str]]

# Lower limits and labels, highest first.
STALLED = "Stalled"
POPULATION_TIERS: Tiers = (
    (70, "SuperMega"),
    (50, "MegaUser"),
    (30, "SuperUser"),
    (13, "Sustainable"),
    (7, "Bubble"),
    (1, "Dabbler"),
)
MODEL_TIERS: Tiers = ((13, "Sustainable"), (7, "Bubble"), (1, "Dabbler"))
DETAILED_TIERS: Tiers = (
    (20, "Super"),
    (13, "Sustainable"),
    (10, "Upper Bubble"),
    (7, "Lower Bubble"),
    (4, "Upper Dabbler"),
    (1, "Lower Dabbler"),
)
VOLUME_TIERS: Tiers = ((13, "Sustainable+"), (7, "Bubble"))
COHORT_TIERS: Tiers = ((13, "Sustainable"), (7, "Bubble"))
NO_PRIOR_ACTIVITY = "No Procedure in Last Quarter"
PRODUCTIVITY_TIERS: Tiers = (
    (70, "Super Mega User"),
    (50, "Mega User"),
    (30, "Super User"),
    (13, "Sustainable User"),
    (7, "Bubble"),
    (1, "Dabbler"),
)
NO_PRODUCTIVITY = "Untrained/Stalled"


def _chain(value: Column, tiers: Tiers, last: Column) -> Column:
    label = last
    for limit, name in reversed(tiers):
        label = F.when(value >= limit, F.lit(name)).otherwise(label)
    return label


def is_stalled(count: Column) -> Column:
    return count.isNull() | (count == 0)


def activity_tier(count: Column, tiers: Tiers) -> Column:
    """Tier of a count; none or 0 is stalled, a fraction below 1 has no tier."""
    return _chain(count, tiers, F.when(is_stalled(count), F.lit(STALLED)))


def volume_tier(volume: Column) -> Column:
    """Tier of a (projected) volume with its own label for no activity."""
    return _chain(volume, VOLUME_TIERS, F.when(volume == 0, F.lit("Non-Active")).otherwise(F.lit("Dabbler")))


def cohort_tier(count: Column) -> Column:
    """Tier of last quarter's count; a missing count has no prior activity."""
    low = F.when(count < 7, F.lit("Dabbler")).otherwise(F.lit(NO_PRIOR_ACTIVITY))
    return _chain(count, COHORT_TIERS, low)


def productivity_group(count: Column) -> Column:
    return _chain(count, PRODUCTIVITY_TIERS, F.lit(NO_PRODUCTIVITY))


def earlier(label: Column, periods: int, window: WindowSpec) -> Column:
    """Label some rows earlier; missing rows and missing labels read as stalled."""
    return F.coalesce(F.lag(label, periods).over(window), F.lit(STALLED))

"""Run parameters.

Every job takes its "now" from here, so a run can be repeated for any date and
all date limits reach the plan as literals (which Spark pushes into scans).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta


def add_months_first(first_of_month: date, months: int) -> date:
    """Move a first-of-month date by whole months."""
    index = first_of_month.year * 12 + first_of_month.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class JobParams:
    """Settings shared by all jobs."""

    as_of: date
    region: str
    country: str = ""
    record_type: str = "Hospital"
    completed: str = "Completed"
    # label -> system model value; each label becomes one set of pivoted columns
    models: tuple[tuple[str, str], ...] = ()
    spine_floor: date = date(2015, 1, 1)
    history_years: int = 4
    source_zone: str = "GMT"
    local_zone: str = "UTC"
    # when the extract was taken, stamped on the rows of the dated products; default: the start of the run date
    extracted_at: datetime | None = None

    @property
    def extract_stamp(self) -> datetime:
        return self.extracted_at or datetime.combine(self.as_of, time())

    @property
    def quarter_first(self) -> date:
        return date(self.as_of.year, (self.as_of.month - 1) // 3 * 3 + 1, 1)

    @property
    def next_quarter_first(self) -> date:
        return add_months_first(self.quarter_first, 3)

    @property
    def previous_quarter_first(self) -> date:
        return add_months_first(self.quarter_first, -3)

    @property
    def quarter_index(self) -> int:
        return self.as_of.year * 4 + (self.as_of.month - 1) // 3

    @property
    def floor_index(self) -> int:
        return self.spine_floor.year * 4 + (self.spine_floor.month - 1) // 3

    @property
    def quarter_key(self) -> str:
        return f"{self.as_of.year}-Q{(self.as_of.month - 1) // 3 + 1}"

    @property
    def week_cutoff(self) -> date:
        """Friday of the last full week before ``as_of`` (weeks start on Sunday)."""
        return self.as_of - timedelta(days=self.as_of.isoweekday() % 7 + 2)

    @property
    def history_first(self) -> date:
        return date(self.as_of.year - self.history_years, 1, 1)

    @property
    def year_ago(self) -> date:
        try:
            return self.as_of.replace(year=self.as_of.year - 1)
        except ValueError:  # 29 February
            return date(self.as_of.year - 1, 2, 28)

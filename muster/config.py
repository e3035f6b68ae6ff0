"""Run parameters of a refresh."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field


# Names in a settings document.
_SETTINGS = {
    "grace_time_minutes": "grace_minutes",
    "early_attribution_months": "early_attrition_months",
    "orphan_rate_max_pct": "orphan_rate_max_pct",
    "attendance_flag_max_overlap": "flag_max_overlap",
}


@dataclass(frozen=True)
class Config:
    """Thresholds and dates of one run.

    ``as_of`` replaces the database clock: it closes the headcount calendar and
    the tenure of active employees, and it is the date of a soft delete. With
    ``max_lost_values`` the run stops when more values of one column could not be
    parsed; without, they are counted in the log. When two business keys share a
    surrogate key, the contract names ``id: unique``, and another ``key_salt`` helps.
    """

    as_of: dt.date = field(default_factory=dt.date.today)
    run_at: dt.datetime = field(default_factory=lambda: dt.datetime.now().replace(microsecond=0))
    grace_minutes: int = 5
    early_attrition_months: int = 6
    rolling_window_rows: int = 7
    orphan_rate_max_pct: float = 99.9
    flag_max_overlap: int = 2
    fail_on_quality: bool = False
    fail_on_contract: bool = True
    fail_on_malformed: bool = True
    max_lost_values: int | None = None
    key_salt: int = 0

    @classmethod
    def from_settings(cls, settings: Mapping, **overrides) -> Config:
        """Thresholds from the ``etl`` section of a settings document; the rest by keyword."""
        section = settings.get("etl", {})
        known = {ours: section[theirs] for theirs, ours in _SETTINGS.items() if theirs in section}
        return cls(**{**known, **overrides})

"""Study parameters. Operators hold no date literals; they read them from here."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

DateWindow = tuple[dt.date, dt.date]


@dataclass(frozen=True)
class StudyConfig:
    """Parameters shared by all plans. Windows are half open: [from, to)."""

    # Date of the data pull, freeze date and study windows.
    # "Today" for every activity flag, so that results do not change daily.
    as_of: dt.date = dt.date(2026, 4, 6)
    # Load timestamp written into pulled_at / detected_at.
    run_ts: dt.datetime = dt.datetime(2026, 4, 6)
    freeze_date: dt.date = dt.date(2025, 4, 30)

    prior_half: DateWindow = (dt.date(2024, 10, 1), dt.date(2025, 4, 1))
    current_half: DateWindow = (dt.date(2025, 10, 1), dt.date(2026, 4, 1))
    timeline: DateWindow = (dt.date(2025, 1, 1), dt.date(2026, 4, 1))

    baseline: DateWindow = (dt.date(2023, 1, 1), dt.date(2025, 5, 1))
    comparison: DateWindow = (dt.date(2025, 10, 1), dt.date(2026, 4, 1))
    # (directorate, first day of month) pairs left out of the baseline.
    baseline_exclusions: tuple[tuple[str, dt.date], ...] = (("TIP", dt.date(2024, 2, 1)),)

    # A recipient is academic when its name contains one of these.
    academic_keywords: tuple[str, ...] = (
        "UNIVERSITY",
        "COLLEGE",
        "INSTITUTE OF TECHNOLOGY",
        "POLYTECHNIC",
    )

    agency_id: int = 1
    open_lookback_months: int = 18
    ended_lookback_months: int = 12
    reporting_lag_days: int = 90
    untracked_threshold: float = -100_000.0
    boxplot_min_group: int = 3
    whisker_factor: float = 1.5
    program_min_terminations: int = 10
    program_top_k: int = 15
    search_limit: int = 25
    strict_names: bool = False


DEFAULT_CONFIG = StudyConfig()


def fiscal_year_of(day: dt.date) -> int:
    """US federal fiscal year: October starts the next one."""
    return day.year + (1 if day.month >= 10 else 0)

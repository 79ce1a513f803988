"""Row flags and predicates. Each takes columns and, where it matters, a date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantlens.config import StudyConfig, fiscal_year_of


def has_key(key: Column) -> Column:
    return key.isNotNull() & (key != "")


def in_agency_scope(agency_name: Column, agency_code: Column, cfda_numbers: Column) -> Column:
    """Opportunity belongs to the agency by name, code or listing prefix.

    The prefix counts at the start of the list or right after a comma only.
    """
    return (
        F.lower(agency_name).contains("national science foundation")
        | agency_code.startswith("NSF")
        | cfda_numbers.startswith("47.")
        | cfda_numbers.contains(",47.")
    )


def period_active(period_end: Column, as_of: dt.date) -> Column:
    """NULL end dates stay NULL."""
    return period_end >= F.lit(as_of)


def opportunity_active(record_type: Column) -> Column:
    kind = F.lower(F.coalesce(record_type, F.lit("")))
    return kind.contains("synopsis") | kind.contains("forecast")


def termination_active(reinstated: Column, terminated: Column) -> Column:
    """Reinstated, or explicitly not terminated; texts in any case."""
    back = F.coalesce(F.lower(reinstated.cast("string")), F.lit("false")) == "true"
    kept = F.coalesce(F.lower(terminated.cast("string")), F.lit("true")) == "false"
    return back | kept


def outlay_status(outlayed: Column) -> Column:
    return F.when(outlayed.isNull(), "not_yet_reported").otherwise("reported")


def period_status(start: Column, end: Column, cfg: StudyConfig) -> Column:
    today = F.lit(cfg.as_of)
    return (
        F.when(end.isNull(), "unknown")
        .when(start > today, "not_yet_started")
        .when(end >= today, "in_progress")
        .when(end < F.add_months(today, -cfg.ended_lookback_months), "ended_over_1yr")
        .otherwise("ended_under_1yr")
    )


def in_reporting_lag(action_date: Column, cfg: StudyConfig) -> Column:
    return action_date >= F.date_sub(F.lit(cfg.as_of), cfg.reporting_lag_days)


def award_status(termination_id: Column, reinstated: Column) -> Column:
    return (
        F.when(termination_id.isNull(), "Active")
        .when(reinstated, "Reinstated")
        .otherwise("Terminated")
    )


def status_rank(status: Column) -> Column:
    """Sort position: terminated, reinstated, active."""
    return F.when(status == "Terminated", 1).when(status == "Reinstated", 2).otherwise(3)


def live_on(start: Column, end: Column, day: dt.date) -> Column:
    return F.lit(day).between(start, end)


def currently_open(is_active: Column, close: Column, post: Column, cfg: StudyConfig) -> Column:
    """Open: active and closing later, or undated and posted recently."""
    today = F.lit(cfg.as_of)
    recent = post >= F.add_months(today, -cfg.open_lookback_months)
    return is_active & ((close >= today) | (close.isNull() & recent))


def within(day: Column, window: tuple[dt.date, dt.date]) -> Column:
    """Half-open date range."""
    return (day >= F.lit(window[0])) & (day < F.lit(window[1]))


def fiscal_year(day: Column) -> Column:
    return F.year(day) + F.when(F.month(day) >= 10, 1).otherwise(0)


def fiscal_years_of(window: tuple[dt.date, dt.date]) -> tuple[int, int]:
    """First and last fiscal year that a half-open window touches."""
    return fiscal_year_of(window[0]), fiscal_year_of(window[1] - dt.timedelta(days=1))


def month_of(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "MM")

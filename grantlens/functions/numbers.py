"""Rounding and division that give the same digits in every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, places: int) -> Column:
    """Round half away from zero on a decimal copy of the value."""
    return F.round(value.cast("decimal(38,10)"), places).cast("double")


def money(value: Column) -> Column:
    """Round an amount to cents, which hides the order a sum was added up in."""
    return round_half_up(value, 2)


def millions(value: Column) -> Column:
    return money(value) / F.lit(1e6)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL when whole is zero or NULL."""
    return F.try_divide(F.lit(100.0) * part, whole)


def percent_rounded(part: Column, whole: Column, places: int) -> Column:
    return round_half_up(percent(part, whole), places)


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def count_where(condition: Column) -> Column:
    """Number of rows where the condition is true; 0 for none."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def sum_where(condition: Column, value: Column) -> Column:
    """Sum over the rows where the condition is true; NULL for none."""
    return F.sum(F.when(condition, value))


def row_count() -> Column:
    return F.count(F.lit(1))

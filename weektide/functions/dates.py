"""Date parsing, calendar buckets and calendar features."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from weektide.functions.numeric import rnd

# Accepted spellings of a date, month first.
DATE_PATTERNS = ["M/d/yyyy", "M-d-yyyy", "yyyy-M-d"]

_WEEKDAYS = ["MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN"]

# Mean number of weeks in a year, used by the weekly cycle.
WEEKS_PER_YEAR = 52.1775


def parse_mixed_date(col: Column) -> Column:
    """DATE from text in any accepted spelling; NULL where none fits."""
    return F.coalesce(
        *[F.try_to_timestamp(col, F.lit(p)) for p in DATE_PATTERNS]
    ).cast("date")


def year_month(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def month_name(month: Column) -> Column:
    """1 -> ``Jan``."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMM")


class Frequency:
    """A calendar grid: ``D``, ``W-SUN`` … ``W-MON``, ``ME``, ``QE`` or ``YE``.

    Buckets are labelled by their last day.
    """

    def __init__(self, alias: str):
        self.alias = alias
        unit, _, weekday = alias.partition("-")
        if unit == "W":
            weekday = weekday or "SUN"
            if weekday not in _WEEKDAYS:
                raise ValueError(f"unknown weekday in frequency {alias!r}")
            # Days to move so that the bucket starts on a Monday.
            self._shift = (_WEEKDAYS.index(weekday) + 1) % 7
            self._step, self._trunc, self._months = "INTERVAL 7 DAYS", "week", 0
        elif alias == "D":
            self._shift, self._trunc, self._months = 0, None, 0
            self._step = "INTERVAL 1 DAY"
        elif alias in ("ME", "QE", "YE"):
            self._shift = 0
            self._trunc, self._months = {
                "ME": ("month", 1), "QE": ("quarter", 3), "YE": ("year", 12),
            }[alias]
            self._step = f"INTERVAL {self._months} MONTHS"
        else:
            raise ValueError(f"unknown frequency {alias!r}")

    def start(self, day: Column) -> Column:
        """First day of the bucket holding ``day``."""
        if self._trunc is None:
            return day
        if self._trunc == "week":
            return F.date_add(F.trunc(F.date_sub(day, self._shift), "week"), self._shift)
        return F.trunc(day, self._trunc)

    def end(self, start: Column) -> Column:
        """Label of the bucket starting on ``start``."""
        if self._trunc is None:
            return start
        if self._trunc == "week":
            return F.date_add(start, 6)
        return F.date_sub(F.add_months(start, self._months), 1)

    def starts_between(self, first: Column, last: Column) -> Column:
        """Array of bucket starts from ``first`` up to ``last``."""
        return F.sequence(first, last, F.expr(self._step))


def calendar_columns(day: Column) -> dict[str, Column]:
    """The calendar predictors of a week ending on ``day``.

    ``is_q4`` marks September to December, the high season.
    """
    # The result is rounded, so the angle keeps full precision.
    def cycle(fn, value: Column, period: float) -> Column:
        return rnd(fn(F.lit(2 * math.pi) * value / F.lit(period)), 4)

    week, month = F.weekofyear(day), F.month(day)
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": month,
        "week_of_year": week,
        "is_q4": F.when(month >= 9, 1).otherwise(0),
        "sin_week": cycle(F.sin, week, WEEKS_PER_YEAR),
        "cos_week": cycle(F.cos, week, WEEKS_PER_YEAR),
        "sin_month": cycle(F.sin, month, 12.0),
        "cos_month": cycle(F.cos, month, 12.0),
    }

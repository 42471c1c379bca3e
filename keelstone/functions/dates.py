"""Dates held as day numbers, and the parts of a date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Day 0 of the extract's date numbers and the calendar range
# (years 1 to 9999) a day number may reach.
DAY_ZERO = dt.date(1960, 1, 1)
FIRST_DAY = (dt.date.min - DAY_ZERO).days
LAST_DAY = (dt.date.max - DAY_ZERO).days

# Weekday names, in the order of `dayofweek` (1 is Sunday).
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def day_number_to_date(days: Column) -> Column:
    """Day number to date; a fraction is floored.

    NULL, NaN, zero and numbers outside the calendar give NULL. The range test
    also rejects NaN, which compares greater than every number.
    """
    usable = days.between(FIRST_DAY, LAST_DAY) & (days != 0)
    return F.when(usable, F.date_add(F.lit(DAY_ZERO), F.floor(days).cast("int")))


def day_number_to_iso(days: Column) -> Column:
    """Day number to 'YYYY-MM-DD' text."""
    return day_number_to_date(days).cast("string")


def date_to_day_number(date: Column) -> Column:
    """Inverse of `day_number_to_date`, as a double."""
    return F.datediff(date, F.lit(DAY_ZERO)).cast("double")


def weekday_name(date: Column) -> Column:
    """Full English name; a constant lookup, without a trip through timestamps."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.dayofweek(date))


def date_parts(date: Column, prefix: str) -> list[Column]:
    """Year, month, day and full English weekday name of a date."""
    return [
        F.year(date).alias(f"{prefix}Year"),
        F.month(date).alias(f"{prefix}Month"),
        F.dayofmonth(date).alias(f"{prefix}Day"),
        weekday_name(date).alias(f"{prefix}_DayOfWeek"),
    ]

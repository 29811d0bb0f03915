"""Calendar expressions on a date column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months of each meteorological season.
SEASONS = {
    "is_spring": (3, 4, 5),
    "is_summer": (6, 7, 8),
    "is_autumn": (9, 10, 11),
    "is_winter": (12, 1, 2),
}
DAYS_PER_YEAR = 365.25

STEPS = {
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAYS",
    "month": "INTERVAL 1 MONTH",
    "quarter": "INTERVAL 3 MONTHS",
}


def calendar_columns(date: Column) -> dict[str, Column]:
    """Year, month, day of year, ISO week, cyclic encodings and season flags."""
    month, doy = F.month(date), F.dayofyear(date)
    month_angle = month * (2 * math.pi) / 12
    doy_angle = doy * (2 * math.pi) / DAYS_PER_YEAR
    return {
        "year": F.year(date),
        "month": month,
        "day_of_year": doy,
        "week_of_year": F.weekofyear(date),
        "month_sin": F.sin(month_angle),
        "month_cos": F.cos(month_angle),
        "doy_sin": F.sin(doy_angle),
        "doy_cos": F.cos(doy_angle),
        **{name: month.isin(*months).cast("int") for name, months in SEASONS.items()},
    }


def period_start(date: Column, frequency: str) -> Column:
    """First day of the period holding ``date`` (weeks start on Monday)."""
    if frequency not in STEPS:
        raise ValueError(f"unknown frequency: {frequency}")
    return date if frequency == "day" else F.trunc(date, frequency)


def step(frequency: str) -> Column:
    return F.expr(STEPS[frequency])


def date_of_day(year: Column, doy: Column) -> Column:
    """Date of a day-of-year; NULL when that year has no such day."""
    found = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), doy - 1)
    return F.when(F.year(found) == year, found)


def lenient_date(text: Column) -> Column:
    """Date of a date or timestamp text, NULL when it is neither."""
    return F.try_to_timestamp(text).cast("date")

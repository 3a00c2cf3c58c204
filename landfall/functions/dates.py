"""Day-number dates and calendar parts."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = dt.date(1960, 1, 1)
# Day numbers that land inside the years 1..9999; anything else has no date.
FIRST_DAY = (dt.date.min - EPOCH).days
LAST_DAY = (dt.date.max - EPOCH).days


def day_number_to_date(col: str) -> Column:
    """Date that lies ``col`` days after 1960-01-01.

    The fraction is cut off. 0, null, NaN and numbers outside the calendar have
    no date: 0 marks a missing day in the source.
    """
    number = F.col(col)
    days = number.try_cast("int")
    return F.when(
        (number != 0) & days.between(FIRST_DAY, LAST_DAY), F.date_add(F.lit(EPOCH), days)
    )


def calendar_parts(col: str) -> dict[str, Column]:
    """day, ISO week, month, year and weekday (1 = Sunday) of a date column."""
    date = F.col(col)
    return {
        "day": F.dayofmonth(date),
        "week": F.weekofyear(date),
        "month": F.month(date),
        "year": F.year(date),
        "weekday": F.dayofweek(date),
    }


def within(col: str, start: dt.date, end: dt.date) -> Column:
    """Both ends included."""
    return F.col(col).between(F.lit(start), F.lit(end))


def overlapping_partitions(ranges: DataFrame, start: dt.date, end: dt.date) -> Column:
    """Predicate on the fact's partition columns: those whose dates overlap start to end.

    ``ranges`` has one row per month, with its first and last date.
    """
    overlaps = (F.col("first_date") <= F.lit(end)) & (F.col("last_date") >= F.lit(start))
    months = ranges.where(overlaps).select("arrival_year", "arrival_month").collect()
    year, month = F.col("arrival_year"), F.col("arrival_month")
    return reduce(
        lambda a, b: a | b,
        [year.eqNullSafe(F.lit(m[0])) & month.eqNullSafe(F.lit(m[1])) for m in months],
        F.lit(False),
    )


def stay_days(arrival: str = "arrival_date", departure: str = "departure_date") -> Column:
    return F.datediff(F.col(departure), F.col(arrival))

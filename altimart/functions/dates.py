"""Date parts and differences, free of the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_of_date(as_of: Column | dt.date | str | None) -> Column:
    """The reference day of ages and idle times; today unless given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def minute_boundaries(start: Column, end: Column) -> Column:
    """How often the wall clock's minute hand moved between two local timestamps."""

    def clock(t: Column) -> Column:
        return F.hour(t) * 60 + F.minute(t)

    days = F.date_diff(end.cast("date"), start.cast("date")).cast("long")
    return days * 1440 + clock(end) - clock(start)


def year_boundaries(start: Column, end: Column) -> Column:
    return F.year(end) - F.year(start)


def days_between(start: Column, end: Column) -> Column:
    return F.date_diff(end, start)


def date_spine(bounds: DataFrame, name: str = "full_date") -> DataFrame:
    """One row per day from column ``first`` up to, not including, column ``end``."""
    end = F.date_sub(F.col("end").cast("date"), 1)
    days = F.sequence(F.col("first").cast("date"), end, F.expr("interval 1 day"))
    return bounds.where(F.col("first") <= end).select(F.explode(days).alias(name))

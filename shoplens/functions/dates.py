"""Calendar arithmetic on dates and zoneless timestamps.

Differences count calendar boundaries crossed, not elapsed time: 23:59 to 00:01 is one day and
31 January to 1 February is one month. Nothing here depends on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def as_of_date(as_of: dt.date | None) -> Column:
    """The day a report is made for; today where none is given."""
    return F.current_date() if as_of is None else F.lit(as_of)


def month_start(c: Column) -> Column:
    return F.trunc(c.cast("date"), "month")


def week_start(c: Column) -> Column:
    """Monday of the week."""
    return F.trunc(c.cast("date"), "week")


def quarter_start(c: Column) -> Column:
    return F.trunc(c.cast("date"), "quarter")


def day_of_week(c: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(c.cast("date")) - 1


def day_boundaries(start: Column, end: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date"))


def month_boundaries(start: Column, end: Column) -> Column:
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)

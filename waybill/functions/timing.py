"""Calendar arithmetic on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(start: Column, end: Column) -> Column:
    """Calendar-day boundaries crossed from `start` to `end`; negative when `end` is earlier.

    23:00 to 01:00 on the next date is one day, although only two hours have passed.
    """
    return F.datediff(end, start).cast("bigint")


def month_of(ts: Column) -> Column:
    """First day of the calendar month, as a date."""
    return F.trunc(F.to_date(ts), "MM")


def days_before(ts: Column, days: int) -> Column:
    """The same time of day, `days` days earlier."""
    return ts - F.make_dt_interval(F.lit(int(days)))

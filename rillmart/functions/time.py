"""Date, hour and age columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ms_date(ts: Column) -> Column:
    """Epoch milliseconds -> ``yyyy-MM-dd`` in the session time zone."""
    return F.date_format(F.timestamp_millis(ts), "yyyy-MM-dd")


def ms_hour(ts: Column) -> Column:
    """Epoch milliseconds -> two-digit hour in the session time zone."""
    return F.date_format(F.timestamp_millis(ts), "HH")


def create_date(create_time: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> its date part."""
    return F.split_part(create_time, F.lit(" "), F.lit(1))


def create_hour(create_time: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> its hour part."""
    return F.split_part(F.split_part(create_time, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))


def age_years(birthday: Column, as_of: str | dt.date | None = None) -> Column:
    """Whole years between a ``yyyy-MM-dd`` birthday and ``as_of`` (default: today).

    Compares month and day, so a Feb 29 birthday is not reached on Feb 28.
    ``months_between`` treats two month ends as a full month and would be wrong here.
    """
    born = F.to_date(birthday)
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    month_day = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    return F.year(day) - F.year(born) - (month_day(day) < month_day(born)).cast("int")


def prev_day(day: Column) -> Column:
    """The day before a ``yyyy-MM-dd`` text, as text."""
    return F.date_sub(F.to_date(day), 1).cast("string")


def next_day(day: Column) -> Column:
    return F.date_add(F.to_date(day), 1).cast("string")

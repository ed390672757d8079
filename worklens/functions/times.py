"""Instants, calendar days and exact durations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from worklens.schemas import TIME_ZONE

DAY_SECONDS = 86_400


def column(value: Column | str | date) -> Column:
    """A column name, a column or a plain date as a Column."""
    if isinstance(value, Column):
        return value
    return F.lit(value) if isinstance(value, date) else F.col(value)


def instant(text: Column | str) -> Column:
    """ISO text with offset to an instant; malformed text is NULL even under ANSI mode."""
    return F.try_to_timestamp(column(text))


def day(text: Column | str) -> Column:
    """ISO text to its literal calendar day; malformed text is NULL."""
    return F.try_to_date(column(text))


def local(moment: Column | str, zone: str = TIME_ZONE) -> Column:
    """Wall clock of an instant in the portfolio's time zone."""
    return F.from_utc_timestamp(moment, zone)


def end_of_day(ref: Column | date, zone: str = TIME_ZONE) -> Column:
    """Instant of the last second of a local day."""
    wall = column(ref).cast("timestamp") + F.expr("INTERVAL 86399 SECONDS")
    return F.to_utc_timestamp(wall, zone)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def hundredths(seconds: Column) -> Column:
    """Seconds as hundredths of a day, half away from zero, in whole numbers (bigint)."""
    size = F.floor((F.abs(seconds) * 100 + DAY_SECONDS // 2) / DAY_SECONDS)
    return F.when(seconds < 0, -size).otherwise(size)


def days_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed days with two decimals."""
    return hundredths(seconds_between(start, end)) / F.lit(100.0)


def days_late(done: Column | str, deadline: Column | str) -> Column:
    """Whole days past the deadline, never negative; no deadline counts as zero."""
    return F.greatest(F.datediff(done, deadline), F.lit(0))


def iso_weekday(value: Column | str) -> Column:
    return F.weekday(value) + 1


def next_business_day(value: Column | str) -> Column:
    """The day itself, or the Monday after a weekend."""
    value = column(value)
    weekday = iso_weekday(value)
    return F.when(weekday > 5, F.date_add(value, 8 - weekday)).otherwise(value)

"""CAL1-CAL3 as Column expressions: run date, first of month, month-closing gate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = {"Monday": "MON", "Tuesday": "TUE", "Wednesday": "WED", "Thursday": "THU",
            "Friday": "FRI", "Saturday": "SAT", "Sunday": "SUN"}


def run_date(day: Column, weekday: str = "Saturday") -> Column:
    """Latest ``weekday`` on or before ``day`` (a Saturday maps to itself)."""
    return F.next_day(F.date_sub(day, 7), WEEKDAYS[weekday])


def first_of_month(day: Column) -> Column:
    return F.trunc(day, "MM")


def archive_int(day: Column) -> Column:
    """Date -> YYYYMMDD integer partition value."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def archive_date(archive: Column) -> Column:
    return F.to_date(archive.cast("string"), "yyyyMMdd")


def month_closing(day: Column) -> Column:
    """True when the next run (7 days later) falls in another month: the monthly table is due."""
    return F.month(day) != F.month(F.date_add(day, 7))

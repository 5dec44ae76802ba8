"""Date functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def months_crossed(start: Column, end: Column) -> Column:
    """Month boundaries between two dates (31 Jan to 1 Feb is one)."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def years_crossed(start: Column, end: Column) -> Column:
    return F.year(end) - F.year(start)


def end_of_year(d: Column) -> Column:
    return F.make_date(F.year(d), F.lit(12), F.lit(31))


def nearest_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts + F.expr("interval 30 minutes"))


def nearest_day(ts: Column) -> Column:
    return F.date_trunc("day", ts + F.expr("interval 12 hours"))


def friday_on_or_before(d: Column) -> Column:
    """2000-01-07 was a Friday."""
    return F.date_sub(d, F.pmod(F.datediff(d, F.lit("2000-01-07").cast("date")), F.lit(7)))


def friday_before(d: Column) -> Column:
    return friday_on_or_before(F.date_sub(d, 1))


def parse_date(s: Column, *formats: str) -> Column:
    """First explicit format that fits; NULL if none does."""
    return F.coalesce(*[F.try_to_date(s, f) for f in formats])

"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_long(text: Column) -> Column:
    return text.try_cast("bigint")


def try_time(text: Column) -> Column:
    """ISO text to an instant; NULL when it is not a time."""
    return text.try_cast("timestamp")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole-second boundaries from ``start`` to ``end`` (both floored first)."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def month_start(time: Column) -> Column:
    return F.date_trunc("month", time).cast("timestamp_ntz")


def day_of_week(day: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(day) - 1


def days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))

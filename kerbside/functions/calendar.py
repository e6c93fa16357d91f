"""Dates, months and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.fixed_values import MONTH_FORMAT


def to_day(ts: Column) -> Column:
    return F.to_date(ts)


def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def month_name(ts: Column) -> Column:
    """``yyyy-MM``, as used in file and partition names."""
    return F.date_format(ts, MONTH_FORMAT)


def duration(start: Column, end: Column) -> Column:
    """Day-time interval from ``start`` to ``end``; negative when they are swapped."""
    return end - start


def duration_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)

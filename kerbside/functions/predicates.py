"""Predicates, written so that Catalyst can push them to the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def on_day(ts: Column, day: str) -> Column:
    return F.to_date(ts) == F.lit(day).cast("date")


def between_days(ts: Column, first: str, last: str) -> Column:
    """Both ends included."""
    return F.to_date(ts).between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def is_one_of(col: Column, values: Iterable) -> Column:
    return col.isin(list(values))


def same_text(col: Column, pattern: str) -> Column:
    """Case-insensitive match; ``%`` and ``_`` act as wildcards."""
    return col.ilike(pattern)

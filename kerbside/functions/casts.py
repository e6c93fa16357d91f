"""Casts. ``strict`` raises on text that does not parse; otherwise such text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.fixed_values import NUMERIC


def _cast(col: Column, target: str, strict: bool) -> Column:
    return col.cast(target) if strict else col.try_cast(target)


def to_int(col: Column, strict: bool = True, fractional: bool = False) -> Column:
    """Whole number; a ``fractional`` input is rounded, halves away from zero."""
    return _cast(F.round(col) if fractional else col, "int", strict)


def to_numeric(col: Column, strict: bool = True) -> Column:
    """Exact decimal. A bare ``numeric`` would keep no digits after the point in Spark."""
    return _cast(col, NUMERIC, strict)


def to_text(col: Column) -> Column:
    return col.cast("string")


def parse_timestamp(col: Column, strict: bool = True, pattern: str | None = None) -> Column:
    if pattern is None:
        return _cast(col, "timestamp", strict)
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return parse(col, pattern if strict else F.lit(pattern))

"""Aggregate building blocks; all of them combine on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Floating amounts are summed in units of a hundredth of a cent.
UNITS = 10_000
# Larger amounts are added as they are: their units would not be exact in a double.
EXACT_BELOW = 1e11


def exact_sum(df: DataFrame, name: str) -> Column:
    """A sum that does not depend on the order of the rows.

    Decimals and whole numbers have that by nature. Floating amounts below ``EXACT_BELOW`` are split
    into whole units, whose double sum is exact as long as it stays below 2^53 units (9e11 in
    amounts), and what is left of finer values. The rest is zero for amounts of up to four decimals;
    for others it keeps the sum as close as a plain one, and so it is beyond that range, for larger
    amounts and for infinity. Both sums together cost less than half of a decimal sum.
    """
    if not _floating(df, name):
        return F.sum(name)
    value = F.col(name)
    units = F.when(F.abs(value) < EXACT_BELOW, F.rint(value * UNITS)).when(value.isNotNull(), 0.0)
    return F.sum(units) / UNITS + F.sum(value - units / UNITS)


def exact_avg(df: DataFrame, name: str) -> Column:
    """Average as exact sum over non-NULL count; NULL when there is none."""
    return F.try_divide(exact_sum(df, name).cast("double"), F.count(name))


def _floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.agg(F.count_distinct(column).alias(name))


def count_by(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))

"""Top rows and samples. A total order makes ties repeatable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.fixed_values import DEV_SAMPLE_ROWS


def top_rows(df: DataFrame, by: str, n: int = 1) -> DataFrame:
    """The ``n`` rows with the largest ``by``; NULL counts as smallest, ties follow the rest.

    Runs as a bounded per-task heap, not as a full sort.
    """
    ties = [F.col(c).asc_nulls_first() for c in df.columns if c != by]
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(n)


def dev_sample(df: DataFrame, on: bool = False, rows: int = DEV_SAMPLE_ROWS) -> DataFrame:
    """Any ``rows`` rows while developing. Off unless asked for, so results are whole."""
    return df.limit(rows) if on else df


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows in the order of all columns, as a frame that can be shown."""
    return df.orderBy(*df.columns).limit(rows)

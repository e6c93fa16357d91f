"""Database tables as sources. Partitioned reads keep the load on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column: str | None = None,
    bounds: tuple | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Read a table (or a parenthesised query with an alias).

    With ``column``, ``bounds`` and ``partitions`` each task reads one range of the column;
    without, one task reads everything, which suits small tables only.
    """
    return spark.read.jdbc(
        url, table, properties=properties or {}, **range_options(column, bounds, partitions)
    )


def range_options(column: str | None, bounds: tuple | None, partitions: int | None) -> dict:
    given = [v is not None for v in (column, bounds, partitions)]
    if not any(given):
        return {}
    if not all(given):
        raise ValueError("column, bounds and partitions go together")
    low, high = bounds
    return {
        "column": column, "lowerBound": low, "upperBound": high, "numPartitions": partitions,
    }


def month_predicates(column: str, months: list[str]) -> list[str]:
    """One WHERE clause per month, for a read with one task per month; months in any order."""
    return [
        f"{column} >= TIMESTAMP '{m}-01 00:00:00' AND {column} < TIMESTAMP '{_after(m)}-01 00:00:00'"
        for m in months
    ]


def _after(month: str) -> str:
    year, number = int(month[:4]), int(month[5:])
    return f"{year + number // 12:04d}-{number % 12 + 1:02d}"


def read_table_by_month(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    months: list[str],
    properties: dict[str, str] | None = None,
) -> DataFrame:
    return spark.read.jdbc(
        url, table, predicates=month_predicates(column, months), properties=properties or {}
    )

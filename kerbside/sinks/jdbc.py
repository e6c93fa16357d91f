"""Database tables as sinks; executors insert in batches, in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kerbside.fixed_values import JDBC_BATCH_ROWS


def writer_properties(
    properties: dict[str, str] | None = None,
    batch_rows: int = JDBC_BATCH_ROWS,
    connections: int = 8,
    truncate: bool = False,
) -> dict[str, str]:
    return {
        **(properties or {}),
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
        "truncate": str(truncate).lower(),
    }


def write_table(
    df: DataFrame, url: str, table: str, mode: str = "error", **options
) -> None:
    """``overwrite`` replaces the table, ``append`` adds to it, ``error`` refuses an existing one."""
    df.write.jdbc(url, table, mode=mode, properties=writer_properties(**options))


def create_empty(df: DataFrame, url: str, table: str, **options) -> None:
    write_table(df.limit(0), url, table, mode="overwrite", **options)


def replace_table(df: DataFrame, url: str, table: str, **options) -> None:
    """Recreate the table from the frame's columns, then load all rows in parallel batches."""
    create_empty(df, url, table, **options)
    write_table(df, url, table, mode="append", **options)

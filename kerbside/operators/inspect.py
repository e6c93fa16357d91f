"""Schemas as data and as DDL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def schema_rows(df: DataFrame) -> list[tuple[int, str, str, bool]]:
    """(position, column, type, nullable) of every column."""
    return [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)
    ]


def table_ddl(df: DataFrame, name: str) -> str:
    """The statement that makes a table of these columns; parts of its name are quoted where they must."""
    parts = [p if re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", p) else f"`{p.replace('`', '``')}`" for p in name.split(".")]
    return f"CREATE TABLE {'.'.join(parts)} ({df.schema.toDDL()})"

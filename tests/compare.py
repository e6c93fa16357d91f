"""Run a query and its SQL, and compare columns, rows and values."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_rows(data_dir: str, sql: str) -> tuple[list[str], list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(data_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    types = [str(c[1]) for c in result.description]
    return columns, types, result.fetchall()


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ")
    return "NULL" if v is None else str(v)


def canonical(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


SPARK_TYPES = {
    "VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def differences(df, data_dir: str, sql: str) -> list[str]:
    columns, types, expected = sql_rows(data_dir, sql)
    got = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(columns) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(columns)}")
        return problems
    want = {c: SPARK_TYPES.get(t, t) for c, t in zip(columns, types)}
    have = dict(df.dtypes)
    for c in columns:
        if want[c] != have[c]:
            problems.append(f"{c}: {have[c]} != {want[c]}")
    a, b = canonical(df.columns, got), canonical(columns, expected)
    if a != b:
        problems.append(
            f"rows {len(got)} vs {len(expected)}; only here {list((a - b).items())[:2]}; "
            f"only in SQL {list((b - a).items())[:2]}"
        )
    return problems

"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def first_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the first row of each key, in the order of all remaining columns.

    NULL is an ordinary key value. The total order makes the pick repeatable. Spark limits each
    key to one row *before* the shuffle (``WindowGroupLimit``), so a key holding a large share
    of the rows sends one row per map task, never its whole group. Name the most selective key
    first: it decides most comparisons of the sort.
    """
    taken = {k.lower() for k in keys}
    rest = [c for c in df.columns if c.lower() not in taken]
    partition = ", ".join(f"`{k}`" for k in keys)
    order = ", ".join(f"`{c}` ASC NULLS FIRST" for c in rest) or partition
    rank = f"row_number() OVER (PARTITION BY {partition} ORDER BY {order}) AS __rank"
    return df.selectExpr("*", rank).filter("__rank = 1").drop("__rank")

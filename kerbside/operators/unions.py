"""UNION ALL of feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common_columns(first: DataFrame, second: DataFrame) -> list[str]:
    """Columns both have, in the first one's order; names compare case-sensitively."""
    shared = set(second.columns)
    return [c for c in first.columns if c in shared]


def union_tagged(feeds: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union on the columns all feeds share, with the feed's name in column ``tag``."""
    first, *others = feeds.values()
    columns = reduce(lambda kept, df: common_columns(first.select(*kept), df), others, first.columns)
    tagged = [df.select(*columns, F.lit(name).alias(tag)) for name, df in feeds.items()]
    return reduce(DataFrame.unionByName, tagged)


def union_same_shape(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union of two frames with the same columns in the same order; anything else is refused.

    A union by position would pair up reordered columns without a word.
    """
    if first.columns != second.columns:
        raise ValueError(f"columns differ: {first.columns} and {second.columns}")
    return first.unionByName(second)

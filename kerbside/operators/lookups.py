"""Joins to dimensions, and checks against them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.session import MIB

BROADCAST_BYTES = 32 * MIB


def measured_bytes(df: DataFrame) -> int:
    """Rows times fixed-width columns, plus the actual length of every text value."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    width = 16 * len(df.columns)
    per_row = F.lit(width).cast("bigint")
    for name in texts:
        per_row = per_row + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    return df.agg(F.sum(per_row)).first()[0] or 0


@dataclass(frozen=True)
class Lookup:
    """A dimension and whether its measured size allows a broadcast.

    Above the bound no hint is given: Spark shuffles both sides and splits hot keys at run time.
    """

    frame: DataFrame
    small: bool

    @classmethod
    def measure(cls, frame: DataFrame, max_bytes: int | None = None) -> Lookup:
        bound = BROADCAST_BYTES if max_bytes is None else max_bytes
        return cls(frame, measured_bytes(frame) <= bound)

    def filter(self, condition: Column) -> Lookup:
        return Lookup(self.frame.filter(condition), self.small)

    def side(self, *cols: Column) -> DataFrame:
        side = self.frame.select(*cols) if cols else self.frame
        return F.broadcast(side) if self.small else side


def key_as(col: Column, target: T.DataType) -> Column:
    """The dimension key in the fact key's type; NULL (no match) where that loses anything.

    Casting the small side keeps the fact key bare, so its join stays on a primitive key.
    """
    cast = col.try_cast(target)
    return F.when(cast.cast(T.DecimalType(38, 9)) == col.try_cast(T.DecimalType(38, 9)), cast)


def join_role(
    facts: DataFrame, lookup: Lookup, fact_key: str, dim_key: str, take: dict[str, str]
) -> DataFrame:
    """Inner-join one role of a dimension; ``take`` maps its columns to output names."""
    fact_type = facts.schema[fact_key].dataType
    same_type = lookup.frame.schema[dim_key].dataType == fact_type
    key = F.col(dim_key) if same_type else key_as(F.col(dim_key), fact_type)
    side = lookup.side(
        key.alias("__role_key"), *[F.col(source).alias(name) for source, name in take.items()]
    )
    return facts.join(side, facts[fact_key] == side["__role_key"], "inner").drop("__role_key")


def orphan_keys(
    child: DataFrame, child_key: str, parent: Lookup, parent_key: str
) -> DataFrame:
    """Child keys without a parent, with their row counts; a NULL key is not an orphan.

    Keys are counted first, so the anti-join sees each key once whatever its share of the rows.
    """
    counted = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("child_key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parents = parent.side(
        key_as(F.col(parent_key), child.schema[child_key].dataType).alias("parent_key")
    )
    return counted.join(parents, F.col("child_key") == F.col("parent_key"), "left_anti")

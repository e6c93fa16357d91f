"""Helpers the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it again.

    Cuts the lineage in a way that outlives executors; what is computed once is not repeated.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def whole_rows(df: DataFrame) -> Column:
    """All columns as one struct: helper columns beside it cannot clash with theirs."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_key(text: Column) -> Column:
    """Tells apart rows that share an id; rows equal in both are one document."""
    return F.xxhash64(text)

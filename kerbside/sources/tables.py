"""Parquet trees, named tables, external tables, seeds and local rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.fixed_values import ZONE_SEED_OVERRIDES, ZONE_SEED_TABLE
from kerbside.sources.csv import read_csv_override


def read_tree(
    spark: SparkSession, uri: str, hadoop_options: dict[str, str] | None = None
) -> DataFrame:
    """A Parquet directory at any Hadoop URI; ``fs.*`` options apply to this read only."""
    return spark.read.options(**(hadoop_options or {})).parquet(uri)


def read_year(spark: SparkSession, root: str, service: str, year: int) -> DataFrame:
    """One service and year of a tree laid out by service, year and month.

    The filter is on partition columns, so no other directory is read.
    """
    tree = read_tree(spark, root)
    return tree.filter((F.col("service_type") == service) & (F.col("year") == year))


def read_month(spark: SparkSession, root: str, month: str) -> DataFrame:
    """One month (``yyyy-MM``) of a table partitioned by ``file_month``; other months stay unread."""
    return read_tree(spark, root).filter(F.col("file_month") == month)


@dataclass(frozen=True)
class Sources:
    """Named inputs: a path (ends up as a Parquet scan) or a catalog table per name."""

    spark: SparkSession
    paths: dict[str, str]
    database: str | None = None

    def table(self, name: str) -> DataFrame:
        if name in self.paths:
            return read_tree(self.spark, self.paths[name])
        return self.spark.table(f"{self.database}.{name}" if self.database else name)


def register_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Put existing Parquet files into the catalog without copying them."""
    return spark.catalog.createTable(name, path=path, source="parquet")


def load_seed(
    spark: SparkSession,
    csv_path: str,
    table: str = ZONE_SEED_TABLE,
    overrides: dict[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Load a small reference CSV into a table, with the named column types fixed."""
    seed = read_csv_override(spark, csv_path, overrides or ZONE_SEED_OVERRIDES)
    writer = seed.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return spark.table(table)


def local_rows(spark: SparkSession, pandas_frame) -> DataFrame:
    """A pandas frame as a DataFrame; meant for rows that fit the driver by nature."""
    return spark.createDataFrame(pandas_frame)

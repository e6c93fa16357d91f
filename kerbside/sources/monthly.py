"""Month-templated file names."""

from __future__ import annotations

import posixpath
import re
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.fixed_values import LAKE_FILE_TEMPLATE, RAW_FILE_TEMPLATE
from kerbside.sources.csv import read_csv

MONTH_PARTITIONS = ["year", "month"]


def month_range(first: str, last: str) -> list[str]:
    """Months from ``first`` to ``last`` (``yyyy-MM``), both included."""
    def ordinal(month: str) -> int:
        day = date.fromisoformat(f"{month}-01")
        return day.year * 12 + day.month - 1

    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(ordinal(first), ordinal(last) + 1)]


def month_path(template: str, root: str, service: str, month: str) -> str:
    """Fill a path template; refuse results Spark would hide or that kept a placeholder."""
    path = template.format(root=root, service=service, month=month, year=month[:4])
    name = posixpath.basename(path)
    if not name or name[0] in "_." or "{" in path or "}" in path:
        raise ValueError(f"not a usable file path: {path}")
    return path


def month_paths(
    root: str, service: str, months: list[str], template: str = RAW_FILE_TEMPLATE
) -> list[str]:
    return [month_path(template, root, service, m) for m in months]


def read_months(
    spark: SparkSession,
    root: str,
    service: str,
    months: list[str],
    schema: T.StructType | str,
    template: str = RAW_FILE_TEMPLATE,
    strict: bool = True,
) -> DataFrame:
    """All months in one scan, with ``file_month`` taken from each row's file path."""
    paths = month_paths(root, service, months, template)
    return read_csv(spark, paths, schema, strict, also={"file_month": file_month(template)})


def read_month_files(
    spark: SparkSession, root: str, service: str, months: list[str],
    template: str = LAKE_FILE_TEMPLATE,
) -> DataFrame:
    """Month-named Parquet in plain folders by service and year, all months in one scan.

    Only the files of the given months are opened; ``file_month`` comes from each row's file path.
    """
    scan = spark.read.parquet(*month_paths(root, service, months, template))
    return scan.withColumn("file_month", file_month(template))


def file_month(template: str = RAW_FILE_TEMPLATE) -> Column:
    """The month at the template's place in the path of the file a row was read from."""
    part = next(p for p in reversed(template.split("/")) if "{month}" in p)
    pattern = re.escape(part)
    for placeholder, text in (
        ("month", r"(\d{4}-\d{2})"), ("year", r"\d{4}"), ("service", "[^/]*"),
    ):
        pattern = pattern.replace(re.escape("{%s}" % placeholder), text)
    return F.regexp_extract(F.col("_metadata.file_path"), f"/{pattern}(/|$)", 1)


def month_partition(month: str) -> str:
    """Where the rows of a file of that month (``yyyy-MM``) land."""
    return f"year={int(month[:4])}/month={int(month[5:])}"


def with_month_partitions(df: DataFrame) -> DataFrame:
    """``year`` and ``month`` of the file a row came from, in place of ``file_month``."""
    return df.withColumns({
        "year": F.substring("file_month", 1, 4).cast("int"),
        "month": F.substring("file_month", 6, 2).cast("int"),
    }).drop("file_month")

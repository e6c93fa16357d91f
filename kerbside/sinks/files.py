"""Parquet and CSV output."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.fixed_values import DEFAULT_FILES, LAKE_FILE_TEMPLATE
from kerbside.operators.quality import observed_rows
from kerbside.sources.csv import (
    add_row_index, read_csv, read_csv_inferred, read_csv_override, read_csv_strings,
)
from kerbside.sources.monthly import month_path


def write_repartitioned(df: DataFrame, path: str, files: int = DEFAULT_FILES) -> None:
    """Even pieces in ``files`` files; fails if the path exists."""
    df.repartition(files).write.parquet(path)


def write_single_file(df: DataFrame, path: str) -> None:
    """One file, always, replacing what was there; for reports.

    The result is computed in parallel, and one task writes it down: the caller asks for one file,
    and for a large table should ask for several (``write_repartitioned``).
    """
    df.repartition(1).write.mode("overwrite").parquet(path)


def write_if_absent(df: DataFrame, path: str) -> None:
    """Write unless a finished result is there; what a failed write left is replaced."""
    if not path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder, making the folders above its new place."""
    places = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    system = places[0].getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(places[1].getParent())
    if not system.rename(*places):
        raise OSError(f"cannot rename {source} to {target}")


def remove_path(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV with timestamps to the second, as the trip files have them."""
    seconds = "yyyy-MM-dd HH:mm:ss"
    (
        df.write.option("header", True)
        .option("timestampFormat", seconds)
        .option("timestampNTZFormat", seconds)
        .csv(path)
    )


def index_csv(spark: SparkSession, source: str, path: str, index: str = "row_index") -> None:
    """Copy a CSV with a leading row number counted from 0; values are copied as text."""
    write_csv(add_row_index(read_csv_strings(spark, source), index), path)


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    path: str,
    schema: str | None = None,
    overrides: dict[str, str] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Convert one CSV; other extensions are refused.

    A value that does not parse fails the job, unless ``strict`` is off and it becomes NULL.
    """
    if not source.endswith(".csv"):
        raise ValueError(f"not a CSV file: {source}")
    if schema is not None:
        frame = read_csv(spark, source, schema, strict)
    elif overrides:
        frame = read_csv_override(spark, source, overrides, strict)
    else:
        frame = read_csv_inferred(spark, source)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def write_by_month(
    df: DataFrame, path: str, partitions: list[str], mode: str = "errorifexists"
) -> int:
    """Lay rows out by partition columns; returns the rows written.

    With ``overwrite``, only the partitions that ``df`` holds are replaced. The rebalance gathers
    each partition's rows into few files, and splits a partition that holds an outsized share of
    the rows over several tasks.
    """
    # Counted in the writing stage itself, where a repeated task is counted once.
    counted, counter = observed_rows(df.hint("rebalance", *partitions))
    (
        counted.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
    return counter.get["rows"]


def write_month_files(
    df: DataFrame, root: str, service: str, month: str = "file_month",
    template: str = LAKE_FILE_TEMPLATE,
) -> list[str]:
    """Lay a service's rows out as one Parquet path a month, named by ``template``; returns the months.

    All months are written by one job, an outsized one by several tasks, into a folder that readers
    pass over. Each month's files then take their place by a rename, in the stead of what was there,
    so a reader finds a month as it was or as it is. Other months and services stay untouched; a row
    without a month is an error, before anything is replaced. The month's column goes into the name.
    """
    spark = df.sparkSession
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    named = F.coalesce(F.col(month), F.raise_error(F.lit("a row has no month")).cast("string"))
    try:
        (
            df.withColumn(month, named).hint("rebalance", month)
            .write.partitionBy(month).parquet(f"{staging}/new")
        )
        # A name a calendar month.
        folders = _folders(spark, f"{staging}/new", month)
        for name in folders:
            target = month_path(template, root, service, name)
            if path_exists(spark, target):
                rename_path(spark, target, f"{staging}/old/{name}")
            rename_path(spark, f"{staging}/new/{month}={name}", target)
    finally:
        remove_path(spark, staging)
    return folders


def _folders(spark: SparkSession, path: str, column: str) -> list[str]:
    location = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*")
    found = location.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(location)
    return sorted(s.getPath().getName().partition("=")[2] for s in found or ())


def with_year_month(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts)})


def is_misplaced(ts: str) -> Column:
    """Whether a timestamp disagrees with the ``year`` and ``month`` its row is stored under."""
    return ~(F.col("year").eqNullSafe(F.year(ts)) & F.col("month").eqNullSafe(F.month(ts)))


def misplaced_rows(df: DataFrame, ts: str) -> DataFrame:
    return df.filter(is_misplaced(ts))

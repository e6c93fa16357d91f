"""Views and tables in the session catalog."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def table_name(spark: SparkSession, name: str) -> str:
    """The name of a table of the catalog, which no temporary view can take."""
    database, _, own = name.rpartition(".")
    if not database and any(t.isTemporary for t in spark.catalog.listTables(pattern=own)):
        raise ValueError(f"{name} is a temporary view; a table of that name could not be read by it")
    return f"spark_catalog.`{database or spark.catalog.currentDatabase()}`.`{own}`"


def as_table(
    df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite"
) -> DataFrame:
    """Save as a table; ``mode`` may also be ``append`` or ``error``.

    ``overwrite`` rebuilds the table (see ``rebuild_table``); ``append`` adds to a table where it lies.
    """
    spark = df.sparkSession
    full = table_name(spark, name)
    if mode == "overwrite":
        return rebuild_table(df, name, path)
    writer = df.write.mode(mode).format("parquet")
    if path is not None and not spark.catalog.tableExists(full):
        writer = writer.option("path", path)
    writer.saveAsTable(full)
    return spark.table(full)


def rebuild_table(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Replace a table's rows, or make the table, by a switch at the end.

    The rows are written to a folder of their own below ``root`` (the warehouse by default). Only then
    does the catalog's entry move there, in one step, so a build that dies leaves the table as it
    was. With other columns than before the entry is made anew instead, which is two steps of the
    catalog; no file is touched by them. The version before stays, for those who still read it;
    older ones and what failed builds left are deleted.
    """
    spark = df.sparkSession
    full = table_name(spark, name)
    if root is None:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{full.split('.', 1)[1]}"
        root = root.replace("`", "") + ".versions"
    place = f"{root}/version={uuid.uuid4().hex}"
    df.write.parquet(place)
    before = None
    if spark.catalog.tableExists(full):
        before = _location(spark, full)
        stored = spark.read.parquet(place).schema
        if spark.table(full).schema == stored:
            escaped = place.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{escaped}'")
        else:
            spark.sql(f"DROP TABLE {full}")
            _enter(spark, full, place)
    else:
        _enter(spark, full, place)
    spark.catalog.refreshTable(full)
    _remove_versions(spark, root, [_location(spark, full), before])
    return spark.table(full)


def _enter(spark: SparkSession, full: str, place: str) -> None:
    spark.catalog.createTable(full, path=place, source="parquet")


def _location(spark: SparkSession, full: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = 'Location'")
    return described.first().data_type


def _remove_versions(spark: SparkSession, root: str, kept: list[str | None]) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/version=*")
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    names = {k.rstrip("/").rpartition("/")[2] for k in kept if k}
    for status in system.globStatus(location) or ():
        if status.getPath().getName() not in names:
            system.delete(status.getPath(), True)


def empty_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace a table by an empty one with the frame's columns."""
    return as_table(df.limit(0), name, path)


def replace_then_append(
    pieces: Iterable[DataFrame], name: str, path: str | None = None
) -> DataFrame:
    """Start the table anew from the first piece's columns, then append every piece."""
    table = None
    for piece in pieces:
        if table is None:
            empty_table(piece, name, path)
        table = as_table(piece, name, path, mode="append")
    if table is None:
        raise ValueError("nothing to load")
    return table.sparkSession.table(table_name(table.sparkSession, name))

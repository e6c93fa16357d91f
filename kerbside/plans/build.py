"""Whole runs: landing months of files, and building every model from named sources."""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kerbside.fixed_values import RAW_FILE_TEMPLATE
from kerbside.operators.quality import enforce
from kerbside.plans.checks import check_report
from kerbside.plans.marts import dim_zones, fact_fhv_trips, fact_trips
from kerbside.plans.staging import stage_fhv, stage_green, stage_yellow
from kerbside.session import scratch_path
from kerbside.sinks.manifest import land
from kerbside.sinks.tables import as_view, rebuild_table
from kerbside.sources.monthly import (
    MONTH_PARTITIONS, month_partition, read_months, with_month_partitions,
)
from kerbside.sources.tables import Sources

SAMPLE_PREFIX = "sample_"


def ingest_months(
    spark: SparkSession,
    service: str,
    months: list[str],
    root: str,
    schema: T.StructType | str,
    dest: str,
    template: str = RAW_FILE_TEMPLATE,
    strict: bool = True,
) -> int:
    """Land the given months' files as Parquet by year and month; returns the rows written.

    A value that does not parse fails the run, unless ``strict`` is off and it becomes NULL.

    A month replaces what was landed for it before, so any range can be run again. The partition
    is the file's month: a stray row with another date stays with its file, and cannot displace
    the month its date points to. A month whose file has no row any more is emptied. The whole range
    becomes visible in one step, to ``read_landed``; a run that dies has changed nothing.
    """
    if not months:
        return 0
    landed = with_month_partitions(
        read_months(spark, root, service, months, schema, template, strict)
    )
    return land(landed, dest, MONTH_PARTITIONS, replaced=[month_partition(m) for m in months])


@dataclass(frozen=True)
class LoadProgress:
    """One landed part of a range of months: its rows and time, and how much of the range is done."""

    months: tuple[str, ...]
    rows: int
    seconds: float
    months_done: int
    percent_done: float


def ingest_in_parts(
    spark: SparkSession,
    service: str,
    parts: list[list[str]],
    root: str,
    schema: T.StructType | str,
    dest: str,
    template: str = RAW_FILE_TEMPLATE,
    strict: bool = True,
) -> Iterator[LoadProgress]:
    """Land a long range part by part (years, say), and report on each as soon as it is visible.

    Nothing of a part lands before its turn is asked for. Rows are counted while they are written. A
    part that fails leaves those before it landed; the range can be run again from any part on.
    """
    total, done = sum(map(len, parts)), 0
    for part in parts:
        start = time.monotonic()
        rows = ingest_months(spark, service, part, root, schema, dest, template, strict)
        done += len(part)
        yield LoadProgress(
            tuple(part), rows, time.monotonic() - start, done, 100.0 * done / total if total else 100.0
        )


@dataclass(frozen=True)
class Models:
    stg_green_tripdata: DataFrame
    stg_yellow_tripdata: DataFrame
    stg_fhv_tripdata: DataFrame
    dim_zones: DataFrame
    fact_trips: DataFrame
    fact_fhv_trips: DataFrame


def build_models(
    sources: Sources,
    seed: str = "taxi_zone_lookup",
    strict: bool = True,
    is_test_run: bool = False,
    tables_root: str | None = None,
    check: bool = False,
) -> Models:
    """Staging as views, dimension and facts as tables (below ``tables_root`` when given).

    The inputs are the named sources ``green_tripdata``, ``yellow_tripdata``, ``fhv_tripdata``
    and the seed. With ``check``, the staged feeds are written to scratch once, checked, and the
    facts are built from what was checked: a failing check leaves the old facts in place, and so does
    a build that dies. A test run builds from samples, so it saves nothing: all its models are views,
    under names of their own (``SAMPLE_PREFIX``), so that no later build or question meets them.
    """
    def view(df: DataFrame, name: str) -> DataFrame:
        return as_view(df, f"{SAMPLE_PREFIX}{name}" if is_test_run else name)

    def table(df: DataFrame, name: str) -> DataFrame:
        if is_test_run:
            return view(df, name)
        return rebuild_table(df, name, f"{tables_root}/{name}" if tables_root else None)

    def staged(stage, source: str) -> DataFrame:
        df = stage(sources.table(source), strict, is_test_run)
        if check:
            spark, path = df.sparkSession, scratch_path(df.sparkSession, f"stg_{source}")
            df.write.parquet(path)
            df = spark.read.schema(df.schema).parquet(path)
        return view(df, f"stg_{source}")

    green = staged(stage_green, "green_tripdata")
    yellow = staged(stage_yellow, "yellow_tripdata")
    fhv = staged(stage_fhv, "fhv_tripdata")
    if check:
        models = {
            "stg_green_tripdata": green, "stg_yellow_tripdata": yellow, "stg_fhv_tripdata": fhv,
        }
        enforce(check_report(models, sources.table(seed)))
    zones = table(dim_zones(sources.table(seed)), "dim_zones")
    return Models(
        green,
        yellow,
        fhv,
        zones,
        table(fact_trips(green, yellow, zones), "fact_trips"),
        table(fact_fhv_trips(fhv, zones), "fact_fhv_trips"),
    )

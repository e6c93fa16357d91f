"""Every operator, run over the whole star-schema tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.fixed_values import (
    ACCEPTED_PAYMENT_TYPES, DEFAULT_FILES, FHVHV_SCHEMA, FHV_SCHEMA, GREEN_OVERRIDES,
    MONTH_TABLE_TEMPLATE, PAYMENT_LABELS,
)
from kerbside.functions import encode_base_pandas, month_name
from kerbside.operators.aggregates import exact_sum
from kerbside.operators.inspect import schema_rows, table_ddl
from kerbside.operators.quality import (
    DataCheckError, enforce, load_audit, missing_values, repeated_values, unaccepted_values, unmatched_values,
)
from kerbside.operators.topn import preview
from kerbside.plans import questions
from kerbside.plans.build import build_models, ingest_in_parts, ingest_months
from kerbside.plans.checks import check_report
from kerbside.plans.marts import dim_zones, fact_fhv_trips, fact_trips, known_zones
from kerbside.plans.revenue import FEED_COLUMNS as REVENUE_COLUMNS
from kerbside.plans.revenue import FEED_TIMES, monthly_zone_revenue, trips_by_service
from kerbside.plans.staging import stage_fhv, stage_green, stage_yellow
from kerbside.session import files_for, input_bytes, prepare, scratch_path
from kerbside.sinks import files, tables
from kerbside.sinks.manifest import read_landed
from kerbside.sources import csv, monthly
from kerbside.sources.star_schema import feed, input_paths, table, trips, zones
from kerbside.sources.tables import (
    Sources, load_seed, local_rows, read_tree, read_year, register_external,
)
from kerbside.streaming import land_new_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# One directory per month, as a partitioned writer lays out a test feed.
MONTH_DIRS = "{root}/{service}/file_month={month}"


def comparable(df: DataFrame) -> DataFrame:
    """Decimals, intervals and dates as text, timestamps without zone: one form in any engine."""
    def plain(field: T.StructField) -> str:
        match field.dataType:
            case T.DecimalType() | T.DateType() | T.DayTimeIntervalType():
                form = "string"
            case T.TimestampType():
                form = "timestamp_ntz"
            case _:
                return f"`{field.name}`"
        return f"CAST(`{field.name}` AS {form}) AS `{field.name}`"

    return df.selectExpr(*[plain(f) for f in df.schema])


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        @functools.wraps(build)
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            prepare(spark, input_paths(data_dir))
            return comparable(build(spark, data_dir))

        QUERIES[name] = run
        return build

    return register


def _revenue_trips(spark: SparkSession, d: str) -> DataFrame:
    def columns(service: str) -> list[str]:
        own = {common: name for name, common in FEED_TIMES[service].items()}
        return [own.get(c, c) for c in REVENUE_COLUMNS]

    return trips_by_service(*[feed(spark, d, s, columns(s)) for s in ("green", "yellow")])


def _staged(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "stg_green_tripdata": stage_green(feed(spark, d, "green")),
        "stg_yellow_tripdata": stage_yellow(feed(spark, d, "yellow")),
        "stg_fhv_tripdata": stage_fhv(feed(spark, d, "fhv")),
    }


# --- reports and models ---------------------------------------------------------

@query("monthly_zone_revenue")
def monthly_zone_revenue_report(spark, d):
    return monthly_zone_revenue(_revenue_trips(spark, d)).withColumn(
        "revenue_month", F.to_date("revenue_month")
    )


@query("stg_green")
def stg_green(spark, d):
    return stage_green(feed(spark, d, "green"))


@query("stg_yellow")
def stg_yellow(spark, d):
    return stage_yellow(feed(spark, d, "yellow"))


@query("stg_fhv")
def stg_fhv(spark, d):
    return stage_fhv(feed(spark, d, "fhv"))


@query("dim_zones")
def zone_dimension(spark, d):
    return dim_zones(zones(spark, d))


@query("fact_trips")
def trip_facts(spark, d):
    staged = _staged(spark, d)
    return fact_trips(
        staged["stg_green_tripdata"], staged["stg_yellow_tripdata"], dim_zones(zones(spark, d))
    )


@query("fact_fhv_trips")
def fhv_trip_facts(spark, d):
    return fact_fhv_trips(stage_fhv(feed(spark, d, "fhv")), dim_zones(zones(spark, d)))


# --- questions ------------------------------------------------------------------

@query("trips_on_date")
def trips_on_date(spark, d):
    yellow = feed(spark, d, "yellow", ["tpep_pickup_datetime"])
    return questions.trips_on_day(yellow, "tpep_pickup_datetime", "1996-01-15")


@query("largest_tip")
def largest_tip(spark, d):
    return questions.largest_tip(feed(spark, d, "yellow"))


@query("popular_destination")
def popular_destination(spark, d):
    rides = trips(spark, d, ["PULocationID", "DOLocationID"])
    return questions.popular_destination(rides, zones(spark, d), "nation_3")


@query("popular_destination_on_date")
def popular_destination_on_date(spark, d):
    rides = trips(spark, d, ["PULocationID", "DOLocationID", "pickup_datetime"])
    return questions.popular_destination(rides, zones(spark, d), "NATION_3", "1996-01-14", n=5)


@query("priciest_route")
def priciest_route(spark, d):
    rides = trips(spark, d, ["PULocationID", "DOLocationID", "total_amount"])
    return questions.priciest_routes(rides, zones(spark, d))


@query("rowcount_fhv")
def rowcount_fhv(spark, d):
    return questions.trip_rows(feed(spark, d, "fhv", ["dispatching_base_num"]))


@query("distinct_bases")
def distinct_bases(spark, d):
    return questions.distinct_bases(feed(spark, d, "fhv", ["dispatching_base_num"]))


@query("bases_in_range")
def bases_in_range(spark, d):
    days = ("1996-01-01", "1996-03-31")
    fhv = feed(spark, d, "fhv", ["dispatching_base_num", "pickup_datetime"], days)
    return questions.trips_of_bases(fhv, ["B00001", "B00007", "B00050"], *days)


@query("longest_trips")
def longest_trips(spark, d):
    rides = feed(spark, d, "fhvhv", ["pickup_datetime", "dropoff_datetime"])
    return questions.longest_trips(rides)


@query("busiest_bases")
def busiest_bases(spark, d):
    return questions.busiest_bases(feed(spark, d, "fhvhv", ["dispatching_base_num"]))


@query("top_pairs")
def top_pairs(spark, d):
    rides = feed(spark, d, "fhvhv", ["PULocationID", "DOLocationID"])
    named = zones(spark, d).withColumn("LocationID", F.col("LocationID").cast("string"))
    return questions.top_pairs(rides, named)


@query("trips_per_service")
def trips_per_service(spark, d):
    green, yellow = feed(spark, d, "green", ["VendorID"]), feed(spark, d, "yellow", ["VendorID"])
    return questions.trips_per_service(trips_by_service(green, yellow))


@query("trips_per_service_sql")
def trips_per_service_sql(spark, d):
    """The same count as SQL text over a temporary view."""
    green, yellow = feed(spark, d, "green", ["VendorID"]), feed(spark, d, "yellow", ["VendorID"])
    tables.as_view(trips_by_service(green, yellow), "trips_data")
    return spark.sql("SELECT service_type, count(*) AS trips FROM trips_data GROUP BY 1")


@query("license_filter")
def license_filter(spark, d):
    rides = feed(spark, d, "fhvhv", [
        "hvfhs_license_num", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID",
    ])
    return questions.trips_of_license(rides, "HV0003")


def _base_rides(spark, d):
    return feed(spark, d, "fhvhv", [
        "dispatching_base_num", "pickup_datetime", "dropoff_datetime", "PULocationID",
        "DOLocationID",
    ])


@query("base_id_encoding")
def base_id_encoding(spark, d):
    return questions.encoded_bases(_base_rides(spark, d))


@query("base_id_encoding_pandas")
def base_id_encoding_pandas(spark, d):
    return questions.encoded_bases(_base_rides(spark, d), encode_base_pandas())


@query("payment_label_counts")
def payment_label_counts(spark, d):
    """Local rows joined to the trips."""
    import pandas as pd

    labels = local_rows(
        spark, pd.DataFrame({"code": list(PAYMENT_LABELS), "label": list(PAYMENT_LABELS.values())})
    )
    counts = trips(spark, d, ["payment_type"]).groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("trips")
    )
    return counts.join(labels, F.col("payment_type") == F.col("code")).select("label", "trips")


# --- data checks ----------------------------------------------------------------

@query("dq_unique")
def dq_unique(spark, d):
    """Ids repeat across feeds; within one feed they do not (see ``dq_report``)."""
    staged = [df.select("tripid") for df in _staged(spark, d).values()]
    return repeated_values(staged[0].unionAll(staged[1]).unionAll(staged[2]), "tripid")


@query("dq_not_null")
def dq_not_null(spark, d):
    staged = [df.select("tripid") for df in _staged(spark, d).values()]
    everything = staged[0].unionAll(staged[1]).unionAll(staged[2])
    return questions.row_count(missing_values(everything, "tripid"), "failing_rows")


@query("dq_relationships")
def dq_relationships(spark, d):
    staged = stage_green(feed(spark, d, "green"))
    known = known_zones(dim_zones(zones(spark, d)))
    return unmatched_values(staged, "dropoff_locationid", known, "locationid")


@query("dq_accepted_values")
def dq_accepted_values(spark, d):
    staged = stage_yellow(feed(spark, d, "yellow"))
    return unaccepted_values(staged, "payment_type", ACCEPTED_PAYMENT_TYPES)


@query("dq_report")
def dq_report(spark, d):
    """All declared checks; the zones that count are those with a known borough."""
    return check_report(_staged(spark, d), known_zones(dim_zones(zones(spark, d))))


@query("dq_enforced")
def dq_enforced(spark, d):
    """What a build over these feeds is refused for: failing checks of severity ``error``."""
    refused = []
    try:
        enforce(dq_report(spark, d))
    except DataCheckError as error:
        refused = str(error).split("; ")
    return spark.createDataFrame([(reason,) for reason in refused], "refused string")


# --- CSV ------------------------------------------------------------------------

def _as_csv(spark, d, name: str) -> str:
    path = scratch_path(spark, f"{name}-csv")
    files.write_csv(feed(spark, d, name), path)
    return path


@query("csv_roundtrip_strings")
def csv_roundtrip_strings(spark, d):
    return csv.read_csv_strings(spark, _as_csv(spark, d, "fhvhv"))


@query("csv_roundtrip_schema")
def csv_roundtrip_schema(spark, d):
    return csv.read_csv(spark, _as_csv(spark, d, "fhvhv"), FHVHV_SCHEMA)


@query("csv_roundtrip_inferred")
def csv_roundtrip_inferred(spark, d):
    return csv.read_csv_inferred(spark, _as_csv(spark, d, "green"))


@query("csv_roundtrip_sampled")
def csv_roundtrip_sampled(spark, d):
    return csv.read_csv_sampled(spark, _as_csv(spark, d, "yellow"))


@query("csv_roundtrip_override")
def csv_roundtrip_override(spark, d):
    return csv.read_csv_override(spark, _as_csv(spark, d, "green"), GREEN_OVERRIDES)


@query("csv_reordered_header")
def csv_reordered_header(spark, d):
    """Two files of one feed whose columns stand in another order, read as one."""
    path = scratch_path(spark, "reordered")
    rides = feed(spark, d, "fhv")
    late = F.coalesce(F.hour("pickup_datetime") >= 12, F.lit(True))
    files.write_csv(rides.filter(~late), f"{path}/early.csv")
    files.write_csv(rides.filter(late).select(*reversed(rides.columns)), f"{path}/late.csv")
    return csv.read_csv(spark, [f"{path}/early.csv", f"{path}/late.csv"], FHV_SCHEMA)


@query("csv_dirty_values")
def csv_dirty_values(spark, d):
    """Values that do not parse: NULL when lenient, and how many rows that concerns."""
    path = scratch_path(spark, "dirty")
    broken = F.when(F.col("l_linenumber") == 7, "seven").otherwise(F.col("l_linenumber").cast("string"))
    lines = table(spark, d, "lineitem").select("l_orderkey", broken.alias("l_linenumber"))
    files.write_csv(lines, path)
    lenient = csv.read_csv(spark, path, "l_orderkey bigint, l_linenumber int", strict=False)
    return lenient.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("csv_pieces")
def csv_pieces(spark, d):
    """A file read in pieces: rows and their sum do not depend on the size of a piece."""
    path = _as_csv(spark, d, "fhv")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    csv.set_piece_bytes(spark, 100_000)
    try:
        small = csv.read_csv(spark, path, FHV_SCHEMA)
        # Written while the setting holds: a plan is only made when it runs.
        pieces = scratch_path(spark, "pieces")
        small.write.parquet(pieces)
    finally:
        spark.conf.set(key, before)
    return spark.read.parquet(pieces)


@query("csv_to_parquet")
def csv_to_parquet(spark, d):
    path = scratch_path(spark, "convert")
    source = f"{path}/fhv.csv"
    files.write_csv(feed(spark, d, "fhv"), source)
    return files.csv_to_parquet(spark, source, f"{path}/fhv.parquet", schema=FHV_SCHEMA)


@query("csv_row_index")
def csv_row_index(spark, d):
    """Line items in files sorted by all columns: number and row are those of that order."""
    path, source = scratch_path(spark, "indexed"), scratch_path(spark, "sorted")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    # Ranges of the order, each sorted: the files' order by name is the order of the rows.
    rows = table(spark, d, "lineitem").select(*columns)
    files.write_csv(rows.repartitionByRange(8, *columns).sortWithinPartitions(*columns), source)
    files.index_csv(spark, source, path)
    types = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double"
    return csv.read_csv(spark, path, f"row_index bigint, {types}")


@query("inferred_columns")
def inferred_columns(spark, d):
    """Column listing after inference over all rows of a CSV."""
    inferred = csv.read_csv_inferred(spark, _as_csv(spark, d, "fhvhv"))
    return spark.createDataFrame(
        [(position, name, kind) for position, name, kind, _ in schema_rows(inferred)],
        "position int, column_name string, data_type string",
    )


@query("inference_reasons")
def inference_reasons(spark, d):
    """For each column, the types that inference passed over, and the first value that ruled each out."""
    path = scratch_path(spark, "reasons")
    broken = F.when(F.col("l_linenumber") == 7, "seven").otherwise(F.col("l_linenumber").cast("string"))
    lines = table(spark, d, "lineitem").select("l_quantity", broken.alias("l_linenumber"), "l_shipdate")
    files.write_csv(lines.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd")), path)
    found = csv.inferred_types(csv.read_csv_strings(spark, path))
    return spark.createDataFrame(
        [(t.name, t.kind, kind, value) for t in found for kind, (value, _) in t.broken.items()],
        "column_name string, data_type string, passed_over string, reason string",
    )


@query("table_ddl")
def table_ddl_of_csv(spark, d):
    """DDL of a table for a CSV whose types are inferred over all rows."""
    inferred = csv.read_csv_inferred(spark, _as_csv(spark, d, "fhvhv"))
    return spark.createDataFrame([(table_ddl(inferred, "trips"),)], "ddl string")


# --- Parquet, layout, backfill --------------------------------------------------

@query("parquet_repartition_roundtrip")
def parquet_repartition_roundtrip(spark, d):
    path = scratch_path(spark, "repartitioned")
    pieces = files_for(input_bytes(spark, input_paths(d)), at_least=DEFAULT_FILES)
    files.write_repartitioned(feed(spark, d, "fhvhv"), path, pieces)
    return spark.read.parquet(path)


@query("parquet_single_file")
def parquet_single_file(spark, d):
    """The revenue report as one file."""
    path = scratch_path(spark, "report")
    files.write_single_file(monthly_zone_revenue_report(spark, d), path)
    return spark.read.parquet(path)


def _laid_out(spark, d) -> str:
    path = scratch_path(spark, "lake")
    for service, times in FEED_TIMES.items():
        rides = feed(spark, d, service, ["VendorID", *times, "PULocationID", "total_amount"])
        tagged = rides.withColumnsRenamed(times).withColumn("service_type", F.lit(service))
        files.write_by_month(
            files.with_year_month(tagged, "pickup_datetime"),
            path,
            ["service_type", "year", "month"],
            mode="overwrite",
        )
    return path


@query("partitioned_layout")
def partitioned_layout(spark, d):
    return read_tree(spark, _laid_out(spark, d))


@query("one_year_scan")
def one_year_scan(spark, d):
    return read_year(spark, _laid_out(spark, d), "green", 1996)


@query("misplaced_rows")
def misplaced_rows(spark, d):
    """Rows outside their own year and month: none by pickup, which the layout follows."""
    lake = read_tree(spark, _laid_out(spark, d))
    times = ("pickup", "dropoff")
    counts = lake.agg(*[F.count_if(files.is_misplaced(f"{t}_datetime")).alias(t) for t in times])
    return counts.unpivot([], list(times), "time", "misplaced")


def _file_month():
    return month_name(F.coalesce("pickup_datetime", "dropoff_datetime"))


def _monthly_files(spark, d, turned: bool = False) -> tuple[str, list[str]]:
    """The fhv feed as one CSV directory per month, and the months it has.

    A trip without a pickup time is in the file of its drop-off. With ``turned``, files of every other
    month have their columns the other way round.
    """
    root = scratch_path(spark, "raw")
    rides = feed(spark, d, "fhv").withColumn("file_month", _file_month())
    odd = F.substring("file_month", 6, 2).cast("int") % 2 == 1
    parts = [rides]
    if turned:
        parts = [rides.filter(odd), rides.filter(~odd).select(*reversed(rides.columns))]
    for part in parts:
        (
            part.hint("rebalance", "file_month")
            .write.mode("append").partitionBy("file_month")
            .option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .csv(f"{root}/fhv")
        )
    # One row per calendar month, from the names of the folders.
    written = spark.read.text(f"{root}/fhv").select("file_month").distinct().collect()
    return root, sorted(str(r[0])[:7] for r in written)


@query("month_templated_scan")
def month_templated_scan(spark, d):
    root, months = _monthly_files(spark, d)
    span = monthly.month_range(months[0], months[-1])
    present = [m for m in span if m in set(months)]
    return monthly.read_months(spark, root, "fhv", present, FHV_SCHEMA, MONTH_DIRS)


@query("backfill_twice")
def backfill_twice(spark, d):
    """Every month landed, then every month again: the second run changes nothing."""
    root, months = _monthly_files(spark, d)
    dest = f"{root}/landed"
    for _ in range(2):
        ingest_months(spark, "fhv", months, root, FHV_SCHEMA, dest, MONTH_DIRS)
    return read_landed(spark, dest)


@query("backfill_corrected_month")
def backfill_corrected_month(spark, d):
    """All months landed; then one shrinks to nothing, another loses half its rows, and both land again."""
    root, months = _monthly_files(spark, d)
    dest = f"{root}/landed"
    ingest_months(spark, "fhv", months, root, FHV_SCHEMA, dest, MONTH_DIRS)
    emptied, corrected = "1996-03", "1996-04"
    for month, kept in ((emptied, F.lit(False)), (corrected, F.col("PULocationID") % 2 == 0)):
        rides = feed(spark, d, "fhv")
        own = rides.filter((_file_month() == month) & kept)
        (
            own.hint("rebalance").write.mode("overwrite").option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .csv(f"{root}/fhv/file_month={month}")
        )
    ingest_months(spark, "fhv", [emptied, corrected], root, FHV_SCHEMA, dest, MONTH_DIRS)
    return read_landed(spark, dest)


@query("year_folder_scan")
def year_folder_scan(spark, d):
    """Month-named Parquet in folders by service and year, of two services; one year of one read back."""
    root = scratch_path(spark, "named")
    for service, times in FEED_TIMES.items():
        pickup = next(name for name, common in times.items() if common == "pickup_datetime")
        rides = feed(spark, d, service, ["VendorID", pickup, "total_amount"])
        files.write_month_files(
            rides.withColumn("file_month", month_name(F.col(pickup))), root, service
        )
    return monthly.read_month_files(spark, root, "green", monthly.month_range("1996-01", "1996-12"))


@query("ingest_progress")
def ingest_progress(spark, d):
    """Years landed one after the other: rows of each, and how much of the range was done by then."""
    root, months = _monthly_files(spark, d)
    years = [[m for m in months if m[:4] == year] for year in sorted({m[:4] for m in months})]
    done = ingest_in_parts(spark, "fhv", years, root, FHV_SCHEMA, f"{root}/landed", MONTH_DIRS)
    return spark.createDataFrame(
        [(p.months[0], p.months[-1], p.rows, p.seconds > 0, p.percent_done) for p in done],
        "first_month string, last_month string, loaded_rows bigint, timed boolean, percent_done double",
    )


@query("incremental_landing")
def incremental_landing(spark, d):
    """A stream over the same files, run twice on one checkpoint: the second run adds nothing."""
    root, _ = _monthly_files(spark, d)
    dest, checkpoint = f"{root}/landed", f"{root}/checkpoint"
    for _ in range(2):
        land_new_files(spark, f"{root}/fhv", FHV_SCHEMA, dest, checkpoint, MONTH_DIRS)
    return read_landed(spark, dest)


@query("landing_reordered_header")
def landing_reordered_header(spark, d):
    """One stream over files whose columns stand in two orders."""
    root, _ = _monthly_files(spark, d, turned=True)
    dest = f"{root}/landed"
    land_new_files(spark, f"{root}/fhv", FHV_SCHEMA, dest, f"{root}/checkpoint", MONTH_DIRS)
    return read_landed(spark, dest)


@query("ingest_audit")
def ingest_audit(spark, d):
    """Rows expected from the source and found after landing, per month."""
    root, months = _monthly_files(spark, d)
    dest = f"{root}/landed"
    ingest_months(spark, "fhv", months, root, FHV_SCHEMA, dest, MONTH_DIRS)
    source = feed(spark, d, "fhv", ["pickup_datetime", "dropoff_datetime"]).select(
        _file_month().alias("month_name")
    )
    landed = read_landed(spark, dest).select(
        F.format_string("%04d-%02d", "year", "month").alias("month_name")
    )
    return load_audit(source, landed, "month_name")


@query("write_if_absent")
def write_if_absent(spark, d):
    """The second write finds the path taken and leaves it alone."""
    path = scratch_path(spark, "absent")
    files.write_if_absent(feed(spark, d, "fhv"), path)
    files.write_if_absent(feed(spark, d, "yellow"), path)
    return spark.read.parquet(path)


@query("month_tables")
def month_tables(spark, d):
    """One table holding every month; a month's own table is one partition of it."""
    path = scratch_path(spark, "months")
    rides = feed(spark, d, "yellow", ["tpep_pickup_datetime", "total_amount"])
    by_month = rides.withColumn("file_month", month_name(F.col("tpep_pickup_datetime")))
    files.write_by_month(by_month, path, ["file_month"])
    # Partition values stay text: 1995-03 is a name.
    stored = spark.read.schema(by_month.schema).parquet(path)
    prefix, _, _ = MONTH_TABLE_TEMPLATE.format(service="yellow", month="|").partition("|")
    return stored.groupBy(F.concat(F.lit(prefix), "file_month").alias("table_name")).agg(
        F.count(F.lit(1)).alias("n"), exact_sum(stored, "total_amount").alias("total_amount")
    )


# --- catalog --------------------------------------------------------------------

def _table_name(spark, label: str) -> tuple[str, str]:
    path = scratch_path(spark, label)
    return path.rsplit("/", 1)[1].replace("-", "_"), path


@query("table_replace_append")
def table_replace_append(spark, d):
    """Replace a table by an empty one, then append two pieces."""
    name, path = _table_name(spark, "appended")
    pieces = [
        feed(spark, d, s, ["VendorID", "PULocationID", "fare_amount"]) for s in ("green", "yellow")
    ]
    return tables.replace_then_append(pieces, name, path)


@query("external_table")
def external_table(spark, d):
    name, path = _table_name(spark, "external")
    feed(spark, d, "fhv").write.parquet(path)
    return register_external(spark, name, path)


@query("seed_table")
def seed_table(spark, d):
    """Zones as a CSV seed with a numeric key, loaded into a table and renamed to the dimension."""
    name, path = _table_name(spark, "seed")
    files.write_csv(zones(spark, d), f"{path}-csv")
    return dim_zones(load_seed(spark, f"{path}-csv", name, path=path))


@query("built_tables")
def built_tables(spark, d):
    """All models built from named sources; rows and distinct ids of each saved fact."""
    root = scratch_path(spark, "models")
    inputs = {f"{s}_tripdata": feed(spark, d, s) for s in ("green", "yellow", "fhv")}
    inputs["taxi_zone_lookup"] = zones(spark, d)
    paths = {}
    for name, df in inputs.items():
        paths[name] = f"{root}/{name}"
        df.write.parquet(paths[name])
    models = build_models(Sources(spark, paths), tables_root=f"{root}/tables")
    counted = [
        getattr(models, name).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("tripid").alias("ids"),
        )
        for name in ("fact_trips", "fact_fhv_trips")
    ]
    return counted[0].unionByName(counted[1])


# --- samples --------------------------------------------------------------------

@query("dev_limit")
def dev_limit(spark, d):
    """A development sample has 100 rows, all of them rows of the whole model."""
    green = feed(spark, d, "green")
    sample = stage_green(green, is_test_run=True).select("tripid")
    found = sample.join(stage_green(green).select("tripid"), "tripid", "left_semi")
    return questions.row_count(found, "sampled_rows")


@query("first_rows")
def first_rows(spark, d):
    return preview(feed(spark, d, "fhvhv"))

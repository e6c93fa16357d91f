from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kerbside import fixed_values as fixed
from kerbside.operators.quality import DataCheckError
from kerbside.plans import questions
from kerbside.plans.build import build_models
from kerbside.plans.checks import DECLARED_CHECKS, check_report
from kerbside.plans.marts import dim_zones, fact_fhv_trips, fact_trips
from kerbside.plans.revenue import monthly_zone_revenue, trips_by_service
from kerbside.plans.staging import stage_fhv, stage_green, stage_yellow
from kerbside.sources.tables import Sources

T1, T2 = datetime(2021, 1, 1, 0, 15, 56), datetime(2021, 1, 1, 0, 30)

BASE = {
    "VendorID": 1, "store_and_fwd_flag": "N", "RatecodeID": 1, "PULocationID": 1,
    "DOLocationID": 2, "passenger_count": 1, "trip_distance": 2.5, "fare_amount": 10.25,
    "extra": 0.5, "mta_tax": 0.5, "tip_amount": 1.0, "tolls_amount": 0.0,
    "improvement_surcharge": 0.3, "total_amount": 12.55, "payment_type": 1,
    "congestion_surcharge": 2.5, "pickup": T1, "dropoff": T2, "ehail_fee": 9.0, "trip_type": 2,
    "dispatching_base_num": "B1", "pickup_datetime": T1, "dropoff_datetime": T2, "SR_Flag": None,
}


def feed(spark, service, *changes):
    ddl = {"green": fixed.GREEN_SCHEMA, "yellow": fixed.YELLOW_SCHEMA, "fhv": fixed.FHV_SCHEMA}
    empty = spark.createDataFrame([], ddl[service])
    long = {"lpep_pickup_datetime": "pickup", "lpep_dropoff_datetime": "dropoff",
            "tpep_pickup_datetime": "pickup", "tpep_dropoff_datetime": "dropoff"}
    rows = [
        tuple({**BASE, **change}[long.get(c, c)] for c in empty.columns) for change in changes
    ]
    return spark.createDataFrame(rows, ddl[service])


def zones(spark):
    return spark.createDataFrame(
        [
            ("1", "Queens", "Corona", "Boro Zone"),
            ("2", "Queens", "Corona", "Boro Zone"),
            ("3", "Manhattan", "Central Park", "Yellow Zone"),
            ("264", "Unknown", "NV", "N/A"),
        ],
        "LocationID string, Borough string, Zone string, service_zone string",
    )


def test_staged_shape_and_types(spark):
    green, yellow = stage_green(feed(spark, "green", {})), stage_yellow(feed(spark, "yellow", {}))
    assert green.columns == yellow.columns == fixed.STAGED_TRIP_COLUMNS
    assert green.dtypes == yellow.dtypes
    types = dict(green.dtypes)
    assert types["fare_amount"] == "decimal(38,9)" and types["vendorid"] == "int"
    g, y = green.first(), yellow.first()
    assert (g.trip_type, y.trip_type) == (2, 1)
    # The reported fee is dropped.
    assert g.ehail_fee == Decimal(0) and g.fare_amount == Decimal("10.25")
    assert g.payment_type_description == "Credit card"
    # The same vendor and time give the same id in both services.
    assert g.tripid == y.tripid
    assert stage_fhv(feed(spark, "fhv", {})).columns == fixed.STAGED_FHV_COLUMNS


def test_staging_drops_missing_vendors_and_keeps_one_per_key(spark):
    staged = stage_green(feed(
        spark, "green",
        {"VendorID": None},
        {"fare_amount": 9.0}, {"fare_amount": 8.0}, {"fare_amount": 8.0},
        {"pickup": None, "fare_amount": 5.0}, {"pickup": None, "fare_amount": 6.0},
        {"VendorID": 2, "payment_type": 7},
    ))
    got = {(r.vendorid, r.pickup_datetime, r.fare_amount, r.payment_type_description)
           for r in staged.collect()}
    assert got == {
        (1, T1, Decimal(8), "Credit card"), (1, None, Decimal(5), "Credit card"),
        (2, T1, Decimal("10.25"), None),
    }


def test_staging_text_feed(spark):
    texts = feed(spark, "green", {}, {"VendorID": 2})
    texts = texts.select(*[F.col(c).cast("string").alias(c) for c in texts.columns])
    dirty = texts.withColumn(
        "passenger_count", F.when(F.col("VendorID") == "2", "many").otherwise("1")
    )
    assert {r.payment_type_description for r in stage_green(texts).collect()} == {"Credit card"}
    lenient = {r.vendorid: r.passenger_count for r in stage_green(dirty, strict=False).collect()}
    assert lenient == {1: 1, 2: None}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage_green(dirty).collect()


def test_staging_sample_is_off_by_default(spark):
    many = feed(spark, "fhv", *[{"dispatching_base_num": f"B{i}"} for i in range(150)])
    assert stage_fhv(many).count() == 150
    assert stage_fhv(many, is_test_run=True).count() == 100


def test_facts_keep_trips_between_known_zones(spark):
    dim = dim_zones(zones(spark))
    assert dim.columns == fixed.DIM_ZONE_COLUMNS
    assert {r.service_zone for r in dim.collect()} == {"Green Zone", "Yellow Zone", "N/A"}
    cases = [
        {"VendorID": 1}, {"VendorID": 2, "DOLocationID": 264}, {"VendorID": 3, "PULocationID": 99},
        {"VendorID": 4, "PULocationID": None}, {"VendorID": 5, "PULocationID": 3},
    ]
    facts = fact_trips(
        stage_green(feed(spark, "green", *cases)), stage_yellow(feed(spark, "yellow", {})), dim
    )
    assert facts.columns == fixed.FACT_TRIP_COLUMNS
    got = sorted((r.service_type, r.vendorid, r.pickup_zone, r.dropoff_borough)
                 for r in facts.collect())
    assert got == [
        ("Green", 1, "Corona", "Queens"), ("Green", 5, "Central Park", "Queens"),
        ("Yellow", 1, "Corona", "Queens"),
    ]
    fhv = stage_fhv(feed(spark, "fhv", {}, {"dispatching_base_num": "B2", "DOLocationID": 264}))
    facts = fact_fhv_trips(fhv, dim)
    assert facts.columns == fixed.STAGED_FHV_COLUMNS
    assert [r.dispatching_base_num for r in facts.collect()] == ["B1"]


def test_revenue_counts_duplicates_and_unknown_keys(spark):
    green = feed(spark, "green", {}, {}, {"PULocationID": None, "pickup": None, "tip_amount": None})
    report = monthly_zone_revenue(trips_by_service(green, feed(spark, "yellow", {})))
    assert report.columns == [
        "revenue_zone", "revenue_month", "service_type", *fixed.REVENUE_SUMS,
        *fixed.REVENUE_AVERAGES,
    ]
    got = {(r.revenue_zone, r.service_type): r for r in report.collect()}
    assert got[1, "green"].revenue_monthly_total_amount == 25.1
    assert got[1, "green"].revenue_month == datetime(2021, 1, 1)
    assert got[1, "yellow"].revenue_monthly_fare == 10.25
    unknown = got[None, "green"]
    assert unknown.revenue_month is None and unknown.revenue_monthly_tip_amount is None
    assert got[1, "green"].avg_montly_trip_distance == 2.5


def trips(spark, rows):
    return spark.createDataFrame(
        rows, "PULocationID int, DOLocationID int, pickup_datetime timestamp_ntz, "
        "dropoff_datetime timestamp_ntz, total_amount double, tip_amount double",
    )


def test_routes_combine_equal_zone_names(spark):
    named = zones(spark)
    rides = trips(spark, [
        (1, 3, T1, T2, 10.0, 1.0), (2, 3, T1, T2, 20.0, None), (3, 1, T1, T2, 14.0, 5.0),
        (3, 2, T2, T1, None, 5.0), (99, 1, T1, T2, 1000.0, 0.0),
    ])
    top = questions.top_pairs(rides, named)
    assert [tuple(r) for r in top.collect()] == [
        ("Central Park / Corona", 2), ("Corona / Central Park", 2)
    ]
    price = questions.priciest_routes(rides, named, n=2)
    assert [tuple(r) for r in price.collect()] == [
        ("Corona / Central Park", 15.0), ("Central Park / Corona", 14.0)
    ]
    where = questions.popular_destination(rides, named, "CENTRAL park")
    assert [tuple(r) for r in where.collect()] == [("Corona", 2)]
    none = questions.popular_destination(rides, named, "Central Park", day="2021-01-02")
    assert none.collect() == []


def test_missing_zone_names(spark):
    named = zones(spark).withColumn("Zone", F.when(F.col("LocationID") != "2", F.col("Zone")))
    rides = trips(spark, [(3, 2, T1, T2, 1.0, 1.0)] * 3 + [(3, 1, T1, T2, 1.0, 1.0)])
    where = questions.popular_destination(rides, named, "central park", n=5)
    assert [tuple(r) for r in where.collect()] == [("Corona", 1), (None, 0)]
    top = questions.top_pairs(rides, named, missing="Unknown", n=1)
    assert [tuple(r) for r in top.collect()] == [("Central Park / Unknown", 3)]


def test_trip_questions(spark):
    rides = trips(spark, [
        (1, 3, T1, T2, 1.0, 1.0), (2, 3, T2, T1, 1.0, 7.0), (3, 3, None, T1, 1.0, None),
    ])
    longest = questions.longest_trips(rides, 2).collect()
    assert [(str(r.pickup_date), r.duration_seconds) for r in longest] == [
        ("2021-01-01", 844), ("2021-01-01", -844)
    ]
    assert longest[0].time_diff.total_seconds() == 844
    assert questions.largest_tip(rides).first().PULocationID == 2
    assert questions.trips_on_day(rides, "pickup_datetime", "2021-01-01").first().n == 2


def test_fourteen_checks_and_their_severity(spark):
    assert sum(len(c) for c in DECLARED_CHECKS.values()) == 14
    errors = [(m, c.column) for m, cs in DECLARED_CHECKS.items() for c in cs
              if c.severity == "error"]
    assert errors == [("stg_green_tripdata", "dropoff_locationid")]
    models = {
        "stg_green_tripdata": stage_green(feed(spark, "green", {"DOLocationID": 50})),
        "stg_yellow_tripdata": stage_yellow(feed(spark, "yellow", {"payment_type": 9})),
        "stg_fhv_tripdata": stage_fhv(feed(spark, "fhv", {"PULocationID": 51})),
    }
    failing = check_report(models, zones(spark), "LocationID").filter("failing_rows > 0")
    assert sorted(tuple(r) for r in failing.collect()) == [
        ("stg_fhv_tripdata", "pickup_locationid", "relationships", "warn", 1),
        ("stg_green_tripdata", "dropoff_locationid", "relationships", "error", 1),
        ("stg_yellow_tripdata", "payment_type", "accepted_values", "warn", 1),
    ]


def test_build_saves_facts_and_enforces_checks(spark, tmp_path):
    def write(name, df):
        df.write.parquet(str(tmp_path / name))
        return str(tmp_path / name)

    paths = {
        "green_tripdata": write("g", feed(spark, "green", {})),
        "yellow_tripdata": write("y", feed(spark, "yellow", {}, {"VendorID": 2})),
        "fhv_tripdata": write("f", feed(spark, "fhv", {})),
        "taxi_zone_lookup": write("z", zones(spark)),
    }
    models = build_models(Sources(spark, paths), tables_root=str(tmp_path / "out"), check=True)
    assert models.fact_trips.count() == spark.table("fact_trips").count() == 3
    assert spark.table("fact_fhv_trips").count() == 1
    assert spark.table("stg_green_tripdata").count() == 1
    # Built again over new input: refused by the one check that is an error; the old facts stay.
    paths["green_tripdata"] = write("g2", feed(spark, "green", {"DOLocationID": 77}))
    with pytest.raises(DataCheckError, match="stg_green_tripdata.dropoff_locationid"):
        build_models(Sources(spark, paths), tables_root=str(tmp_path / "out"), check=True)
    assert spark.table("fact_trips").count() == 3
    build_models(Sources(spark, paths), tables_root=str(tmp_path / "out"))
    assert spark.table("fact_trips").count() == 2
    # A run on samples saves nothing, and no later build or question meets its views.
    def saved():
        return {n: sorted(map(str, spark.table(n).collect())) for n in ("dim_zones", "fact_trips", "fact_fhv_trips")}

    before, files = saved(), sorted(p for p in (tmp_path / "out").rglob("*"))
    sampled = build_models(Sources(spark, paths), is_test_run=True, tables_root=str(tmp_path / "out"))
    assert sampled.fact_trips.count() == 2 == spark.table("sample_fact_trips").count()
    assert saved() == before and sorted(p for p in (tmp_path / "out").rglob("*")) == files
    assert spark.table("stg_yellow_tripdata").count() == 2
    build_models(Sources(spark, paths), tables_root=str(tmp_path / "out"))
    assert saved() == before
    for name in [t.name for t in spark.catalog.listTables(pattern="sample_*")]:
        spark.catalog.dropTempView(name)


def test_a_build_that_dies_leaves_the_old_facts(spark, tmp_path, monkeypatch):
    paths = {}
    for name, df in (
        ("green_tripdata", feed(spark, "green", {})), ("yellow_tripdata", feed(spark, "yellow", {})),
        ("fhv_tripdata", feed(spark, "fhv", {})), ("taxi_zone_lookup", zones(spark)),
    ):
        paths[name] = str(tmp_path / name)
        df.write.parquet(paths[name])
    root = str(tmp_path / "out")
    build_models(Sources(spark, paths), tables_root=root)
    whole = spark.table("fact_trips").collect()

    def broken(*args):
        return fact_trips(*args).withColumn("vendorid", F.raise_error(F.lit("broken")).cast("int"))

    monkeypatch.setattr("kerbside.plans.build.fact_trips", broken)
    with pytest.raises(Exception, match="broken"):
        build_models(Sources(spark, paths), tables_root=root)
    assert spark.table("fact_trips").collect() == whole

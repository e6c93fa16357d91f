"""Trip feeds and zones over the star-schema tables the queries are checked on.

A trip is one ``lineitem`` row; its order, customer and supplier are looked up. Only the tables
that the requested columns come from are joined.

By rules on keys, some trips lack their vendor, their amounts or (fhv) their pickup time, or end in
a zone that does not exist, and two zones share a name.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.predicates import between_days

SERVICE_FLAGS = {"green": "A", "yellow": "R", "fhv": "N"}

ZONE_COLUMNS = ["LocationID", "Borough", "Zone", "service_zone"]

_FROM_LINEITEM = {
    "service": "CASE l_returnflag WHEN 'A' THEN 'green' WHEN 'R' THEN 'yellow' ELSE 'fhv' END",
    "VendorID": "nullif(l_suppkey, 8)",
    "dispatching_base_num": "'B' || lpad(CAST(l_suppkey AS STRING), 5, '0')",
    "hvfhs_license_num": "'HV000' || CAST(l_linenumber AS STRING)",
    "dropoff_datetime": "l_shipdate",
    "passenger_count": "l_quantity",
    "trip_distance": "l_quantity",
    "payment_type": "l_linenumber",
    "RatecodeID": "l_linenumber",
    "fare_amount": "l_extendedprice",
    "extra": "l_discount",
    "tip_amount": "CASE WHEN l_orderkey % 89 <> 0 THEN l_tax END",
    "mta_tax": "CAST(0.50 AS DOUBLE)",
    "tolls_amount": "CAST(0 AS DOUBLE)",
    "improvement_surcharge": "CAST(0.30 AS DOUBLE)",
    "congestion_surcharge": "CAST(2.50 AS DOUBLE)",
    "ehail_fee": "CAST(NULL AS DOUBLE)",
    "trip_type": "1 + l_linenumber % 2",
    "store_and_fwd_flag": "l_linestatus",
    "SR_Flag": "l_linestatus",
}
_FROM_ORDERS = {
    "pickup_datetime": "o_orderdate",
    "total_amount": "CASE WHEN o_orderkey % 101 <> 0 THEN o_totalprice END",
}
_FROM_CUSTOMER = {"DOLocationID": "CASE WHEN c_custkey % 53 = 0 THEN 99 ELSE c_nationkey END"}
# Of fhv trips, taken after the join; the other feeds' range on the order date reaches the scan.
_PICKUP = "CASE WHEN l_returnflag <> 'N' OR l_orderkey % 97 <> 0 THEN pickup_datetime END"
_FROM_SUPPLIER = {"PULocationID": "s_nationkey"}

_METERED = [
    "store_and_fwd_flag", "RatecodeID", "PULocationID", "DOLocationID", "passenger_count",
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "payment_type", "congestion_surcharge",
]

# Feed column -> trip column.
FEED_COLUMNS = {
    "green": {
        "VendorID": "VendorID",
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
        **{c: c for c in _METERED},
        "ehail_fee": "ehail_fee",
        "trip_type": "trip_type",
    },
    "yellow": {
        "VendorID": "VendorID",
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
        **{c: c for c in _METERED},
    },
    "fhv": {
        c: c
        for c in (
            "dispatching_base_num", "pickup_datetime", "dropoff_datetime", "PULocationID",
            "DOLocationID", "SR_Flag",
        )
    },
    # High-volume trips: every row, whatever its service.
    "fhvhv": {
        c: c
        for c in (
            "hvfhs_license_num", "dispatching_base_num", "pickup_datetime", "dropoff_datetime",
            "PULocationID", "DOLocationID", "SR_Flag",
        )
    },
}


def input_paths(data_dir: str) -> list[str]:
    """The tables that trips are made of."""
    return [f"{data_dir}/{t}.parquet" for t in ("lineitem", "orders", "customer", "supplier")]


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def trips(
    spark: SparkSession, data_dir: str, columns: Iterable[str], service: str | None = None,
    days: tuple[str, str] | None = None,
) -> DataFrame:
    """Trips with the given columns; with ``days``, only those picked up between two days.

    The days are compared with the bare order date, so that the range reaches its scan.
    """
    columns = list(columns)
    lines = table(spark, data_dir, "lineitem")
    if service is not None:
        lines = lines.filter(F.col("l_returnflag") == SERVICE_FLAGS[service])

    def picked(exprs: dict[str, str]) -> list:
        return [F.expr(exprs[c]).alias(c) for c in columns if c in exprs]

    from_customer = picked(_FROM_CUSTOMER)
    from_supplier = picked(_FROM_SUPPLIER)
    from_orders = picked(_FROM_ORDERS)
    needs_orders = bool(from_orders or from_customer)

    # Join the two smaller tables first, so that the line items are shuffled once for both.
    frame = lines.select("l_orderkey", "l_suppkey", "l_returnflag", *picked(_FROM_LINEITEM))
    if needs_orders:
        orders = table(spark, data_dir, "orders").select("o_orderkey", "o_custkey", *from_orders)
        if from_customer:
            customer = table(spark, data_dir, "customer").select("c_custkey", *from_customer)
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        frame = frame.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if from_supplier:
        supplier = table(spark, data_dir, "supplier").select("s_suppkey", *from_supplier)
        frame = frame.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    if days:
        frame = frame.filter(between_days(F.col("pickup_datetime"), *days))
    if "pickup_datetime" in columns and service not in ("green", "yellow"):
        frame = frame.withColumn("pickup_datetime", F.expr(_PICKUP))
    if days:
        frame = frame.filter(F.col("pickup_datetime").isNotNull())
    return frame.select(*columns)


def feed(
    spark: SparkSession, data_dir: str, name: str, columns: Iterable[str] | None = None,
    days: tuple[str, str] | None = None,
) -> DataFrame:
    """A raw feed under its own column names, whole or restricted to some of them, or to some days."""
    names = FEED_COLUMNS[name]
    wanted = list(columns) if columns is not None else list(names)
    service = name if name in SERVICE_FLAGS else None
    frame = trips(spark, data_dir, dict.fromkeys(names[c] for c in wanted), service, days)
    return frame.select(*[F.col(names[c]).alias(c) for c in wanted])


def zones(spark: SparkSession, data_dir: str) -> DataFrame:
    nation = table(spark, data_dir, "nation")
    region = table(spark, data_dir, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.selectExpr(
        "n_nationkey AS LocationID",
        "CASE WHEN n_nationkey >= 23 THEN 'Unknown' ELSE r_name END AS Borough",
        "CASE WHEN n_nationkey = 4 THEN 'NATION_3' ELSE n_name END AS Zone",
        "CASE WHEN n_nationkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone",
    )

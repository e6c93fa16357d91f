"""Names, types, labels and formats that a user's existing data and queries rely on.

Nothing here is derived: each value is part of the data contract.
"""

# --- Fixed values: declared source schemas ---------------------------------

GREEN_SCHEMA = """
    VendorID bigint, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp,
    store_and_fwd_flag string, RatecodeID bigint, PULocationID bigint, DOLocationID bigint,
    passenger_count bigint, trip_distance double, fare_amount double, extra double,
    mta_tax double, tip_amount double, tolls_amount double, ehail_fee double,
    improvement_surcharge double, total_amount double, payment_type bigint,
    trip_type bigint, congestion_surcharge double
"""

YELLOW_SCHEMA = """
    VendorID bigint, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp,
    passenger_count bigint, trip_distance double, RatecodeID bigint,
    store_and_fwd_flag string, PULocationID bigint, DOLocationID bigint,
    payment_type bigint, fare_amount double, extra double, mta_tax double,
    tip_amount double, tolls_amount double, improvement_surcharge double,
    total_amount double, congestion_surcharge double
"""

FHV_SCHEMA = """
    dispatching_base_num string, pickup_datetime timestamp, dropoff_datetime timestamp,
    PULocationID bigint, DOLocationID bigint, SR_Flag string
"""

FHVHV_SCHEMA = """
    hvfhs_license_num string, dispatching_base_num string, pickup_datetime timestamp,
    dropoff_datetime timestamp, PULocationID int, DOLocationID int, SR_Flag string
"""

# --- Fixed values: types ----------------------------------------------------

# A bare NUMERIC column means 38 digits, 9 of them after the point.
NUMERIC = "decimal(38,9)"

# Columns whose inferred type is replaced when a file is read.
GREEN_OVERRIDES = {"ehail_fee": "double"}
ZONE_SEED_OVERRIDES = {"locationid": NUMERIC}
ZONE_SEED_TABLE = "taxi_zone_lookup"

# --- Fixed values: labels and accepted codes --------------------------------

PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
ACCEPTED_PAYMENT_TYPES = [1, 2, 3, 4, 5, 6]
UNKNOWN_BOROUGH = "Unknown"
ROUTE_SEPARATOR = " / "
YELLOW_TRIP_TYPE = 1

# --- Fixed values: output columns, in order ---------------------------------

STAGED_TRIP_COLUMNS = [
    "tripid", "vendorid", "ratecodeid", "pickup_locationid", "dropoff_locationid",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
    "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
    "payment_type", "payment_type_description", "congestion_surcharge",
]

STAGED_FHV_COLUMNS = [
    "tripid", "dispatching_base_num", "pickup_locationid", "dropoff_locationid",
    "pickup_datetime", "dropoff_datetime", "sr_flag",
]

DIM_ZONE_COLUMNS = ["locationid", "borough", "zone", "service_zone"]

FACT_TRIP_COLUMNS = [
    "tripid", "vendorid", "service_type", "ratecodeid",
    "pickup_locationid", "pickup_borough", "pickup_zone",
    "dropoff_locationid", "dropoff_borough", "dropoff_zone",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
    "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
    "payment_type", "payment_type_description", "congestion_surcharge",
]

# Report column -> summed feed column.
REVENUE_SUMS = {
    "revenue_monthly_fare": "fare_amount",
    "revenue_monthly_extra": "extra",
    "revenue_monthly_mta_tax": "mta_tax",
    "revenue_monthly_tip_amount": "tip_amount",
    "revenue_monthly_tolls_amount": "tolls_amount",
    "revenue_monthly_improvement_surcharge": "improvement_surcharge",
    "revenue_monthly_total_amount": "total_amount",
    "revenue_monthly_congestion_surcharge": "congestion_surcharge",
}
# "montly" is the published spelling of these two columns.
REVENUE_AVERAGES = {
    "avg_montly_passenger_count": "passenger_count",
    "avg_montly_trip_distance": "trip_distance",
}

# --- Fixed values: file layout ----------------------------------------------

MONTH_FORMAT = "yyyy-MM"
RAW_FILE_TEMPLATE = "{root}/{service}_tripdata_{month}.csv"
LAKE_FILE_TEMPLATE = "{root}/{service}/{year}/{service}_taxi_{month}.parquet"
MONTH_TABLE_TEMPLATE = "{service}_taxi_{month}"
DEV_SAMPLE_ROWS = 100
INFER_SAMPLE_ROWS = 1000
DEFAULT_FILES = 24
JDBC_BATCH_ROWS = 100_000

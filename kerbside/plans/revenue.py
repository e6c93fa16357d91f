"""Monthly revenue by pickup zone and service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.fixed_values import REVENUE_AVERAGES, REVENUE_SUMS
from kerbside.functions import month_start
from kerbside.operators.aggregates import exact_avg, exact_sum
from kerbside.operators.unions import union_tagged

# The two time columns under the name each feed gives them.
FEED_TIMES = {
    "green": {"lpep_pickup_datetime": "pickup_datetime", "lpep_dropoff_datetime": "dropoff_datetime"},
    "yellow": {"tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime"},
}

# What the report reads, under the feeds' common names.
FEED_COLUMNS = [
    "PULocationID", "pickup_datetime", *REVENUE_SUMS.values(), *REVENUE_AVERAGES.values(),
]


def trips_by_service(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Raw trips of both services on the columns they share, tagged with ``service_type``."""
    return union_tagged(
        {
            "green": green.withColumnsRenamed(FEED_TIMES["green"]),
            "yellow": yellow.withColumnsRenamed(FEED_TIMES["yellow"]),
        },
        "service_type",
    )


def monthly_zone_revenue(trips: DataFrame) -> DataFrame:
    """Eight sums and two averages per zone, month and service; NULL zones and months stay.

    Works on raw trips, duplicates included. One shuffle, of partial sums only.
    """
    return trips.groupBy(
        F.col("PULocationID").alias("revenue_zone"),
        month_start(F.col("pickup_datetime")).alias("revenue_month"),
        "service_type",
    ).agg(
        *[exact_sum(trips, column).alias(name) for name, column in REVENUE_SUMS.items()],
        *[exact_avg(trips, column).alias(name) for name, column in REVENUE_AVERAGES.items()],
    )

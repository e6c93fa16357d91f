"""Questions asked of the trips."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import (
    between_days, duration, duration_seconds, encode_base, is_one_of, on_day, route_label,
    same_text, to_day,
)
from kerbside.operators.aggregates import count_by, distinct_count, exact_sum, row_count
from kerbside.operators.lookups import Lookup, join_role
from kerbside.operators.topn import top_rows


def trips_on_day(trips: DataFrame, ts: str, day: str) -> DataFrame:
    return row_count(trips.filter(on_day(F.col(ts), day)))


def largest_tip(trips: DataFrame) -> DataFrame:
    """The whole trip with the largest tip; trips without a tip value come last."""
    return top_rows(trips, "tip_amount", 1)


def trip_rows(trips: DataFrame) -> DataFrame:
    return row_count(trips)


def distinct_bases(trips: DataFrame) -> DataFrame:
    return distinct_count(trips, "dispatching_base_num")


def trips_of_bases(trips: DataFrame, bases: Iterable[str], first: str, last: str) -> DataFrame:
    """Trips of some bases picked up between two days, both included."""
    return row_count(
        trips.filter(
            is_one_of(F.col("dispatching_base_num"), bases)
            & between_days(F.col("pickup_datetime"), first, last)
        )
    )


def longest_trips(trips: DataFrame, n: int = 10) -> DataFrame:
    """Pickup day and duration of the longest trips, as an interval and in seconds."""
    start, end = F.col("pickup_datetime"), F.col("dropoff_datetime")
    timed = trips.select(
        to_day(start).alias("pickup_date"),
        duration(start, end).alias("time_diff"),
        duration_seconds(start, end).alias("duration_seconds"),
    )
    return top_rows(timed, "time_diff", n)


def busiest_bases(trips: DataFrame, n: int = 5) -> DataFrame:
    return top_rows(count_by(trips, "dispatching_base_num", name="trips"), "trips", n)


def trips_per_service(trips: DataFrame) -> DataFrame:
    return count_by(trips, "service_type", name="trips")


def trips_of_license(trips: DataFrame, license_num: str) -> DataFrame:
    return trips.filter(F.col("hvfhs_license_num") == license_num).select(
        "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"
    )


def encoded_bases(trips: DataFrame, encode=encode_base) -> DataFrame:
    return trips.select(
        encode(F.col("dispatching_base_num")).alias("base_id"),
        to_day(F.col("pickup_datetime")).alias("pickup_date"),
        to_day(F.col("dropoff_datetime")).alias("dropoff_date"),
        "PULocationID",
        "DOLocationID",
    )


# --- routes ---------------------------------------------------------------------
# Trips are first reduced to one row per pair of zone ids; only those meet the zones. Names are
# not unique, so the reduced rows are combined again by name.

def _named_pairs(pairs: DataFrame, pickup_zones: Lookup, dropoff_zones: Lookup) -> DataFrame:
    named = join_role(pairs, pickup_zones, "PULocationID", "LocationID", {"Zone": "pickup_zone"})
    return join_role(named, dropoff_zones, "DOLocationID", "LocationID", {"Zone": "dropoff_zone"})


def popular_destination(
    trips: DataFrame, zones: DataFrame, pickup_zone: str, day: str | None = None, n: int = 1
) -> DataFrame:
    """Where trips from a zone (named in any case) go most; optionally on one day."""
    if day is not None:
        trips = trips.filter(on_day(F.col("pickup_datetime"), day))
    lookup = Lookup.measure(zones)
    origin = lookup.filter(same_text(F.col("Zone"), pickup_zone))
    # The origin is looked up first: few of the trips start there, and only those are counted.
    from_here = join_role(trips, origin, "PULocationID", "LocationID", {"Zone": "pickup_zone"})
    counted = count_by(from_here, "DOLocationID", name="zone_trips")
    named = join_role(counted, lookup, "DOLocationID", "LocationID", {"Zone": "dropoff_zone"})
    # A destination without a name counts nothing.
    named_trips = F.when(F.col("dropoff_zone").isNotNull(), F.col("zone_trips")).otherwise(0)
    ranked = named.groupBy(F.col("dropoff_zone").alias("zone")).agg(
        F.sum(named_trips).alias("trips")
    )
    return top_rows(ranked, "trips", n)


def priciest_routes(
    trips: DataFrame, zones: DataFrame, missing: str | None = None, n: int = 1
) -> DataFrame:
    """Routes with the largest average total amount."""
    pairs = trips.groupBy("PULocationID", "DOLocationID").agg(
        exact_sum(trips, "total_amount").alias("amount"),
        F.count("total_amount").alias("priced"),
    )
    lookup = Lookup.measure(zones)
    ranked = (
        _named_pairs(pairs, lookup, lookup)
        .groupBy(
            route_label(F.col("pickup_zone"), F.col("dropoff_zone"), missing).alias(
                "pickup_dropoff_pair"
            )
        )
        .agg(
            F.try_divide(
                exact_sum(pairs, "amount").cast("double"), F.sum("priced")
            ).alias("average_amount")
        )
    )
    return top_rows(ranked, "average_amount", n)


def top_pairs(
    trips: DataFrame, zones: DataFrame, missing: str | None = None, n: int = 5
) -> DataFrame:
    """The most frequent routes. The zone ids may be text, as an undeclared CSV has them."""
    pairs = count_by(trips, "PULocationID", "DOLocationID", name="pair_trips")
    lookup = Lookup.measure(zones)
    ranked = (
        _named_pairs(pairs, lookup, lookup)
        .groupBy(
            route_label(F.col("pickup_zone"), F.col("dropoff_zone"), missing).alias(
                "pickup_dropoff_pair"
            )
        )
        .agg(F.sum("pair_trips").alias("trips"))
    )
    return top_rows(ranked, "trips", n)

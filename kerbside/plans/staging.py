"""Staged feeds: keyed, deduplicated and typed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.fixed_values import NUMERIC, YELLOW_TRIP_TYPE
from kerbside.functions import (
    parse_timestamp, payment_type_description, surrogate_key, to_int, to_numeric, to_text,
)
from kerbside.operators.dedup import first_per_key
from kerbside.operators.topn import dev_sample


def stage_green(feed: DataFrame, strict: bool = True, is_test_run: bool = False) -> DataFrame:
    trip_type = _int(feed, "trip_type", strict)
    return _stage_metered(feed, "lpep", trip_type, strict, is_test_run)


def stage_yellow(feed: DataFrame, strict: bool = True, is_test_run: bool = False) -> DataFrame:
    """Same columns as green; yellow cabs are always hailed in the street."""
    return _stage_metered(feed, "tpep", F.lit(YELLOW_TRIP_TYPE), strict, is_test_run)


def _stage_metered(
    feed: DataFrame, prefix: str, trip_type: Column, strict: bool, is_test_run: bool
) -> DataFrame:
    pickup, dropoff = f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime"
    # Rows without a vendor are dropped before ranking; a missing pickup time is a key like any.
    keyed = feed.filter(F.col("vendorid").isNotNull())
    unique = first_per_key(keyed, [pickup, "vendorid"])

    def integer(name: str) -> Column:
        return _int(feed, name, strict)

    def numeric(name: str) -> Column:
        return to_numeric(F.col(name), strict)

    staged = unique.select(
        surrogate_key(F.col("vendorid"), _key_time(pickup, strict)).alias("tripid"),
        integer("vendorid").alias("vendorid"),
        integer("ratecodeid").alias("ratecodeid"),
        integer("pulocationid").alias("pickup_locationid"),
        integer("dolocationid").alias("dropoff_locationid"),
        parse_timestamp(F.col(pickup), strict).alias("pickup_datetime"),
        parse_timestamp(F.col(dropoff), strict).alias("dropoff_datetime"),
        F.col("store_and_fwd_flag").alias("store_and_fwd_flag"),
        integer("passenger_count").alias("passenger_count"),
        numeric("trip_distance").alias("trip_distance"),
        trip_type.alias("trip_type"),
        numeric("fare_amount").alias("fare_amount"),
        numeric("extra").alias("extra"),
        numeric("mta_tax").alias("mta_tax"),
        numeric("tip_amount").alias("tip_amount"),
        numeric("tolls_amount").alias("tolls_amount"),
        # The fee is never reported, whatever the feed holds.
        F.lit(0).cast(NUMERIC).alias("ehail_fee"),
        numeric("improvement_surcharge").alias("improvement_surcharge"),
        numeric("total_amount").alias("total_amount"),
        integer("payment_type").alias("payment_type"),
        payment_type_description(_code(feed, "payment_type", strict)).alias(
            "payment_type_description"
        ),
        numeric("congestion_surcharge").alias("congestion_surcharge"),
    )
    return dev_sample(staged, is_test_run)


def stage_fhv(feed: DataFrame, strict: bool = True, is_test_run: bool = False) -> DataFrame:
    keyed = feed.filter(F.col("dispatching_base_num").isNotNull())
    unique = first_per_key(keyed, ["pickup_datetime", "dispatching_base_num"])
    staged = unique.select(
        surrogate_key(
            F.col("dispatching_base_num"), _key_time("pickup_datetime", strict)
        ).alias("tripid"),
        to_text(F.col("dispatching_base_num")).alias("dispatching_base_num"),
        to_numeric(F.col("pulocationid"), strict).alias("pickup_locationid"),
        to_numeric(F.col("dolocationid"), strict).alias("dropoff_locationid"),
        parse_timestamp(F.col("pickup_datetime"), strict).alias("pickup_datetime"),
        parse_timestamp(F.col("dropoff_datetime"), strict).alias("dropoff_datetime"),
        F.col("sr_flag").alias("sr_flag"),
    )
    return dev_sample(staged, is_test_run)


def _type_of(feed: DataFrame, name: str) -> T.DataType:
    return next(f.dataType for f in feed.schema if f.name.lower() == name)


def _int(feed: DataFrame, name: str, strict: bool) -> Column:
    fractional = isinstance(_type_of(feed, name), (T.FractionalType, T.DecimalType))
    return to_int(F.col(name), strict, fractional)


def _code(feed: DataFrame, name: str, strict: bool) -> Column:
    """The code before the integer cast, so that 1.5 has no label; text is compared as a number."""
    if isinstance(_type_of(feed, name), T.StringType):
        return to_numeric(F.col(name), strict)
    return F.col(name)


def _key_time(name: str, strict: bool) -> Column:
    ntz = F.col(name).cast("timestamp_ntz") if strict else F.col(name).try_cast("timestamp_ntz")
    return ntz

"""The zone dimension and the two fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.fixed_values import FACT_TRIP_COLUMNS, STAGED_FHV_COLUMNS, UNKNOWN_BOROUGH
from kerbside.functions import relabel_service_zone
from kerbside.operators.lookups import Lookup, join_role
from kerbside.operators.unions import union_same_shape


def dim_zones(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("locationid").alias("locationid"),
        F.col("borough").alias("borough"),
        F.col("zone").alias("zone"),
        relabel_service_zone(F.col("service_zone")).alias("service_zone"),
    )


def known_zones(dim: DataFrame) -> Lookup:
    """Zones in a known borough, measured once for every role they are joined in."""
    return Lookup.measure(dim).filter(F.col("borough") != UNKNOWN_BOROUGH)


def fact_trips(green: DataFrame, yellow: DataFrame, dim: DataFrame) -> DataFrame:
    """Staged green and yellow trips between known zones, with both zones' names.

    Trip ids are unique within one service only.
    """
    trips = union_same_shape(
        green.withColumn("service_type", F.lit("Green")),
        yellow.withColumn("service_type", F.lit("Yellow")),
    )
    zones = known_zones(dim)
    for role in ("pickup", "dropoff"):
        names = {"borough": f"{role}_borough", "zone": f"{role}_zone"}
        trips = join_role(trips, zones, f"{role}_locationid", "locationid", names)
    return trips.select(*FACT_TRIP_COLUMNS)


def fact_fhv_trips(fhv: DataFrame, dim: DataFrame) -> DataFrame:
    """Staged for-hire trips between known zones; the joins only filter."""
    zones = known_zones(dim)
    for role in ("pickup", "dropoff"):
        fhv = join_role(fhv, zones, f"{role}_locationid", "locationid", {})
    return fhv.select(*STAGED_FHV_COLUMNS)

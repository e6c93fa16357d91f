"""The checks declared on the staged feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from kerbside.fixed_values import ACCEPTED_PAYMENT_TYPES
from kerbside.operators.lookups import Lookup
from kerbside.operators.quality import Check, check_model


def _keys_and_zones(dropoff_severity: str) -> list[Check]:
    return [
        Check("unique", "tripid", "warn"),
        Check("not_null", "tripid", "warn"),
        Check("relationships", "pickup_locationid", "warn"),
        Check("relationships", "dropoff_locationid", dropoff_severity),
    ]


_PAYMENT = Check("accepted_values", "payment_type", "warn", tuple(ACCEPTED_PAYMENT_TYPES))

# Only green's drop-off zone is an error; everything else warns.
DECLARED_CHECKS = {
    "stg_green_tripdata": [*_keys_and_zones("error"), _PAYMENT],
    "stg_yellow_tripdata": [*_keys_and_zones("warn"), _PAYMENT],
    "stg_fhv_tripdata": _keys_and_zones("warn"),
}


def check_report(
    models: dict[str, DataFrame], zones: DataFrame | Lookup, key: str = "locationid"
) -> DataFrame:
    """One row per declared check of the given models."""
    parent = zones if isinstance(zones, Lookup) else Lookup.measure(zones)
    reports = [
        check_model(name, df, DECLARED_CHECKS[name], parent, key) for name, df in models.items()
    ]
    return reduce(DataFrame.unionByName, reports)

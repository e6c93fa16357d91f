"""Labels for codes, zones and routes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.fixed_values import PAYMENT_LABELS, ROUTE_SEPARATOR


def payment_type_description(code: Column) -> Column:
    """Label of a payment code; an unlisted code has none."""
    labels = [F.when(code == value, F.lit(text)) for value, text in PAYMENT_LABELS.items()]
    return F.coalesce(*labels)


def relabel_service_zone(service_zone: Column) -> Column:
    return F.replace(service_zone, F.lit("Boro"), F.lit("Green"))


def route_label(pickup: Column, dropoff: Column, missing: str | None = None) -> Column:
    """``pickup / dropoff``. A NULL name gives NULL unless ``missing`` names a substitute."""
    if missing is not None:
        pickup = F.coalesce(pickup, F.lit(missing))
        dropoff = F.coalesce(dropoff, F.lit(missing))
    return F.concat(pickup, F.lit(ROUTE_SEPARATOR), dropoff)

"""Column expressions; every one stays inside Spark's own functions unless it says otherwise."""

from kerbside.functions.bases import encode_base, encode_base_pandas
from kerbside.functions.calendar import duration, duration_seconds, month_name, month_start, to_day
from kerbside.functions.casts import parse_timestamp, to_int, to_numeric, to_text
from kerbside.functions.keys import surrogate_key
from kerbside.functions.labels import payment_type_description, relabel_service_zone, route_label
from kerbside.functions.predicates import between_days, is_one_of, on_day, same_text

__all__ = [
    "between_days", "duration", "duration_seconds", "encode_base", "encode_base_pandas",
    "is_one_of", "month_name", "month_start", "on_day", "parse_timestamp",
    "payment_type_description", "relabel_service_zone", "route_label", "same_text",
    "surrogate_key", "to_day", "to_int", "to_numeric", "to_text",
]

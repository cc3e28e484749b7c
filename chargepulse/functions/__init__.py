"""Column-level functions (built-in Spark expressions only, no UDFs)."""

from chargepulse.functions.messages import (
    NOTIFY_FIELDS, REQUEST_FIELDS, TOPUP_FIELDS, CORRUPT, parse_json, message_schema,
)
from chargepulse.functions.times import (
    digits_to_ts, elapsed_ms, has_time_digits, iso_day_ok, month_span, prefix, middle,
)
from chargepulse.functions.values import (
    amount, whole_amount, when_ok, trunc_long, ratio, counter_key, month_of_year,
)

__all__ = [
    "NOTIFY_FIELDS", "REQUEST_FIELDS", "TOPUP_FIELDS", "CORRUPT", "parse_json", "message_schema",
    "digits_to_ts", "elapsed_ms", "has_time_digits", "iso_day_ok", "month_span", "prefix", "middle",
    "amount", "whole_amount", "when_ok", "trunc_long", "ratio", "counter_key", "month_of_year",
]

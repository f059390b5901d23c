"""Column-level functions: native Spark expressions only, no Python UDFs."""

from hourcast.functions.calendar import week_of_month
from hourcast.functions.labels import log_label, log_label_zero_guard
from hourcast.functions.numeric import canonical, round_doubles, trunc_to_long

__all__ = [
    "week_of_month", "log_label", "log_label_zero_guard",
    "canonical", "round_doubles", "trunc_to_long",
]

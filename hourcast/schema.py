"""Schemas and column lists of the hourly telemetry model.

``first_attempt`` / ``last_attempt`` are wall-clock timestamps without a zone
(TIMESTAMP_NTZ): the telemetry files carry local hour grids, and no operator
reads them.  ``week_of_month`` is a double so grouping keys and files carry
``5.0``.
"""

from __future__ import annotations

from pyspark.sql import types as T

SEGMENT = "carrier_id"
LABEL_RAW = "successful_charges"

# The five measures of an hourly row, in file order.
MEASURES = ["avg_response_time", "successful_charges", "no_credit", "errors", "total_attempts"]
# Measures averaged per hour (mean of response time, running sums of counts).
SUM_MEASURES = ["successful_charges", "no_credit", "errors", "total_attempts"]

HOURLY_SCHEMA = T.StructType([
    T.StructField("carrier_id", T.IntegerType(), True),
    T.StructField("datepart", T.DateType(), True),
    T.StructField("hour_of_day", T.IntegerType(), True),
    T.StructField("avg_response_time", T.DoubleType(), True),
    T.StructField("first_attempt", T.TimestampNTZType(), True),
    T.StructField("last_attempt", T.TimestampNTZType(), True),
    T.StructField("successful_charges", T.DoubleType(), True),
    T.StructField("no_credit", T.DoubleType(), True),
    T.StructField("errors", T.DoubleType(), True),
    T.StructField("total_attempts", T.DoubleType(), True),
])

# Positional feature row: eight doubles, label at index 4.
FEATURE_COLUMNS = [
    "carrier_id", "hour_of_day", "week_of_month", "avg_response_time",
    "successful_charges", "no_credit", "errors", "total_attempts",
]
FEATURE_SCHEMA = T.StructType([T.StructField(c, T.DoubleType(), True) for c in FEATURE_COLUMNS])

# The seven features left once the label (index 4) is removed, in order.
FEATURES_7 = [c for c in FEATURE_COLUMNS if c != LABEL_RAW]
# The six features of the pipeline-API tree (no segment column).
FEATURES_6 = ["hour_of_day", "week_of_month", "avg_response_time", "no_credit", "errors", "total_attempts"]

PROFILE_KEYS = ["carrier_id", "hour_of_day", "week_of_month"]

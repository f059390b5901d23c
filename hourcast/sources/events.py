"""Adapter from a raw event log to hourly telemetry rows.

The telemetry model starts from one row per segment x date x hour.  A raw
event log is reduced to that grain with a single hash aggregate: Spark runs a
partial aggregate in every scan task, so only one row per (segment, date,
hour) and task crosses the shuffle, however hot a segment is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.session import table_path

# Event types mapped to the telemetry measures.
SUCCESS_TYPES = ["purchase"]
NO_CREDIT_TYPES = ["view", "signup"]
ERROR_TYPES = ["error"]
DEFAULT_SEGMENTS = 5


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def segment_of(user_col: Column, n_segments: int = DEFAULT_SEGMENTS) -> Column:
    """0 to n_segments - 1, for negative ids too."""
    return F.pmod(user_col, F.lit(n_segments)).cast("int")


def once_per_id(events: DataFrame) -> DataFrame:
    """The log without repeats of an ``event_id``, the batch twin of ``streaming.once``; of
    repeats that differ, the first in time stays.  Events without an id are all kept."""
    others = [c for c in events.columns if c != "event_id"]
    known = events.where(F.col("event_id").isNotNull())
    # An aggregate rather than a window: repeats meet in the partial step of their task.
    first = known.groupBy("event_id").agg(F.min_by(F.struct(*others), F.struct("ts", F.xxhash64(*others))).alias("first"))
    return first.select("event_id", "first.*").select(events.columns).unionByName(events.where(F.col("event_id").isNull()))


def hourly_from_events(events: DataFrame, n_segments: int = DEFAULT_SEGMENTS,
                       segment: Column | None = None, since=None, until=None) -> DataFrame:
    """events(ts, user_id, event_type, value) -> HOURLY_SCHEMA rows.

    segment defaults to ``user_id % n_segments``; pass any column expression
    (for example a carrier column) to use another segmentation.  ``since`` /
    ``until`` (inclusive / exclusive timestamps) restrict the hours; the
    predicate is on the raw column, so it reaches the Parquet scan (row-group
    skipping, and partition pruning when the log is partitioned by time).
    """
    if since is not None:
        events = events.where(F.col("ts") >= F.lit(since))
    if until is not None:
        events = events.where(F.col("ts") < F.lit(until))
    seg = segment if segment is not None else segment_of(F.col("user_id"), n_segments)
    et = F.col("event_type")
    return (
        events
        .groupBy(
            seg.alias("carrier_id"),
            F.to_date("ts").alias("datepart"),
            F.hour("ts").alias("hour_of_day"),
        )
        .agg(
            F.avg("value").alias("avg_response_time"),
            F.min("ts").alias("first_attempt"),
            F.max("ts").alias("last_attempt"),
            F.count_if(et.isin(SUCCESS_TYPES)).cast("double").alias("successful_charges"),
            F.count_if(et.isin(NO_CREDIT_TYPES)).cast("double").alias("no_credit"),
            F.count_if(et.isin(ERROR_TYPES)).cast("double").alias("errors"),
            F.count(F.lit(1)).cast("double").alias("total_attempts"),
        )
    )

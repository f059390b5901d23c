"""A profile that is continued, not rebuilt.

The state is one small table, partitioned by day: for every day, segment and hour the count and
sum of each measure.  These merge by addition, so the profile of any span of days follows from
the state alone, and a new day costs a scan of that day's events.  A day's partition is
overwritten as a whole, so merging the same day again (a replay, late events) changes nothing or
corrects it, and no other day is touched.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.operators.profile import with_week_of_month
from hourcast.schema import MEASURES, PROFILE_KEYS
from hourcast.sources.events import DEFAULT_SEGMENTS, hourly_from_events


def day_state(hourly: DataFrame) -> DataFrame:
    """Hourly rows -> mergeable state rows."""
    keys = ["datepart", *PROFILE_KEYS]
    return with_week_of_month(hourly).groupBy(*keys).agg(
        *[F.count(m).alias(f"n_{m}") for m in MEASURES], *[F.sum(m).alias(f"sum_{m}") for m in MEASURES])


def merge_days(spark: SparkSession, events: DataFrame, path: str, first: dt.date, last: dt.date | None = None,
               n_segments: int = DEFAULT_SEGMENTS) -> str:
    """The state at ``path`` with the days ``first`` to ``last`` made anew from ``events``.

    Only these days' events are read (the bounds reach the scan) and only their partitions are
    rewritten.  A day without any event keeps its partition, as there is nothing to write in its place.
    """
    start, end = dt.datetime.combine(first, dt.time()), dt.datetime.combine((last or first) + dt.timedelta(days=1), dt.time())
    fresh = day_state(hourly_from_events(events, n_segments, since=start, until=end))
    (fresh.repartition("datepart").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("datepart").parquet(path))
    return path


def profile_of(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The hourly profile of the days ``first`` to ``last`` (all by default) from the state: the
    columns of ``hourly_profile``.  Days outside are not read (partition pruning)."""
    state = spark.read.parquet(path)
    if first is not None:
        state = state.where(F.col("datepart") >= F.lit(first))
    if last is not None:
        state = state.where(F.col("datepart") <= F.lit(last))
    return state.groupBy(*PROFILE_KEYS).agg(*[F.try_divide(F.sum(f"sum_{m}"), F.sum(f"n_{m}")).alias(m) for m in MEASURES])

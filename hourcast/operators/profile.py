"""Calendar enrichment, hourly profiles and running (cumulative) profiles.

All per-segment loops of the original jobs become keys: the segment is a
grouping key of the aggregate and a partition key of the window, so one job
serves every segment.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.functions.calendar import week_of_month
from hourcast.schema import MEASURES, PROFILE_KEYS, SEGMENT, SUM_MEASURES  # noqa: F401


def with_week_of_month(hourly: DataFrame, date_col: str = "datepart") -> DataFrame:
    return hourly.withColumn("week_of_month", week_of_month(date_col))


def count_by_week(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("week_of_month").agg(F.count(F.lit(1)).alias("count"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def hourly_profile(enriched: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Mean of every measure per (segment, hour_of_day, week_of_month).

    A hash aggregate with a partial step before the shuffle; NULL measures are
    ignored by ``avg``.
    """
    keys = keys or PROFILE_KEYS
    return enriched.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in MEASURES])


def running_profile(enriched: DataFrame, segment: str = SEGMENT) -> DataFrame:
    """Running profile of hourly rows: the profile, then the window over it.

    The average comes first, with its partial step before the shuffle, so the
    window's exchange only carries profile rows: at most 24 for a (segment,
    week of month), however many months the history has.
    """
    return cumulative_profile(hourly_profile(enriched, [segment, "hour_of_day", "week_of_month"]), segment)


def cumulative_profile(profile: DataFrame, segment: str = SEGMENT) -> DataFrame:
    """Running mean of response time and running sums of the counts.

    Frame: rows from the first hour of the (segment, week) partition to the
    current hour.  All five columns share one window so Spark plans a single
    sort and a single Window operator.
    """
    w = (Window.partitionBy(segment, "week_of_month").orderBy("hour_of_day")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = {"avg_response_time": F.avg("avg_response_time").over(w)}
    running.update({m: F.sum(m).over(w) for m in SUM_MEASURES})
    return profile.select(
        segment, "hour_of_day", "week_of_month",
        *[running[m].alias(m) for m in MEASURES],
    )


def segment_filter(df: DataFrame, segment_id: int | None, segment: str = SEGMENT) -> DataFrame:
    """Rows of one segment; None stands for the rows without one."""
    return df.where(F.col(segment).eqNullSafe(F.lit(segment_id)))


def point_filter(df: DataFrame, condition: str) -> DataFrame:
    """SQL text predicate (column names resolve case-insensitively)."""
    return df.where(condition)


def union_segments(frames: list[DataFrame]) -> DataFrame:
    """Bag union of per-segment frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def of_segments(df: DataFrame, segments: DataFrame, segment: str = SEGMENT) -> DataFrame:
    """Rows of all segments that ``segments`` lists, rows without one if it lists NULL.

    The union of their frames in one plan: a semi join, which prunes the partitions of a
    table partitioned by segment.
    """
    wanted = segments.select(F.col(segment).alias("_wanted"))
    return df.join(wanted, F.col(segment).eqNullSafe(F.col("_wanted")), "left_semi")


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First n rows in a deterministic order (a top-n sort, not a full sort)."""
    return df.orderBy(*order_by).limit(n)


def first_match(df: DataFrame, condition: str, order_by: list[str]) -> DataFrame:
    """First row matching a predicate, deterministic: filter, then a top-1."""
    return df.where(condition).orderBy(*order_by).limit(1)


def project_measures(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys if keys is not None else [SEGMENT, "hour_of_day"]
    return df.select(*keys, *MEASURES)

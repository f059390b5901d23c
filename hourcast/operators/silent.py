"""Hours in which a segment sent nothing at all.

An hour without any event has no row in the hourly table, so nothing would ever score it: the
worst outage would be the one that raises no alert.  The expected hours of a segment are all hours
between the first and the last hour of the whole table (or given bounds).  Those without a row
become rows with zero counts, and as nothing was measured that a model could be given, their
features are the usual ones: the profile's means for that segment, hour and week of month, or for
that segment and hour where the profile has no such week.  The model's expectation for them is
then compared with the measured zero like any other hour's.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.operators.profile import with_week_of_month
from hourcast.schema import MEASURES, SEGMENT, SUM_MEASURES

HOUR_KEYS = [SEGMENT, "datepart", "hour_of_day"]
# The measures that are features: all but the label.
USUAL = [m for m in MEASURES if m != "successful_charges"]


def hour_start():
    return F.col("datepart").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hour_of_day"))


def expected_hours(hourly: DataFrame, since: dt.datetime | None = None, until: dt.datetime | None = None) -> DataFrame:
    """(carrier_id, datepart, hour_of_day) of every segment and hour from ``since`` to ``until``
    (both inclusive; by default the first and last hour of the table).

    The bounds are two values of a global aggregate.  A segment's days are exploded and dealt out
    before its hours are, so a long history of few segments is made by many tasks.
    """
    segments = hourly.where(F.col(SEGMENT).isNotNull()).groupBy(SEGMENT).agg(F.min(hour_start()).alias("first"), F.max(hour_start()).alias("last"))
    if since is None or until is None:
        bounds = segments.agg(F.min("first"), F.max("last")).first()
        since, until = since or bounds[0], until or bounds[1]
    if since is None or until is None or since > until:
        return segments.select(SEGMENT, F.lit(None).cast("date").alias("datepart"), F.lit(None).cast("int").alias("hour_of_day")).limit(0)
    days = segments.select(SEGMENT, F.explode(F.sequence(F.lit(since.date()), F.lit(until.date()), F.make_dt_interval(F.lit(1)))).alias("datepart"))
    hours = days.repartition(SEGMENT, "datepart").withColumn("hour_of_day", F.explode(F.sequence(F.lit(0), F.lit(23))))
    since = since.replace(minute=0, second=0, microsecond=0)
    return hours.where((hour_start() >= F.lit(since).cast("timestamp_ntz")) & (hour_start() <= F.lit(until).cast("timestamp_ntz")))


def completed_hours(hourly: DataFrame, expected: DataFrame) -> DataFrame:
    """``hourly`` with a row for each expected hour it lacks: zero counts, no response time, and
    ``is_silent``.  Rows outside the expected hours stay."""
    rows = expected.withColumn("expected", F.lit(True)).join(hourly.withColumn("measured", F.lit(True)), HOUR_KEYS, "full")
    zeros = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in SUM_MEASURES}
    return rows.withColumns(zeros).withColumn("is_silent", F.col("measured").isNull()).select(*hourly.columns, "is_silent")


def with_usual_features(rows: DataFrame, profile: DataFrame) -> DataFrame:
    """``rows`` (hourly rows with ``week_of_month``) whose silent ones, those without an attempt,
    take their features from the profile; a feature that no profile row knows stays null.

    The profile has at most 144 rows a segment; the planner broadcasts it by its measured size.
    """
    week = profile.select(SEGMENT, "hour_of_day", "week_of_month", *[F.col(m).alias(f"week_{m}") for m in USUAL])
    hour = profile.groupBy(SEGMENT, "hour_of_day").agg(*[F.avg(m).alias(f"hour_{m}") for m in USUAL])
    silent = F.col("total_attempts") == 0
    joined = (rows.withColumn("_silent", silent).join(week, [SEGMENT, "hour_of_day", "week_of_month"], "left")
              .join(hour, [SEGMENT, "hour_of_day"], "left"))
    usual = {m: F.when(F.col("_silent"), F.coalesce(f"week_{m}", f"hour_{m}")).otherwise(F.col(m)) for m in USUAL}
    return joined.withColumns(usual).select(rows.columns)


def silent_rows(hourly: DataFrame, profile: DataFrame, expected: DataFrame) -> DataFrame:
    """The silent hours alone, with week of month and usual features, ready to be scored."""
    missing = expected.join(hourly.select(HOUR_KEYS), HOUR_KEYS, "left_anti")
    nothing = {"avg_response_time": F.lit(None).cast("double")} | {c: F.lit(0.0) for c in SUM_MEASURES}
    return with_usual_features(with_week_of_month(missing.withColumns(nothing)), profile)

"""Scoring measured hours against the expected volume and raising alerts.

Per row: ``measured = floor(raw count)``, ``predicted = floor(exp(prediction))``
(after rounding to 6 decimals) and ``error_pct = 100 * (predicted - measured) / measured``.  A positive error
means fewer successes than expected.  A row alerts when the error exceeds the
threshold, or when nothing was measured although something was expected (a
total outage, +Infinity in IEEE arithmetic).  0 measured and 0 expected is no
alert.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.functions.numeric import round_half_up, trunc_to_long
from hourcast.operators.evaluate import ALERT_PCT


def score_errors(scored: DataFrame, prediction: str = "prediction", raw: str = "raw_label",
                 threshold: float = ALERT_PCT) -> DataFrame:
    measured = trunc_to_long(F.col(raw))
    # 6 decimals first: a leaf of rows that all measured 2 predicts 2, whatever the last bits of its mean.
    predicted = trunc_to_long(round_half_up(F.exp(F.col(prediction)), 6))
    out = scored.withColumns({"measured": measured, "predicted": predicted})
    err = F.try_divide((F.col("predicted") - F.col("measured")).cast("double"),
                       F.col("measured").cast("double")) * F.lit(100.0)
    out = out.withColumn("error_pct", err)
    outage = (F.col("measured") == 0) & (F.col("predicted") > 0)
    return out.withColumn("is_alert", F.coalesce(F.col("error_pct") > F.lit(threshold), F.lit(False)) | outage)


def features_text(features: list[str]) -> Column:
    """The named feature values of a row, two decimals each."""
    def cell(c):
        value = F.format_string("%.2f", round_half_up(F.col(c).cast("double"), 2))
        return F.concat(F.lit(f"{c}="), F.when(F.col(c).isNull(), F.lit("null")).otherwise(value))
    return F.concat_ws(", ", *[cell(c) for c in features])


def alert_message(features: Column | None = None) -> Column:
    """Readable alert line built from typed columns (no Python formatting)."""
    err_txt = F.when(F.col("measured") == 0, F.lit("outage")).otherwise(
        F.concat(F.floor(F.col("error_pct") + F.lit(0.5)).cast("string"), F.lit("%")))
    return F.concat(
        F.lit("[ALERT] segment "), F.col("segment").cast("string"),
        F.lit(" hour "), F.col("row_key"),
        F.lit(": measured "), F.col("measured").cast("string"),
        F.lit(", predicted "), F.col("predicted").cast("string"),
        F.lit(", error "), err_txt,
        *([] if features is None else [F.lit(" ("), features, F.lit(")")]),
    )


def alerts(scored: DataFrame, prediction: str = "prediction", raw: str = "raw_label",
           threshold: float = ALERT_PCT, features: Column | None = None) -> DataFrame:
    """Alert rows only, with the message column; ``features`` is a text for the message, see ``features_text``."""
    s = score_errors(scored, prediction, raw, threshold)
    return (s.where(F.col("is_alert"))
             .select("segment", "row_key", "measured", "predicted", "error_pct",
                     alert_message(features).alias("message")))


def incidents(alerting: DataFrame, gap: str = "1 hour") -> DataFrame:
    """Alerting hours of a segment that follow each other, as one incident each.

    ``alerting`` has segment, hour (timestamp of its start), measured and predicted.  Hours at most
    ``gap`` apart belong together (``session_window``: with the default an hour that does not alert
    ends the incident).  Result: segment, started, ended (end of the last hour), n_hours, the
    volume measured, expected and lost, and n_silent, the hours in which nothing was measured.
    """
    # A session lasts ``gap`` beyond its last row's start and takes in a row that starts right there.
    session = F.session_window("hour", gap)
    out = alerting.withColumn("hour", F.col("hour").cast("timestamp")).groupBy("segment", session).agg(
        F.min("hour").alias("started"), (F.max("hour") + F.make_dt_interval(hours=F.lit(1))).alias("ended"), F.count(F.lit(1)).alias("n_hours"),
        F.sum("measured").alias("measured"), F.sum("predicted").alias("predicted"), F.count_if(F.col("measured") == 0).alias("n_silent"))
    return out.select("segment", "started", "ended", "n_hours", "measured", "predicted", (F.col("predicted") - F.col("measured")).alias("lost"), "n_silent")

"""The hourly monitor: event stream -> closed hours -> expected volume -> alerts.

``run_monitor`` wires the streaming pieces together.  The scorer turns one
micro-batch of closed hourly rows into alert rows; two are provided:

* ``linear_scorer``: a persisted coefficient table (one row per segment) and
  the fitted scaler, joined / applied per batch;
* ``tree_scorer``: per-segment trees saved under ``root/segment=<id>``, applied
  by one join with the table of their nodes (any number of segments, one plan).

Triggers: ``available_now=True`` processes what is there and stops (replays,
scheduled runs); otherwise ``processing_time`` (e.g. "1 hour") keeps it running.
``max_files_per_trigger`` bounds a micro-batch, so a backlog is worked off in several.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.operators import features as FE
from hourcast.operators import linear as LN
from hourcast.operators import monitor as MON
from hourcast.operators import profile as P
from hourcast.operators import silent as SI
from hourcast.operators import tree as TR
from hourcast.streaming.hourly import once, read_event_stream, start_with_state_partitions, stream_hourly

Scorer = Callable[[DataFrame], DataFrame]


def _batch_rows(batch: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Closed hourly rows -> labeled feature rows (segment, row_key, label, raw_label, features).

    With a profile, silent hours take their features from it; without one they are left out,
    as there is nothing to score them by."""
    rows = P.with_week_of_month(batch)
    rows = rows.where("total_attempts > 0") if profile is None else SI.with_usual_features(rows, profile)
    return FE.labeled(FE.feature_rows(rows))


def linear_scorer(coefs: DataFrame, std: dict, model: str = "linear",
                  threshold: float = MON.ALERT_PCT, profile: DataFrame | None = None) -> Scorer:
    chosen = coefs.where(F.col("model") == model)

    def score(batch: DataFrame) -> DataFrame:
        scored = LN.score_linear(FE.apply_scaler(_batch_rows(batch, profile), std), chosen)
        return MON.alerts(scored, threshold=threshold)
    return score


def tree_scorer(spark: SparkSession, models_root: str, features: list[str] | None = None,
                threshold: float = MON.ALERT_PCT, profile: DataFrame | None = None) -> Scorer:
    features = features or FE.FEATURES_7
    trees = TR.segment_trees(spark, models_root)

    def score(batch: DataFrame) -> DataFrame:
        rows = _batch_rows(batch, profile)
        # Hours that neither segment nor profile know have no features and stay unscored.
        rows = rows.where(F.col("avg_response_time").isNotNull())
        scored = TR.score_trees(rows, trees, features, ["segment", "row_key", "label", "raw_label", *features])
        return MON.alerts(scored.where(F.col("prediction").isNotNull()), threshold=threshold,
                          features=MON.features_text(features))
    return score


def run_monitor(spark: SparkSession, events_path: str, events_schema, scorer: Scorer, alerts_path: str,
                checkpoint: str, glob: str | None = None, watermark: str = "1 hour",
                available_now: bool = True, processing_time: str = "1 hour", n_segments: int = 5,
                state_partitions: int | None = None, max_files_per_trigger: int | None = None,
                heartbeats: DataFrame | None = None, deduplicate: bool = False):
    """Start the alert stream; returns the StreamingQuery (already finished when available_now).

    ``heartbeats`` let silent hours close and be scored (give the scorer a profile);
    ``deduplicate`` counts an event that is delivered twice once."""
    events = read_event_stream(spark, events_path, events_schema, max_files_per_trigger, glob)
    hourly = stream_hourly(once(events, watermark) if deduplicate else events, n_segments=n_segments, watermark=watermark,
                           heartbeats=heartbeats)

    def write(batch: DataFrame, batch_id: int) -> None:
        # One folder per micro-batch, overwritten on replay: exactly-once alert rows.
        scorer(batch).write.mode("overwrite").parquet(f"{alerts_path}/batch_id={batch_id}")

    w = hourly.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    q = start_with_state_partitions(w, spark, state_partitions)
    if available_now:
        q.awaitTermination()
    return q

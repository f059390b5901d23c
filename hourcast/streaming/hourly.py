"""Structured Streaming: hourly telemetry from an event stream, and live alerts.

``stream_hourly`` is the streaming twin of ``hourly_from_events``: a tumbling
one-hour event-time window per segment with a watermark.  Events within the
allowed delay always count; older ones are dropped once the watermark has
moved past them (Spark filters late rows with the previous batch's watermark,
so a late row arriving in the very batch that advances the watermark may
still count).  Event time
must be a TIMESTAMP (not TIMESTAMP_NTZ) for watermarks; the session runs in
UTC, so the cast keeps the wall clock unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.sources.events import (
    DEFAULT_SEGMENTS,
    ERROR_TYPES,
    NO_CREDIT_TYPES,
    SUCCESS_TYPES,
    segment_of,
)


def read_event_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None,
                      glob: str | None = None) -> DataFrame:
    """File stream over a directory of Parquet files (``glob`` narrows the files)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def rate_heartbeats(spark: SparkSession, segments: list[int], per_second: int = 1) -> DataFrame:
    """Heartbeats of a live job: one for every segment at the start of every hour (and of the job).

    The clock is Spark's rate source; ``segments`` are the ids to expect.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    on_the_hour = (F.col("value") == 0) | (F.date_trunc("second", "timestamp") == F.date_trunc("hour", "timestamp"))
    return ticks.where(on_the_hour).select(F.col("timestamp").alias("event_time"),
                                           F.explode(F.array(*[F.lit(s).cast("int") for s in segments])).alias("carrier_id"))


def write_heartbeats(expected: DataFrame, path: str) -> str:
    """A heartbeat at the start of every expected hour (carrier_id, datepart, hour_of_day) as Parquet,
    for a replay or for a scheduler that drops such files beside the event files."""
    beat = (F.col("datepart").cast("timestamp") + F.make_dt_interval(hours=F.col("hour_of_day"))).alias("event_time")
    expected.select(beat, "carrier_id").write.mode("append").parquet(path)
    return path


def read_heartbeats(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema("event_time timestamp, carrier_id int").parquet(path)


def once(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """The event stream without repeats of an ``event_id`` (a source that delivers at least once).

    The state holds the ids of one watermark delay, not of all time: a repeat that comes later
    than ``watermark`` after the first one counts again.
    """
    timed = events.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", watermark)
    return timed.dropDuplicatesWithinWatermark(["event_id"])


def stream_hourly(events: DataFrame, n_segments: int = DEFAULT_SEGMENTS, watermark: str = "1 hour",
                  heartbeats: DataFrame | None = None) -> DataFrame:
    """events stream -> hourly rows per segment (HOURLY_SCHEMA columns).

    With ``heartbeats`` (event_time, carrier_id) every hour that has one gets a row, with zero
    counts where the segment sent nothing, and time goes on although no event comes: the watermark
    is taken over both.  Heartbeats count in no measure.
    """
    et = F.col("event_type")
    timed = "event_time" in events.columns          # the watermark is set already, see once()
    ev = events.select(
        F.col("event_time") if timed else F.col("ts").cast("timestamp").alias("event_time"), F.col("ts"),
        segment_of(F.col("user_id"), n_segments).alias("carrier_id"), et, F.col("value"), F.lit(1).alias("attempts"))
    if heartbeats is not None:
        beats = heartbeats.select("event_time", "carrier_id", F.lit(0).alias("attempts"))
        ev = ev.unionByName(beats, allowMissingColumns=True)
    if not timed:
        ev = ev.withWatermark("event_time", watermark)
    agg = ev.groupBy(F.window("event_time", "1 hour").alias("w"), "carrier_id").agg(
        F.avg("value").alias("avg_response_time"),
        F.min("ts").alias("first_attempt"),
        F.max("ts").alias("last_attempt"),
        F.count_if(et.isin(SUCCESS_TYPES)).cast("double").alias("successful_charges"),
        F.count_if(et.isin(NO_CREDIT_TYPES)).cast("double").alias("no_credit"),
        F.count_if(et.isin(ERROR_TYPES)).cast("double").alias("errors"),
        F.sum("attempts").cast("double").alias("total_attempts"),
    )
    return agg.select(
        "carrier_id",
        F.to_date(F.col("w.start")).alias("datepart"),
        F.hour(F.col("w.start")).alias("hour_of_day"),
        "avg_response_time", "first_attempt", "last_attempt",
        "successful_charges", "no_credit", "errors", "total_attempts",
    )


def start_with_state_partitions(writer, spark: SparkSession, state_partitions: int | None):
    """Start a streaming query whose state store has ``state_partitions`` partitions.

    The number is fixed when the query first starts (then kept in its
    checkpoint) and is read from the session configuration, which the query
    clones at ``start()``; the session setting is restored right after.
    """
    if not state_partitions:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, old)


def replay_to_parquet(stream_df: DataFrame, out_path: str, checkpoint: str, output_mode: str = "complete",
                      state_partitions: int | None = None) -> str:
    """Run a stream over all available input (availableNow) and keep the final table.

    Complete mode re-emits the whole (small, aggregated) result each batch; the
    batch writer overwrites the table, so the last batch leaves the final state.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    w = (stream_df.writeStream.outputMode(output_mode).foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    q = start_with_state_partitions(w, stream_df.sparkSession, state_partitions)
    q.awaitTermination()
    return out_path

from hourcast.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


def test_stream_replay_equals_batch(spark):
    stream = REGISTRY["stream_hourly_replay"](spark, SF)
    batch = REGISTRY["hourly_from_events"](spark, SF)
    assert stream.count() == batch.count()
    assert stream.exceptAll(batch.select(*stream.columns)).count() == 0


def test_watermark_drops_late_events_and_rerun_is_idempotent(spark):
    import datetime as dt

    from hourcast.session import scratch_path
    from hourcast.streaming import run_monitor

    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    src = scratch_path(spark, "t-stream-src")

    def ev(i, h, m):
        return (i, dt.datetime(2024, 1, 1, h, m), 5, "purchase", 1.0, None)

    spark.createDataFrame([ev(1, 0, 10), ev(2, 1, 10), ev(3, 2, 10), ev(4, 3, 10)], schema) \
        .coalesce(1).write.parquet(src + "/a")
    # moves the watermark on to 04:10
    spark.createDataFrame([ev(6, 5, 10)], schema).coalesce(1).write.parquet(src + "/b")
    # hours late: Spark filters late rows with the previous batch's watermark (02:10 here)
    spark.createDataFrame([ev(5, 0, 20)], schema).coalesce(1).write.parquet(src + "/c")

    out, ckpt = scratch_path(spark, "t-stream-out"), scratch_path(spark, "t-stream-ckpt")

    def run():
        return run_monitor(spark, src + "/*", spark.createDataFrame([], schema).schema, lambda b: b, out, ckpt,
                           max_files_per_trigger=1, state_partitions=2)

    run()
    rows = {r.hour_of_day: r.total_attempts for r in spark.read.parquet(out).collect()}
    assert rows[0] == 1.0          # the late event did not count
    assert 5 not in rows           # hour 5 is still open (watermark 04:10)
    n = spark.read.parquet(out).count()
    run()                          # same checkpoint, no new files: nothing new, nothing doubled
    assert spark.read.parquet(out).count() == n


def test_tree_monitor_replay_in_several_batches_equals_batch(spark):
    from pyspark.sql import functions as F

    from hourcast.operators import features as FE
    from hourcast.operators import monitor as MON
    from hourcast.operators import profile as P
    from hourcast.plans.catalog import ml_frame, saved_trees
    from hourcast.session import scratch_path
    from hourcast.sources.events import hourly_from_events
    from hourcast.operators import tree as TR
    from hourcast.streaming import run_monitor, tree_scorer

    train = ml_frame(spark, SF).where(F.col("is_train"))
    root, trees = saved_trees(spark, train, FE.FEATURES_7, "t-mt")
    events = spark.read.parquet(SF + "/events.parquet")
    src = scratch_path(spark, "t-mon-src")
    bounds = events.selectExpr("min(ts)", "min(ts) + (max(ts) - min(ts)) / 2").first()
    for i, part in enumerate([events.where(F.col("ts") < bounds[1]), events.where(F.col("ts") >= bounds[1])]):
        part.coalesce(1).write.mode("append").parquet(f"{src}/part={i}")
    out = scratch_path(spark, "t-mon-out")
    # A threshold below any error makes every closed hour an alert.
    run_monitor(spark, src + "/*", events.schema, tree_scorer(spark, root, threshold=-1000.0), out,
                scratch_path(spark, "t-mon-ck"), max_files_per_trigger=1, state_partitions=2)
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() >= 2
    last = events.agg(F.max("ts")).first()[0]
    hours = hourly_from_events(events).where(
        F.col("datepart").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hour_of_day") + 1) <= F.lit(last) - F.expr("interval 1 hour"))
    rows = FE.labeled(FE.feature_rows(P.with_week_of_month(hours)))
    scored = TR.score_trees(rows, trees, FE.FEATURES_7, ["segment", "row_key", "raw_label", *FE.FEATURES_7])
    want = MON.alerts(scored, threshold=-1000.0, features=MON.features_text(FE.FEATURES_7))
    columns = ["segment", "row_key", "measured", "predicted", "message"]
    assert got.count() == want.count() > 100
    assert got.select(columns).exceptAll(want.select(columns)).count() == 0

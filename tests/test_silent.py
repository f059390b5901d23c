"""Silent hours, batch and live, incidents, events delivered twice, the continued profile, the accuracy curve."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hourcast.operators import evaluate as EVL
from hourcast.operators import monitor as MON
from hourcast.operators import profile as P
from hourcast.operators import profile_state as PS
from hourcast.operators import silent as SI
from hourcast.session import scratch_path
from hourcast.sources.events import hourly_from_events, once_per_id
from hourcast.streaming import once, rate_heartbeats, read_event_stream, read_heartbeats, replay_to_parquet, run_monitor, stream_hourly, write_heartbeats

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event(i, day, hour, user=0, minute=5, kind="purchase", value=1.0):
    return (i, dt.datetime(2024, 1, day, hour, minute), user, kind, value, None)


def gappy(spark):
    """Two segments; segment 1 is silent from 03 to 06 on day 2, segment 0 in one hour of day 1."""
    rows, i = [], 0
    for day in (1, 2):
        for hour in range(24):
            for seg in (0, 1):
                if (seg, day) == (1, 2) and 3 <= hour < 7 or (seg, day, hour) == (0, 1, 12):
                    continue
                for k in range(3 + seg):
                    i += 1
                    rows.append(event(i, day, hour, seg, 5 + k))
    return spark.createDataFrame(rows, EVENTS)


def keys(df):
    return {(r.carrier_id, r.datepart.day, r.hour_of_day) for r in df.collect()}


SILENT = {(0, 1, 12), *((1, 2, h) for h in range(3, 7))}


def test_completed_hours_have_every_hour_once(spark):
    hourly = hourly_from_events(gappy(spark)).cache()
    full = SI.completed_hours(hourly, SI.expected_hours(hourly)).cache()
    assert full.count() == len(keys(full)) == 2 * 48
    assert keys(full.where("is_silent")) == SILENT
    assert full.where("is_silent").agg(F.sum("total_attempts"), F.count("avg_response_time")).first() == (0.0, 0)
    assert full.where("not is_silent").drop("is_silent").exceptAll(hourly).count() == 0
    longer = SI.expected_hours(hourly, until=dt.datetime(2024, 1, 3, 1))
    assert longer.count() == 2 * 50 and SI.completed_hours(hourly, SI.expected_hours(hourly, since=dt.datetime(2024, 1, 2))).count() == 48 + 47
    assert SI.expected_hours(hourly.limit(0)).count() == 0


def test_silent_rows_take_the_usual_features(spark):
    hourly = hourly_from_events(gappy(spark)).cache()
    profile = P.hourly_profile(P.with_week_of_month(hourly))
    rows = {(r.carrier_id, r.datepart.day, r.hour_of_day): r for r in SI.silent_rows(hourly, profile, SI.expected_hours(hourly)).collect()}
    assert set(rows) == SILENT
    usual = rows[1, 2, 4]
    assert (usual.successful_charges, usual.total_attempts, usual.avg_response_time) == (0.0, 4.0, 1.0)
    # A week that the profile does not know falls back on the hour, an unknown hour on nothing.
    row = hourly.where("carrier_id = 1 and hour_of_day = 4").limit(1).withColumns({c: F.lit(0.0) for c in ("total_attempts", "no_credit")})
    other = P.with_week_of_month(row).withColumn("week_of_month", F.lit(6.0))
    assert SI.with_usual_features(other, profile).first().total_attempts == 4.0
    assert SI.with_usual_features(other, profile.where("hour_of_day = 9")).first().total_attempts is None


def flat_scorer(profile, seen):
    """Expects what is usual: alerts wherever nothing was measured."""
    def score(batch):
        rows = SI.with_usual_features(P.with_week_of_month(batch), profile)
        seen.append(rows.count())
        scored = rows.select(F.col("carrier_id").alias("segment"), F.concat_ws("|", "carrier_id", "datepart", "hour_of_day").alias("row_key"),
                             F.col("successful_charges").alias("raw_label"), F.log("total_attempts").alias("prediction"))
        return MON.alerts(scored)
    return score


def test_live_gap_of_hours_alerts_like_the_batch(spark):
    events = gappy(spark)
    hourly = hourly_from_events(events).cache()
    profile = P.hourly_profile(P.with_week_of_month(hourly)).cache()
    source, beats = scratch_path(spark, "t-gap"), scratch_path(spark, "t-beats")
    out, seen = scratch_path(spark, "t-gap-out"), []
    expected = SI.expected_hours(hourly)
    # Two deliveries: the second one holds no event of segment 1 at all before 07:00.
    for n, (a, b) in enumerate([("2024-01-01", "2024-01-02"), ("2024-01-02", "2024-01-03")]):
        events.where((F.col("ts") >= a) & (F.col("ts") < b)).coalesce(1).write.mode("append").parquet(source)
        write_heartbeats(expected.where((F.col("datepart") >= a) & (F.col("datepart") < b)), beats)
        run_monitor(spark, source, events.schema, flat_scorer(profile, seen), out, scratch_path(spark, "x") if n < 0 else source + "-ck",
                    state_partitions=2, heartbeats=read_heartbeats(spark, beats))
    alerts = {tuple(map(int, (r.segment, r.row_key.split("|")[1][-2:], r.row_key.split("|")[2]))) for r in spark.read.parquet(out).collect()}
    assert alerts == SILENT
    assert sum(seen) == 2 * 46          # every hour but the last two, which the watermark keeps open


def test_without_heartbeats_nothing_changes(spark):
    events = gappy(spark)
    source = scratch_path(spark, "t-plain")
    events.coalesce(1).write.parquet(source)
    stream = stream_hourly(read_event_stream(spark, source, events.schema))
    out = replay_to_parquet(stream, scratch_path(spark, "t-plain-out"), scratch_path(spark, "t-plain-ck"), state_partitions=2)
    assert keys(spark.read.parquet(out)) == keys(hourly_from_events(events))


def test_rate_heartbeats_are_a_stream_of_all_segments(spark):
    beats = rate_heartbeats(spark, [3, 4])
    assert beats.isStreaming and dict(beats.dtypes) == {"event_time": "timestamp", "carrier_id": "int"}


def test_repeated_events_count_once(spark):
    events = gappy(spark)
    rows = events.collect()
    again = spark.createDataFrame(rows + random.Random(1).sample(rows, 60) + [event(None, 1, 1), event(None, 1, 1)], EVENTS)
    clean = spark.createDataFrame(rows + [event(None, 1, 1), event(None, 1, 1)], EVENTS)
    columns = ["carrier_id", "datepart", "hour_of_day", "total_attempts", "successful_charges"]
    assert hourly_from_events(once_per_id(again)).select(columns).exceptAll(hourly_from_events(clean).select(columns)).count() == 0
    source = scratch_path(spark, "t-twice")
    spark.createDataFrame(rows + rows[:200], EVENTS).coalesce(1).write.parquet(source)
    stream = stream_hourly(once(read_event_stream(spark, source, events.schema)))
    out = replay_to_parquet(stream, scratch_path(spark, "t-once-out"), scratch_path(spark, "t-once-ck"), state_partitions=2)
    assert spark.read.parquet(out).select(columns).exceptAll(hourly_from_events(events).select(columns)).count() == 0


def test_incidents_join_neighbouring_hours(spark):
    hours = [(0, 1, 5, 10), (0, 2, 0, 10), (0, 3, 1, 4), (0, 5, 0, 7), (1, 3, 0, 2), (1, 23, 1, 3), (1, 24, 0, 1)]
    rows = [(s, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), m, p) for s, h, m, p in hours]
    got = MON.incidents(spark.createDataFrame(rows, "segment int, hour timestamp, measured long, predicted long")).collect()
    assert sorted((r.segment, r.started.hour, (r.ended - r.started).seconds // 3600, r.n_hours, r.lost, r.n_silent) for r in got) == [
        (0, 1, 3, 3, 18, 1), (0, 5, 1, 1, 7, 1), (1, 3, 1, 1, 2, 1), (1, 23, 2, 2, 3, 1)]


def test_thirty_daily_merges_equal_one_run(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    path = scratch_path(spark, "t-state")
    for day in range(1, 31):
        PS.merge_days(spark, events, path, dt.date(2024, 1, day))
    want = P.hourly_profile(P.with_week_of_month(hourly_from_events(events)))
    rounded = lambda df: {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(sorted(want.columns)).collect()}
    assert rounded(PS.profile_of(spark, path)) == rounded(want)
    # A replay changes nothing; a corrected day is taken over; other days keep their files.
    files = lambda: {f for f in spark.read.parquet(path).inputFiles()}
    before = files()
    PS.merge_days(spark, events, path, dt.date(2024, 1, 7))
    assert rounded(PS.profile_of(spark, path)) == rounded(want)
    assert {f for f in before - files()} == {f for f in before if "datepart=2024-01-07" in f}
    PS.merge_days(spark, events.where("event_type <> 'error'"), path, dt.date(2024, 1, 7))
    day7 = PS.profile_of(spark, path, dt.date(2024, 1, 7), dt.date(2024, 1, 7))
    assert day7.agg(F.sum("errors")).first()[0] == 0.0
    plan = PS.profile_of(spark, path, dt.date(2024, 1, 7))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(datepart" in plan and "events" not in plan


def test_a_merge_reads_its_days_only(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    one = hourly_from_events(events, since=dt.datetime(2024, 1, 7), until=dt.datetime(2024, 1, 8))
    assert "GreaterThanOrEqual(ts" in one._jdf.queryExecution().executedPlan().toString()


def test_accuracy_curve_is_exact_for_small_groups_and_close_for_large_ones(spark):
    rng = random.Random(3)
    rows = [(i % 2, rng.uniform(0, 3), rng.uniform(0, 3)) for i in range(6000)] + [(0, float("-inf"), 1.0)]
    df = spark.createDataFrame(rows, "segment int, label double, prediction double").cache()
    at = [0.1, 0.15, 0.2, 0.35]
    exact = df.groupBy("segment").agg(*[F.avg(EVL.one_sided_ok(F.exp("label"), F.exp("prediction"), t)).alias(str(t)) for t in at])
    want = {(r.segment, t): r[str(t)] for r in exact.collect() for t in at}
    got = {(r.segment, r.threshold): r.accuracy_one_sided for r in EVL.accuracy_curve(df, ["segment"], at).collect()}
    assert got == pytest.approx(want, abs=1e-12)        # 3,000 rows a group are held exactly
    large = EVL.accuracy_curve(df.withColumn("segment", F.lit(0)).crossJoin(spark.range(20)).withColumn("prediction", F.col("prediction") + F.rand(1) / 100), ["segment"], at)
    whole = {t: sum(want[s, t] for s in (0, 1)) / 2 for t in at}
    assert all(abs(r.accuracy_one_sided - whole[r.threshold]) < 0.02 for r in large.collect())

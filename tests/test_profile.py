import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourcast.operators import profile as P
from hourcast.schema import MEASURES

# Recorded inputs and results that the profiles must reproduce.
F3_ROWS = [  # carrier 4, hour 19: (date, resp, success, no_credit, errors, total)
    ("2017-06-25", 1915, 553, 542291, 15127, 558432),
    ("2017-06-26", 1893, 1377, 586218, 24208, 612932),
    ("2017-06-27", 1957, 1184, 586818, 30804, 619784),
    ("2017-05-28", 1976, 409, 531172, 18259, 550716),
    ("2017-05-29", 2240, 1441, 646753, 38528, 688594),
    ("2017-05-30", 2203, 1298, 503354, 28653, 534818),
    ("2017-05-31", 2097, 1944, 521418, 21999, 547303),
]
F4_ROWS = [  # carrier 1, 2017-04-01: (hour, resp, success, no_credit, errors, total)
    (0, 913.0, 41542.0, 1497226.0, 347585.0, 1886353.0),
    (1, 1122.0, 2879.0, 1330047.0, 297464.0, 1630390.0),
    (2, 973.0, 1541.0, 1449338.0, 304554.0, 1755433.0),
]


def _hourly(spark, rows, carrier, hour=None):
    if hour is not None:
        data = [(carrier, r[0], hour, *map(float, r[1:])) for r in rows]
    else:
        data = [(carrier, "2017-04-01", r[0], *r[1:]) for r in rows]
    df = spark.createDataFrame(data, "carrier_id int, d string, hour_of_day int, " +
                               ", ".join(f"{m} double" for m in MEASURES))
    return df.withColumn("datepart", F.to_date("d")).drop("d")


def test_profile_golden(spark):
    prof = P.hourly_profile(P.with_week_of_month(_hourly(spark, F3_ROWS, 4, 19)))
    r = P.point_filter(prof, "CARRIER_id = 4 AND hour_of_day = 19 AND Week_Of_Month = 5").collect()
    assert len(r) == 1
    exp = [2040.142857142857, 1172.2857142857142, 559717.7142857143, 25368.285714285714, 587511.2857142857]
    assert [r[0][m] for m in MEASURES] == pytest.approx(exp, rel=1e-15)


def test_cumulative_golden(spark):
    prof = P.hourly_profile(P.with_week_of_month(_hourly(spark, F4_ROWS, 1)))
    got = sorted(P.cumulative_profile(prof).collect(), key=lambda r: r.hour_of_day)
    assert [r.avg_response_time for r in got] == pytest.approx([913.0, 1017.5, 1002.6666666666666])
    assert [r.successful_charges for r in got] == [41542.0, 44421.0, 45962.0]
    assert [r.no_credit for r in got] == [1497226.0, 2827273.0, 4276611.0]
    assert [r.errors for r in got] == [347585.0, 645049.0, 949603.0]
    assert [r.total_attempts for r in got] == [1886353.0, 3516743.0, 5272176.0]


def test_running_sum_at_last_hour_is_group_total(spark):
    from hourcast.plans.catalog import cumulative, profile
    cum, prof = cumulative(spark, "/root/testdata/sf0.001"), profile(spark, "/root/testdata/sf0.001")
    last = cum.groupBy("carrier_id", "week_of_month").agg(
        F.max_by("successful_charges", "hour_of_day").alias("last"))
    tot = prof.groupBy("carrier_id", "week_of_month").agg(F.sum("successful_charges").alias("tot"))
    bad = last.join(tot, ["carrier_id", "week_of_month"]).where(F.abs(F.col("last") - F.col("tot")) > 1e-9)
    assert bad.count() == 0


def test_profile_invariant_under_repartition(spark):
    from hourcast.plans.catalog import enriched
    e = enriched(spark, "/root/testdata/sf0.001")
    base = P.cumulative_profile(P.hourly_profile(e))
    ref = sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in base.collect())
    for n in (1, 7, 32):
        again = P.cumulative_profile(P.hourly_profile(e.repartition(n)))
        got = sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in again.collect())
        assert got == ref


def test_union_of_segments_equals_whole(spark):
    from hourcast.plans.catalog import cumulative
    cum = cumulative(spark, "/root/testdata/sf0.001")
    parts = [P.segment_filter(cum, s) for s in range(5)]
    assert P.union_segments(parts).count() == cum.count()


def test_preview_is_ordered(spark):
    from hourcast.plans.catalog import hourly
    rows = P.preview(hourly(spark, "/root/testdata/sf0.001"), ["carrier_id", "datepart", "hour_of_day"], 5).collect()
    keys = [(r.carrier_id, r.datepart, r.hour_of_day) for r in rows]
    assert keys == sorted(keys) and len(rows) == 5
    assert all(isinstance(r.datepart, dt.date) for r in rows)


def test_fused_running_profile_equals_composition(spark):
    from hourcast.plans.catalog import enriched
    e = enriched(spark, "/root/testdata/sf0.001")
    fused = P.running_profile(e)
    composed = P.cumulative_profile(P.hourly_profile(e))
    r = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in df.collect())
    assert fused.columns == composed.columns
    assert r(fused) == r(composed)

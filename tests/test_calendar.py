import calendar
import datetime as dt

from pyspark.sql import functions as F

from hourcast.functions.calendar import week_of_month
from hourcast.operators.profile import count_by_week, with_week_of_month


def _py_week(d: dt.date) -> int:
    weeks = calendar.Calendar(firstweekday=6).monthdayscalendar(d.year, d.month)
    return next(i + 1 for i, w in enumerate(weeks) if d.day in w)


def test_goldens(spark):
    days = ["2017-04-01", "2017-04-23", "2017-04-30", "2017-05-31", "2017-06-25"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    got = dict(df.select(F.col("d").cast("string"), week_of_month("d")).collect())
    assert got == {"2017-04-01": 1.0, "2017-04-23": 5.0, "2017-04-30": 6.0, "2017-05-31": 5.0, "2017-06-25": 5.0}


def test_three_years_against_calendar(spark):
    start = dt.date(2016, 1, 1)
    df = spark.range(1096).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    rows = df.select("d", week_of_month("d").alias("w")).collect()
    assert len(rows) == 1096
    assert all(r.w == float(_py_week(r.d)) for r in rows)
    assert all(isinstance(r.w, float) for r in rows)


def test_april_counts_by_week(spark):
    # 30 days x 4 carriers x 24 hours, generated from one id range
    ids = spark.range(30 * 4 * 24)
    grid = ids.select(
        F.date_add(F.lit(dt.date(2017, 4, 1)), (F.col("id") / 96).cast("int")).alias("datepart"),
        F.element_at(F.array(*[F.lit(c) for c in (1, 2, 4, 5)]), ((F.col("id") / 24).cast("int") % 4) + 1)
        .alias("carrier_id"),
        (F.col("id") % 24).cast("int").alias("hour_of_day"))
    got = {r.week_of_month: r["count"] for r in count_by_week(with_week_of_month(grid)).collect()}
    assert got == {1.0: 96, 2.0: 672, 3.0: 672, 4.0: 672, 5.0: 672, 6.0: 96}


def test_week_of_month_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=25, deadline=None)
    @given(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2200, 12, 31)))
    def check(d):
        got = spark.createDataFrame([(d,)], "d date").select(week_of_month("d")).first()[0]
        assert got == float(_py_week(d))
        assert 1.0 <= got <= 6.0

    check()

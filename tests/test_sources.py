import os

import pytest
from pyspark.sql import functions as F

from hourcast.schema import HOURLY_SCHEMA
from hourcast.session import scratch_path
from hourcast.sources import readers as RD
from hourcast.sources import writers as WR
from hourcast.sources.events import hourly_from_events

HEADER = ",".join(HOURLY_SCHEMA.fieldNames())
GOOD = [
    "3,2021-02-07,5,120.5,2021-02-07 05:00:01,2021-02-07 05:58:30,310.0,77.0,12.0,399.0",
    "3,2021-02-07,6,98.25,2021-02-07 06:01:00,2021-02-07 06:59:59.25,42.0,8.0,1.0,51.0",
]
BAD = [
    "x,2021-02-07,7,97.0,2021-02-07 07:00:00,2021-02-07 07:30:00,15.0,14.0,3.0,32.0",
    "3,2021-02-07,8,20.0,2021-02-07 08:00:00,2021-02-07 08:59:00,23.0,87.0,2.0",
    "3,2021-02-07,9,15.0,2021-02-07 09:00:00,2021-02-07 09:59:00,60.0,12.0,3.0,75.0,9",
    "",
]


def _write(path, lines):
    path = path.removeprefix("file:")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_malformed_rows_dropped_consistently(spark):
    path = scratch_path(spark, "t-csv")
    _write(path, [HEADER] + GOOD[:1] + BAD + GOOD[1:])
    df = RD.read_hourly_csv(spark, path)
    assert df.count() == 2
    assert len(df.collect()) == 2
    assert df.agg(F.sum("successful_charges")).first()[0] == 310.0 + 42.0
    assert df.where("hour_of_day = 6").count() == 1
    assert df.schema == HOURLY_SCHEMA


F5 = """2.0,3.0,1.0,10.5,7.0,11.0,2.0,20.0
2.0,9.0,1.0,12.25,9.0,1.25E7,4.0,1.2500013E7
2.0,14.0,2.0,8.0,0.0,5.0,1.0,6.0"""


def test_feature_csv_scientific_notation(spark):
    path = scratch_path(spark, "t-feat")
    _write(path, F5.splitlines())
    rows = RD.read_feature_csv(spark, path).orderBy("hour_of_day").collect()
    assert len(rows) == 3
    assert rows[1].total_attempts == 12500013.0
    assert rows[1].no_credit == 12500000.0


def test_feature_csv_bad_field_fails(spark):
    path = scratch_path(spark, "t-feat-bad")
    _write(path, F5.splitlines() + ["1.0,2.0,x,4.0,5.0,6.0,7.0,8.0"])
    # Pruning to one column must not hide the bad field of another one.
    with pytest.raises(Exception, match="MALFORMED"):
        RD.read_feature_csv(spark, path).select("carrier_id").collect()


def test_hourly_csv_roundtrip_keeps_values(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    h = hourly_from_events(ev)
    path = WR.write_hourly_csv(h, scratch_path(spark, "t-rt"))
    back = RD.read_hourly_csv(spark, path)
    assert back.exceptAll(h).count() == 0 and h.exceptAll(back).count() == 0


def test_hourly_adapter_counts(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    h = hourly_from_events(ev)
    tot = h.agg(F.sum("total_attempts")).first()[0]
    assert tot == ev.count()
    assert h.where("successful_charges + no_credit + errors > total_attempts").count() == 0


def test_time_window_pushdown_and_counts(spark):
    import datetime as dt
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    lo, hi = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12)
    h = hourly_from_events(ev, since=lo, until=hi)
    assert h.agg(F.sum("total_attempts")).first()[0] == ev.where((F.col("ts") >= lo) & (F.col("ts") < hi)).count()
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_alert_runs_are_idempotent(spark):
    from hourcast.sources.writers import append_alerts
    df = spark.createDataFrame([(1, "a"), (2, "b")], "segment int, message string")
    path = scratch_path(spark, "t-alerts")
    append_alerts(df, path, ["segment"], run_id="r1")
    append_alerts(df, path, ["segment"], run_id="r1")
    append_alerts(df, path, ["segment"], run_id="r2")
    assert spark.read.parquet(path).count() == 4


@pytest.mark.parametrize("bad", ["1.0,2.0,3.0,4.0,5.0,6.0,7.0", "1.0,2.0,3.0,4.0,5.0,6.0,7.0,8.0,9.0"])
def test_feature_csv_wrong_field_count_fails(spark, bad):
    path = scratch_path(spark, "t-feat-arity")
    _write(path, F5.splitlines() + [bad])
    with pytest.raises(Exception, match="MALFORMED"):
        RD.read_feature_csv(spark, path).collect()


def test_headerless_semicolon_csv(spark):
    path = scratch_path(spark, "t-semi")
    _write(path, [g.replace(",", ";") for g in GOOD] + ["3;2021-02-07;9;1.0"])
    df = RD.read_hourly_csv(spark, path, header=False, delimiter=";")
    assert sorted(r.hour_of_day for r in df.collect()) == [5, 6]


@pytest.mark.parametrize("sep", ["|", "\t", "^", ".."])
def test_any_delimiter_is_plain_text(spark, sep):
    path = scratch_path(spark, "t-sep")
    _write(path, [g.replace(",", sep) for g in GOOD] + [GOOD[0].replace(",", sep) + sep + "1"])
    df = RD.read_hourly_csv(spark, path, header=False, delimiter=sep)
    assert sorted(r.hour_of_day for r in df.collect()) == [5, 6]


def test_iso_timestamps_and_other_dates(spark):
    path = scratch_path(spark, "t-iso")
    lines = [g.replace("2021-02-07 ", "2021-02-07T").replace("3,2021-02-07,", "3,07/02/2021,") for g in GOOD]
    _write(path, lines)
    df = RD.read_hourly_csv(spark, path, header=False, timestamp_format="yyyy-MM-dd'T'HH:mm:ss[.SS]", date_format="dd/MM/yyyy")
    got = df.orderBy("hour_of_day").collect()
    assert [r.hour_of_day for r in got] == [5, 6]
    assert str(got[0].datepart) == "2021-02-07" and str(got[0].first_attempt) == "2021-02-07 05:00:01"


def test_quoted_text_with_delimiters_and_quotes(spark):
    from pyspark.sql import types as T

    schema = T.StructType().add("id", T.IntegerType()).add("note", T.StringType())
    path = scratch_path(spark, "t-quote")
    _write(path, ["id,note", '1,"a, b"', "2,plain", r'3,"x\",y"', "4,too,many", '5,"q,r",s'])
    got = {r.id: r.note for r in RD.read_hourly_csv(spark, path, schema=schema).collect()}
    assert set(got) == {1, 2, 3} and got[1] == "a, b" and got[2] == "plain"


def test_segments_of_negative_ids(spark):
    from hourcast.sources.events import segment_of

    got = spark.createDataFrame([(-3,), (-5,), (7,)], "u long").select(segment_of(F.col("u"))).collect()
    assert [r[0] for r in got] == [2, 0, 2]

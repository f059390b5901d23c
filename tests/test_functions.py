import datetime as dt

import duckdb
from pyspark.sql import functions as F

from hourcast.functions.numeric import canonical, round_half_up
from hourcast.plans.oracle import r6_sql

VALUES = [65.8265625, 2.5e-7, -2.5e-7, 1017.5, 1002.6666666666666, 0.1 + 0.2, -3.0000005, 123456.7890125, 0.0]


def test_rounding_is_identical_in_spark_and_duckdb(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "x double")
    got = [r[0] for r in df.select(round_half_up("x")).collect()]
    sql = "select " + r6_sql("x") + " from (select unnest(?::double[]) as x)"
    ref = [r[0] for r in duckdb.execute(sql, [VALUES]).fetchall()]
    assert got == ref
    # The built-in round() functions break this decimal tie differently, hence the shared formula.
    spark_round = df.select(F.round("x", 6)).first()[0]
    duck_round = duckdb.execute("select round(65.8265625::double, 6)").fetchone()[0]
    assert spark_round != duck_round


def test_canonical_text_forms(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 120000), [1.0, 2.5, 10501066.0], 1.23456789)],
        "d date, t timestamp_ntz, v array<double>, x double")
    r = canonical(df).first()
    assert r.d == "2024-01-02"
    assert r.t == "2024-01-02 03:04:05.12"
    assert r.v == "[1.000000,2.500000,10501066.000000]"
    assert r.x == 1.234568
    assert dict(canonical(df).dtypes) == {"d": "string", "t": "string", "v": "string", "x": "double"}

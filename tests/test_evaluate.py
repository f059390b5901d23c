import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from hourcast.operators import evaluate as EV

F7 = [
    (33376.07142857143, 35471.22222222225), (31080.85714285714, 35471.22222222225),
    (31079.428571428572, 46847.142857142826), (37855.78571428572, 38581.28571428558),
    (58116.72527472527, 55886.50000000005), (70710.77777777777, 71224.76033733715),
    (72712.1111111111, 74071.01098901127), (72123.22527472526, 74071.01098901127),
    (61369.071428571435, 60225.78571428575), (58914.428571428565, 61523.57142857145),
    (67002.07142857143, 69079.07142857155), (87382.51098901097, 91560.36813186834),
    (86601.42857142857, 83669.21428571438), (73542.71428571428, 76438.14285714281),
    (80630.71428571428, 83723.2857142857),
]


def test_f7_golden(spark):
    df = spark.createDataFrame(F7, "label double, prediction double")
    m = EV.metrics(df, log_space=False, one_sided_t=0.15, two_sided_t=0.15).first()
    assert m.accuracy_two_sided == pytest.approx(14 / 15)
    assert m.accuracy_one_sided == 1.0
    assert m.r2 == pytest.approx(0.9368226352144423, rel=1e-12)


def test_against_regression_evaluator(spark):
    logs = [(math.log(a), math.log(p)) for a, p in F7]
    df = spark.createDataFrame(logs, "label double, prediction double")
    m = EV.metrics(df).first()
    for name in ("rmse", "mse", "r2", "mae"):
        ref = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName=name).evaluate(df)
        assert m[name] == pytest.approx(ref, rel=1e-10)


def test_zero_cases(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 5.0), (10.0, 1.0)], "label double, prediction double")
    r = EV.metrics(df, log_space=False, one_sided_t=0.35, two_sided_t=0.15).first()
    # one-sided: (0,0) NaN -> ok, (0,5) -inf -> ok, (10,1) 0.9 > 0.35 -> wrong
    assert r.accuracy_one_sided == pytest.approx(2 / 3)
    # two-sided: only (0,0) counts
    assert r.accuracy_two_sided == pytest.approx(1 / 3)
    # relative error is against the prediction; p = 0 skipped
    assert r.mean_rel_error == pytest.approx((5 / 5 + 9 / 1) / 2)


def test_metrics_by_group(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 1.0), ("a", 2, 2.0, 1.0), ("b", 1, 3.0, 3.0)],
                               "model string, segment int, label double, prediction double")
    rows = {(r.model, r.segment): r for r in EV.metrics(df, by=["model", "segment"]).collect()}
    assert rows[("a", 2)].mse == 1.0 and rows[("b", 1)].mse == 0.0 and len(rows) == 3


def test_metrics_of_union_are_weighted_metrics_of_parts(spark):
    from hourcast.plans.catalog import linear_predictions
    p = linear_predictions(spark, "/root/testdata/sf0.001").where("model = 'linear'")
    whole = EV.metrics(p).first()
    parts = EV.metrics(p, by=["segment"]).collect()
    n = sum(r.n for r in parts)
    assert n == whole.n
    assert sum(r.mse * r.n for r in parts) / n == pytest.approx(whole.mse, rel=1e-12)
    assert sum(r.accuracy_one_sided * r.n for r in parts) / n == pytest.approx(whole.accuracy_one_sided)

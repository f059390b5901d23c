"""The elastic-net family from moments, against MLlib and against its optimality conditions."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from hourcast.operators import elastic as EN
from hourcast.operators import linear as LN

FEATS = ["a", "b", "c"]
FAMILY = [("lasso", 0.5, 1.0), ("ridge", 0.5, 0.0), ("elastic_net", 0.005, 0.2), ("plain", 0.0, 0.0), ("strong", 100.0, 1.0)]


def frame(spark, seed=1, rows=300):
    rng = np.random.default_rng(seed)
    data = []
    for seg in (0, 1):
        x = rng.normal(size=(rows, 3)) * [1, 100, 0.01] + [5, 1000, 0]
        x[:, 2] += x[:, 0] / 200                                # correlated features of very different size
        y = x @ [2.0, 0.03, -50.0 * (seg + 1)] + rng.normal(size=rows) + 10 * seg
        data += [(seg, *map(float, r), float(v)) for r, v in zip(x, y)]
    return spark.createDataFrame(data, "segment int, a double, b double, c double, label double")


def fits_of(df, family=FAMILY, features=FEATS):
    return {(r.segment, r.model): r for r in EN.elastic_fit(EN.centred_moments(df, features), len(features), family).collect()}


def test_family_equals_mllib(spark):
    df = frame(spark).cache()
    fits = fits_of(df)
    assert len(fits) == 10
    rows = VectorAssembler(inputCols=FEATS, outputCol="features").transform(df).cache()
    for (seg, name), fit in fits.items():
        model = LinearRegression(regParam=fit.reg_param, elasticNetParam=fit.elastic_net_param, maxIter=5000, tol=1e-12).fit(rows.where(F.col("segment") == seg))
        assert fit.weights == pytest.approx(model.coefficients.toArray().tolist(), rel=1e-5, abs=1e-6), name
        assert fit.intercept == pytest.approx(model.intercept, rel=1e-5)
        assert fit.rmse == pytest.approx(model.summary.rootMeanSquaredError, rel=1e-6)
        assert fit.r2 == pytest.approx(model.summary.r2, rel=1e-6, abs=1e-9)
        assert fit.num_instances == model.summary.numInstances == 300
    assert fits[0, "strong"].weights == [0.0] * 3


def test_summary_from_moments_equals_scoring(spark):
    df = frame(spark, 2).cache()
    fits = EN.elastic_fit(EN.centred_moments(df, FEATS), 3, FAMILY)
    scored = LN.score_linear(df, fits.select("model", "segment", "weights", "intercept"), FEATS)
    direct = scored.groupBy("segment", "model").agg(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2)).alias("rmse"))
    want = {(r.segment, r.model): r.rmse for r in direct.collect()}
    assert {(r.segment, r.model): r.rmse for r in fits.collect()} == pytest.approx(want, rel=1e-8)


def test_constant_columns_nulls_and_single_rows(spark):
    rows = [(0, 1.0, float(i), 2.0, 3.0 * i) for i in range(20)] + [(1, float(i), 1.0, 2.0, 5.0) for i in range(9)]
    rows += [(2, 1.0, 1.0, 1.0, 4.0), (0, None, 1.0, 1.0, 1e9), (0, 1.0, 1.0, 1.0, None), (3, None, None, None, 1.0)]
    fits = fits_of(spark.createDataFrame(rows, "segment int, a double, b double, c double, label double"), [("plain", 0.0, 0.0)])
    assert fits[0, "plain"].weights == pytest.approx([0.0, 3.0, 0.0]) and fits[0, "plain"].num_instances == 20
    assert fits[0, "plain"].rmse == pytest.approx(0.0, abs=1e-6)
    assert (fits[1, "plain"].weights, fits[1, "plain"].intercept, fits[1, "plain"].r2) == ([0.0] * 3, 5.0, None)
    assert (fits[2, "plain"].weights, fits[2, "plain"].intercept) == ([0.0] * 3, 4.0)
    assert (3, "plain") not in fits
    assert fits_of(frame(spark).limit(0)) == {}


def test_moments_are_one_aggregate(spark):
    plan = EN.centred_moments(frame(spark), FEATS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan

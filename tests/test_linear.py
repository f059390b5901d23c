import uuid

import numpy as np
import pytest
from pyspark.mllib.regression import LabeledPoint, LassoWithSGD, LinearRegressionWithSGD, RidgeRegressionWithSGD
from pyspark.sql import functions as F

from hourcast.operators import features as FE
from hourcast.operators import linear as LN

FEATS = [f"x{i}" for i in range(7)]


@pytest.fixture(scope="module")
def synthetic(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(300, 7))
    y = X @ np.array([0.5, -0.2, 0.1, 0.0, 0.3, -0.4, 0.05]) + 2.0 + rng.normal(scale=0.1, size=300)
    rows = [(i % 2, float(y[i]), *map(float, X[i])) for i in range(300)]
    return spark.createDataFrame(rows, "segment int, label double, " + ", ".join(f"{c} double" for c in FEATS))


@pytest.mark.parametrize("kind,trainer", [
    ("linear", lambda rdd: LinearRegressionWithSGD.train(rdd, iterations=100, step=0.1, intercept=True)),
    ("ridge", lambda rdd: RidgeRegressionWithSGD.train(rdd, iterations=100, step=0.1, intercept=True)),
    ("lasso", lambda rdd: LassoWithSGD.train(rdd, iterations=100, step=0.1, intercept=True)),
])
def test_gd_equals_mllib(spark, synthetic, kind, trainer):
    coefs = {r.segment: r for r in LN.gd_fit(LN.moments(synthetic, FEATS), kinds=[kind]).collect()}
    for seg in (0, 1):
        part = synthetic.where(F.col("segment") == seg).repartition(4)
        rdd = part.rdd.map(lambda r: LabeledPoint(r.label, [r[c] for c in FEATS]))
        ref = trainer(rdd)
        assert coefs[seg].intercept == pytest.approx(ref.intercept, abs=1e-9)
        assert coefs[seg].weights == pytest.approx(list(ref.weights), abs=1e-9)


def test_score_linear_and_unseen_segment(spark, synthetic):
    coefs = LN.gd_fit(LN.moments(synthetic, FEATS), kinds=["linear"])
    c0 = [r for r in coefs.collect() if r.segment == 0][0]
    extra = spark.createDataFrame([(9, 0.0, *[1.0] * 7)], synthetic.schema)
    scored = LN.score_linear(synthetic.unionByName(extra), coefs, FEATS, how="left")
    row = scored.where("segment = 0").first()
    exp = c0.intercept + sum(w * row[c] for w, c in zip(c0.weights, FEATS))
    assert row.prediction == pytest.approx(exp, rel=1e-12)
    assert scored.where("segment = 9").first().prediction is None
    assert LN.score_linear(synthetic.unionByName(extra), coefs, FEATS).where("segment = 9").count() == 0


def test_coefs_long_has_intercept(spark, synthetic):
    coefs = LN.gd_fit(LN.moments(synthetic, FEATS))
    long = LN.coefs_long(coefs, FEATS)
    assert long.count() == 3 * 2 * 8
    assert long.where("feature = 'intercept'").count() == 6


def test_scaler_matches_standard_scaler(spark, synthetic):
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    stats = FE.scaler_stats(synthetic, FEATS).first()
    vec = VectorAssembler(inputCols=FEATS, outputCol="v").transform(synthetic)
    model = StandardScaler(inputCol="v", outputCol="s", withMean=False, withStd=True).fit(vec)
    assert [stats[f"std_{c}"] for c in FEATS] == pytest.approx(list(model.std), rel=1e-12)


def test_scaler_golden_and_zero_std(spark):
    feats = ["f0", "f1", "f2", "f3", "f4", "f5", "f6"]
    x = [1.0, 23.0, 4.0, 1217.232142857143, 2.5579197000000004E7, 2144149.5714285714, 2.799661085714286E7]
    scaled = [0.6268524857806982, 3.3277992810094488, 2.8831938126240084, 1.9765211786235892,
              1.955909409254753, 1.5761758472523948, 2.100481657010176]
    stds = [a / b for a, b in zip(x, scaled)]
    df = spark.createDataFrame([tuple(x)], ", ".join(f"{c} double" for c in feats))
    got = FE.apply_scaler(df, dict(zip(feats, stds))).first()
    assert [got[c] for c in feats] == pytest.approx(scaled, rel=1e-12)
    assert list(FE.apply_scaler(df, {c: 0.0 for c in feats}).first()) == [0.0] * 7
    assert list(FE.apply_scaler(df, {c: None for c in feats}).first()) == [0.0] * 7


def test_labels_edges(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (None,), (2.0,)], "successful_charges double")
    z = [r.label for r in FE.with_label(df, "zero_guard").collect()]
    n = [r.label for r in FE.with_label(df, "null").collect()]
    assert z[:3] == [0.0, None, None] and z[3] == pytest.approx(np.log(2.0))
    assert n[:3] == [None, None, None] and n[3] == pytest.approx(np.log(2.0))


def test_hash_split_disjoint_cover_stable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("row_key"))
    a, b = FE.hash_split(df)
    assert a.count() == 671 and b.count() == 329
    assert a.join(b, "row_key").count() == 0
    a2, _ = FE.hash_split(df.repartition(7))
    assert a2.exceptAll(a).count() == 0


def test_random_split_cover(spark):
    df = spark.range(500)
    a, b = FE.random_split(df, [0.7, 0.3], 13)
    assert a.count() + b.count() == 500 and a.join(b, "id").count() == 0


def _numpy_gd(G, b, n, kind, step=0.1, iters=100, reg=0.01, tol=0.001):
    """Independent reference loop on the same moments."""
    w = np.zeros(len(b))
    w[-1] = 1.0
    it = 0
    for i in range(1, iters + 1):
        s = step / np.sqrt(i)
        g = (G @ w - b) / n
        v = w - s * g
        if kind == "ridge":
            v = w * (1 - s * reg) - s * g
        elif kind == "lasso":
            v = np.sign(v) * np.maximum(np.abs(v) - s * reg, 0.0)
        it = i
        done = i > 1 and np.linalg.norm(v - w) < tol * max(np.linalg.norm(v), 1.0)
        w = v
        if done:
            break
    return w, it


def test_gd_matches_numpy_reference(spark, synthetic):
    m = LN.moments(synthetic, FEATS).collect()
    coefs = {(r.model, r.segment): r for r in LN.gd_fit(LN.moments(synthetic, FEATS)).collect()}
    for r in m:
        G = np.array([[r[f"g{min(i, j)}_{max(i, j)}"] for j in range(8)] for i in range(8)])
        b = np.array([r[f"b{i}"] for i in range(8)])
        for kind in ("linear", "ridge", "lasso"):
            w, it = _numpy_gd(G, b, r.n, kind)
            c = coefs[(kind, r.segment)]
            assert c.iterations == it
            assert c.weights + [c.intercept] == pytest.approx(list(w), abs=1e-12)


def test_single_row_segment_and_empty_segment(spark, synthetic):
    one = spark.createDataFrame([(7, 1.5, *[0.5] * 7)], synthetic.schema)
    data = synthetic.unionByName(one)
    coefs = {(r.model, r.segment): r for r in LN.gd_fit(LN.moments(data, FEATS)).collect()}
    assert all((k, 7) in coefs for k in ("linear", "ridge", "lasso"))
    assert all(np.isfinite(coefs[("linear", 7)].weights + [coefs[("linear", 7)].intercept]))
    # a segment with no rows has no moments row, hence no model: inner scoring drops it
    empty = LN.moments(data.where("segment = 99"), FEATS)
    assert empty.count() == 0 and LN.gd_fit(empty).count() == 0


def test_scaler_refit_option(spark, synthetic):
    train, test = synthetic.where("segment = 0"), synthetic.where("segment = 1")
    _, t_fixed = FE.scale_split(train, test, FEATS)
    _, t_refit = FE.scale_split(train, test, FEATS, refit=True)
    s_train, s_test = FE.fit_scaler(train, FEATS), FE.fit_scaler(test, FEATS)
    r = test.first()
    assert t_fixed.first()["x0"] == pytest.approx(r["x0"] / s_train["x0"])
    assert t_refit.first()["x0"] == pytest.approx(r["x0"] / s_test["x0"])


def test_bucketed_scoring_shuffles_nothing(spark, synthetic, tmp_path):
    coefs = LN.gd_fit(LN.moments(synthetic, FEATS), kinds=["linear", "ridge"])
    keyed = synthetic.withColumn("row_key", F.concat_ws("-", "segment", "label"))
    extra = spark.createDataFrame([(9, 0.0, *[1.0] * 7, "unseen"), (None, 0.0, *[1.0] * 7, "none")], keyed.schema)
    given = keyed.unionByName(extra)
    name = f"t_{uuid.uuid4().hex}"
    rows = LN.bucketed_rows(given, f"{name}_rows", f"{tmp_path}/rows", buckets=6, parts=3)
    models = LN.bucketed_models(coefs, f"{name}_models", f"{tmp_path}/models", buckets=6, parts=3)
    for how in ("inner", "left"):
        scored = LN.score_bucketed(rows, models, FEATS, how)
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = LN.score_linear(given, coefs, FEATS, how).select(*scored.columns)
        assert sorted(map(str, scored.collect())) == sorted(map(str, want.collect()))
    # One segment's rows lie in several buckets.
    assert rows.where("segment = 0").select("part").distinct().count() == 3

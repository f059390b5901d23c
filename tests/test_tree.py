import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from hourcast.operators import features as FE
from hourcast.operators import tree as TR
from hourcast.session import scratch_path

FEATS = ["a", "b"]
KEEP = ["segment", "a", "b"]


def _frame(spark, segments=(0, 1), rows=200):
    data = [(s, f"{s}|{i}", float(i % 24), float(i % 7), float((i % 24) * (s + 1) + (i % 7)))
            for s in segments for i in range(rows)]
    return spark.createDataFrame(data, "segment int, row_key string, a double, b double, label double")


def _saved(spark, models, name):
    return TR.segment_trees(spark, TR.save_segment_models(models, scratch_path(spark, name)))


def _transformed(df, models):
    parts = [m.transform(df.where(F.col("segment") == s)).select(*KEEP, "prediction") for s, m in models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@pytest.mark.parametrize("segments, depth", [([3], 2), ([0, 1, 2, 3, 4], 9)])
def test_scores_equal_transform(spark, segments, depth):
    noise = F.pmod(F.xxhash64("row_key"), F.lit(1000)) / 100
    df = _frame(spark, segments, 400).withColumn("label", F.col("label") + noise).withColumn("b", noise + F.col("b"))
    models = TR.fit_segment_trees(df, FEATS, segments, max_depth=depth, max_bins=32)
    got = TR.score_trees(df, _saved(spark, models, "t-trees"), FEATS, KEEP)
    want = _transformed(df, models)
    assert got.count() == 400 * len(segments)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_two_hundred_segments(spark):
    """The same plan for many trees: one saved tree copied to 200 segments."""
    models = TR.fit_segment_trees(_frame(spark), FEATS, [1], max_depth=4, max_bins=16)
    one = _saved(spark, models, "t-many")
    many = one.withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(199))))
    df = spark.range(2000).select((F.col("id") % 200).cast("int").alias("segment"), (F.col("id") % 24).cast("double").alias("a"),
                                  (F.col("id") % 7).cast("double").alias("b"))
    got = TR.score_trees(df, many, FEATS, KEEP)
    want = models[1].transform(df).select(*KEEP, "prediction")
    assert got.count() == 2000 and got.exceptAll(want).count() == 0


@pytest.mark.parametrize("n_segments", [1, 2])
def test_unseen_segment_is_kept_and_null_feature_raises(spark, n_segments):
    segments = list(range(n_segments))
    trees = _saved(spark, TR.fit_segment_trees(_frame(spark), FEATS, segments, max_depth=3, max_bins=8), "t-edge")
    rows = spark.createDataFrame([(0, 1.0, 2.0), (77, 1.0, 2.0), (None, 1.0, 2.0)], "segment int, a double, b double")
    got = {r.segment: r.prediction for r in TR.score_trees(rows, trees, FEATS, KEEP).collect()}
    assert set(got) == {0, 77, None} and got[77] is None and got[None] is None and got[0] is not None
    bad = spark.createDataFrame([(0, None, 2.0)], "segment int, a double, b double")
    with pytest.raises(Exception, match="NULL or NaN"):
        TR.score_trees(bad, trees, FEATS, KEEP).collect()


def test_rules_are_the_leaves(spark):
    noise = F.pmod(F.xxhash64("row_key"), F.lit(1000)) / 100
    df = _frame(spark, (0, 1), 600).withColumn("label", F.col("label") + noise).withColumn("b", noise)
    models = TR.fit_segment_trees(df, FEATS, [0, 1], max_depth=9, max_bins=32)
    trees = _saved(spark, models, "t-rules")
    rules = TR.tree_rules(trees, FEATS).cache()
    for seg, m in models.items():
        tree = TR.tree_of(m)
        mine = rules.where(F.col("segment") == seg)
        assert mine.count() == (tree.numNodes + 1) // 2
        assert mine.agg(F.max("depth")).first()[0] == tree.depth == 9
    for r in rules.collect():
        assert len(r.conditions.split(" AND ")) == r.depth
        hit = df.where((F.col("segment") == r.segment) & F.expr(r.conditions)).agg(F.avg("label"), F.count("*")).first()
        if hit[1] and r.rule_id % 37 == 0:
            assert hit[0] == pytest.approx(r.prediction)


def test_single_row_segment_tree(spark):
    df = _frame(spark).unionByName(_frame(spark, (5,), 1))
    models = TR.fit_segment_trees(df, FEATS, [5], max_depth=3, max_bins=8)
    assert TR.tree_of(models[5]).numNodes == 1
    trees = _saved(spark, models, "t-single")
    assert trees.first().depth == 0
    assert TR.score_trees(df.where("segment = 5"), trees, FEATS, KEEP).first().prediction == 0.0
    assert TR.tree_rules(trees, FEATS).collect() == [(5, 0, 0, "", 0.0)]


def test_grid_equals_a_fit_for_each_candidate(spark):
    noise = F.pmod(F.xxhash64("row_key"), F.lit(1000)) / 100
    df = _frame(spark, (0, 1), 300).withColumn("label", F.col("label") + noise).withColumn("b", noise)
    depths, bins = [2, 4], [6, 16]
    report, models = TR.grid_search(spark, df, FEATS, [0, 1], scratch_path(spark, "t-grid"), depths=depths, bins=bins)
    got = {(r.segment, r.max_depth, r.max_bins): r for r in report.collect()}
    assert len(got) == 8
    fit_rows, validation = FE.hash_split(df, train_pct=80)
    rmse = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse")
    for seg in (0, 1):
        part = validation.where(F.col("segment") == seg)
        scores = {}
        for d in depths:
            for b in bins:
                pipe, _ = TR.tree_pipeline(FEATS, "label", d, b)
                scores[d, b] = rmse.evaluate(pipe.fit(fit_rows.where(F.col("segment") == seg)).transform(part))
                assert got[seg, d, b].validation_rmse == pytest.approx(scores[d, b], rel=1e-9)
                assert got[seg, d, b].n_validation == part.count()
        winner = [k[1:] for k, r in got.items() if k[0] == seg and r.is_best]
        assert winner == [min(scores, key=lambda k: (round(scores[k], 12), k))]
        best = TR.tree_of(models[seg])
        assert (best.getMaxDepth(), best.getMaxBins()) == winner[0]


def test_elastic_report_matches_training_summary(spark):
    df = _frame(spark)
    fits = TR.fit_elastic_family(df, FEATS, [0, 1])
    rep = {(r.segment, r.model): r for r in TR.elastic_report(spark, df, FEATS, fits).collect()}
    assert len(rep) == 6
    for key, (m, *_rest) in fits.items():
        s = m.summary
        assert rep[key].rmse == pytest.approx(s.rootMeanSquaredError, rel=1e-9)
        assert rep[key].r2 == pytest.approx(s.r2, rel=1e-9)
        assert rep[key].num_instances == s.numInstances
        assert rep[key].iterations == s.totalIterations


@pytest.mark.parametrize("feature, threshold", [(0, 2.5), (1, 4.5)])
def test_ties_between_splits_go_to_the_first(spark, feature, threshold):
    """b mirrors a, so ``a <= 2.5`` and ``b <= 4.5`` part the rows alike; segment 2 has no error to split."""
    data = [(s, f"{s}|{i}", float(i % 8), float(7 - i % 8), float(s == 1) * (0.1 if i % 8 < 3 else 0.7) + 0.1 * (i % 3))
            for s in (1, 3) for i in range(240)] + [(2, f"2|{i}", float(i % 8), 0.0, 0.3) for i in range(50)]
    df = spark.createDataFrame(data, "segment int, row_key string, a double, b double, label double")
    low, high = (0.2, 0.8) if feature == 0 else (0.8, 0.2)
    trees = spark.createDataFrame(
        [(s, [(0, mean, 1, 2, feature, threshold), (1, low, -1, -1, -1, None), (2, high, -1, -1, -1, None)], 1)
         for s, mean in [(1, 0.575), (2, 0.3)]],
        "segment int, nodes array<struct<id:int,prediction:double,left:int,right:int,feature:int,threshold:double>>, depth int")
    rules = TR.tree_rules(TR.settle_ties(trees, df, FEATS), FEATS).select("segment", "conditions", "prediction").collect()
    got = {(r.segment, r.conditions): r.prediction for r in rules}
    assert got == pytest.approx({(1, "a <= 2.5"): 0.2, (1, "a > 2.5"): 0.8, (2, ""): 0.3})


def test_stump_query_returns_the_rules(spark):
    from hourcast.plans.catalog import REGISTRY

    out = REGISTRY["tree_stump"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["segment", "conditions", "prediction", "n_leaves", "squared_error"]
    for segment, rows in out.toPandas().groupby("segment"):
        assert len(rows) == rows.n_leaves.iloc[0] == 2
        assert {c.split()[1] for c in rows.conditions} == {"<=", ">"} and {c.split()[0] for c in rows.conditions} <= {"hour_of_day", "week_of_month"}

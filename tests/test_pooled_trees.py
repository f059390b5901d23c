"""Trees of all segments at once, against MLlib's trees and against plain counting."""

import pytest
from pyspark.sql import functions as F

from hourcast.operators import pooled_trees as PT
from hourcast.operators import tree as TR
from hourcast.session import scratch_path

FEATS = ["a", "b", "c"]


def noisy(spark, segments=(0, 1, 2, 3, 4), rows=400):
    """Rows whose features and label never tie: three features with many values each."""
    n = F.col("id")
    unit = lambda seed: F.pmod(F.xxhash64(F.col("id"), F.col("segment"), F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    out = spark.range(rows).withColumn("segment", F.explode(F.array(*[F.lit(s) for s in segments]))).withColumns(
        {"a": F.floor(unit(1) * 24), "b": unit(2), "c": unit(3) * 10})
    label = F.sin(F.col("a") / 3) * (F.col("segment") + 1) + F.col("b") * F.col("c") + unit(4) / 5
    return out.select("segment", F.concat_ws("|", "segment", n).alias("row_key"), F.col("a").cast("double").alias("a"), "b", "c", label.alias("label"))


def scores(df, trees):
    got = TR.score_trees(df, trees.select("segment", "nodes", "depth"), FEATS, ["row_key"])
    return {r.row_key: r.prediction for r in got.collect()}


@pytest.mark.parametrize("depth, bins", [(4, 32), (3, 8)])
def test_trees_equal_mllib(spark, depth, bins):
    """Same splits, same nodes, same predictions for five segments; also where values outnumber bins."""
    df = noisy(spark).cache()
    trees = PT.fit_trees(df, FEATS, scratch_path(spark, "t-pooled"), max_depth=depth, max_bins=bins).cache()
    models = TR.fit_segment_trees(df, FEATS, [0, 1, 2, 3, 4], max_depth=depth, max_bins=bins)
    theirs = TR.segment_trees(spark, TR.save_segment_models(models, scratch_path(spark, "t-mllib")))
    mine, want = scores(df, trees), scores(df, theirs)
    assert mine.keys() == want.keys() and all(mine[k] == pytest.approx(want[k], rel=1e-12, abs=1e-12) for k in mine)
    shape = lambda t: {r.segment: [(n.left, n.right, n.feature, round(n.threshold, 9) if n.left >= 0 else None) for n in r.nodes] for r in t.collect()}
    assert shape(trees) == shape(theirs)
    assert {r.segment: r.depth for r in trees.collect()} == {r.segment: r.depth for r in theirs.collect()}
    rules = TR.tree_rules(trees.select("segment", "nodes"), FEATS)
    assert rules.count() == TR.tree_rules(theirs, FEATS).count()


def test_a_thousand_segments_take_as_many_jobs_as_five(spark):
    def jobs(segments):
        df = noisy(spark, segments, 30).cache()
        df.count()
        group = f"trees-{len(segments)}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            trees = PT.fit_trees(df, FEATS, scratch_path(spark, "t-jobs"), max_depth=2, max_bins=8)
            n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert trees.count() == len(segments)
        return n
    few, many = jobs(list(range(5))), jobs(list(range(1000)))
    assert many <= few + 8


def test_several_bins_in_one_fit_equal_fits_of_their_own(spark):
    df = noisy(spark, (0, 1), 200).cache()
    together = PT.fit_trees(df, FEATS, scratch_path(spark, "t-bins"), max_depth=3, max_bins=[5, 32])
    for b in (5, 32):
        alone = PT.fit_trees(df, FEATS, scratch_path(spark, "t-bin"), max_depth=3, max_bins=b)
        assert scores(df, together.where(F.col("max_bins") == b)) == pytest.approx(scores(df, alone), rel=1e-12)


def test_ties_constant_labels_single_rows_and_nulls(spark):
    rows = [(0, f"0|{i}", float(i % 2), float(i % 2), 1.0, float(i % 2)) for i in range(10)]        # a and b tie: a is taken
    rows += [(1, f"1|{i}", float(i), 0.0, 0.0, 7.0) for i in range(5)] + [(2, "2|0", 1.0, 2.0, 3.0, 4.0), (3, "3|0", 1.0, 2.0, 3.0, None), (None, "x", 1.0, 2.0, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "segment int, row_key string, a double, b double, c double, label double")
    trees = {r.segment: r for r in PT.fit_trees(df, FEATS, scratch_path(spark, "t-odd"), max_depth=5).collect()}
    assert set(trees) == {0, 1, 2}
    assert [(n.feature, n.threshold, n.left, n.right) for n in trees[0].nodes] == [(0, 0.5, 1, 2), (-1, None, -1, -1), (-1, None, -1, -1)]
    assert [n.prediction for n in trees[0].nodes] == pytest.approx([0.5, 0.0, 1.0])
    assert len(trees[1].nodes) == len(trees[2].nodes) == 1
    assert (trees[1].nodes[0].prediction, trees[2].nodes[0].prediction, trees[1].depth) == (7.0, 4.0, 0)
    assert PT.fit_trees(df.limit(0), FEATS, scratch_path(spark, "t-none"), max_depth=2).count() == 0


def test_thresholds_of_a_large_segment_come_from_a_sample(spark, monkeypatch):
    """Every row counts in the histograms; the sample only places the thresholds."""
    monkeypatch.setattr(PT, "SAMPLE_ROWS", 300)
    df = noisy(spark, (0,), 3000).cache()
    setup = PT.tree_setup(df, FEATS, [32], "label", "row_key").first()
    assert setup["rows"] == 3000 and 20 <= len(setup.cuts[1]) <= 31
    trees = PT.fit_trees(df, FEATS, scratch_path(spark, "t-sample"), max_depth=4)
    got = scores(df, trees)
    error = sum((r.label - got[r.row_key]) ** 2 for r in df.collect())
    models = TR.fit_segment_trees(df, FEATS, [0], max_depth=4)
    theirs = models[0].transform(df).agg(F.sum((F.col("label") - F.col("prediction")) ** 2)).first()[0]
    assert error < 1.1 * theirs


def test_grid_equals_a_fit_for_each_candidate_and_refit_is_cut(spark):
    from hourcast.operators import features as FE

    df = noisy(spark, (0, 1), 240).cache()
    report = PT.grid_search(df, FEATS, scratch_path(spark, "t-grid"), depths=[2, 4], bins=[6, 16])
    rows = {(r.segment, r.max_depth, r.max_bins): r for r in report.collect()}
    assert len(rows) == 8
    fit_rows, validation = FE.hash_split(df, train_pct=80)
    labels = {r.row_key: (r.segment, r.label) for r in validation.collect()}
    for d in (2, 4):
        for b in (6, 16):
            got = scores(validation, PT.fit_trees(fit_rows, FEATS, scratch_path(spark, "t-cand"), max_depth=d, max_bins=b))
            for seg in (0, 1):
                errors = [(y - got[k]) ** 2 for k, (s, y) in labels.items() if s == seg]
                assert rows[seg, d, b].validation_rmse == pytest.approx((sum(errors) / len(errors)) ** 0.5, rel=1e-9)
                assert rows[seg, d, b].n_validation == len(errors)
    for seg in (0, 1):
        best = [k[1:] for k, r in rows.items() if k[0] == seg and r.is_best]
        assert best == [min((k[1:] for k in rows if k[0] == seg), key=lambda k: (round(rows[(seg, *k)].validation_rmse, 9), k))]
    path = PT.save_trees(PT.refit_best(df, report, FEATS, scratch_path(spark, "t-refit")), scratch_path(spark, "t-best"))
    for r in PT.load_trees(spark, path).select("segment", "max_depth", "max_bins", "depth", PT.n_nodes().alias("n")).collect():
        assert rows[r.segment, r.max_depth, r.max_bins].is_best and r.depth <= r.max_depth
        alone = PT.fit_trees(df.where(F.col("segment") == r.segment), FEATS, scratch_path(spark, "t-one"), max_depth=r.max_depth, max_bins=r.max_bins)
        assert alone.select(F.size("nodes")).first()[0] == r.n
        part = df.where(F.col("segment") == r.segment)
        assert scores(part, PT.load_trees(spark, path)) == pytest.approx(scores(part, alone), rel=1e-12)

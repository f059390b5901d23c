"""Hard-negative mining and whitening, against brute force and SQL."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from hourcast.llm import hard_negatives as HN
from hourcast.llm import whitening as WH
from oracle_compare import compare

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def odd_rows(seed, n=300):
    """Few values (so ties), copies, repeated ids, other lengths, bad rows."""
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.5]) for _ in range(4)], rng.choice([1, 1, 2, 3])) for i in range(n)]
    rows += [(10, [0.5, 0.5, 0.5, 0.5], 1), rows[7], rows[7], (20, None, 1), (30, [1.0, None, 0.0, 0.0], 1), (31, [0.0] * 4, 1),
             (40, [float("nan"), 0.0, 0.0, 0.0], 2), (50, [float("inf")] * 4, 2), (None, [1.0] * 4, 1), (60, [], 1), (61, [0.5] * 4, None)]
    rows += [(1000 + i, [rng.choice([0.0, 0.5, 1.0]), 1.0], i % 2) for i in range(20)]
    return rows


# ---------------------------------------------------------------- hard negatives

def test_hard_negatives_oracle(spark):
    name = "op11_hard_negatives"
    n, problems = compare(spark, name, SF, queries()[name], oracle_sql()[name])
    assert n and not problems, problems


def brute_negatives(rows, every):
    ok = [(i, label, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, v, label in rows
          if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _, _ in ok if i % every == 0}):
        label, query = min((own, v) for i, own, v in ok if i == q)
        others = sorted((-sum(a * b for a, b in zip(v, query)), i, own) for i, own, v in ok if i != q and len(v) == len(query))
        for s, p, _ in [o for o in others if o[2] == label][:5]:
            fits = [(n, t) for t, n, own in others if own != label and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(q, p, r + 1, n, -s, -t) for r, (n, t) in enumerate(fits[:3])]
    return out


@pytest.mark.parametrize("cfg", [HN.Mining(), HN.Mining(shard_rows=30, part_anchors=7, max_pivots=5, ball_group=3)])
def test_hard_negatives_equal_brute_force(spark, cfg):
    rows = odd_rows(3)
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], VECTORS + ", slot string, shard int").repartition(5)
    got = [tuple(r) for r in HN.mine(df, F.col("vec_id") % 10 == 0, cfg).collect()]
    want = brute_negatives(rows, 10)
    assert want and sorted(got) == sorted(want)


@pytest.mark.parametrize("dim", [1, 5, 64, 130])
def test_intervals_hold_every_score(dim):
    """Also of zero vectors, equal entries, and entries of very different size."""
    rng = np.random.default_rng(dim)
    vectors = np.floor(256 * np.concatenate([rng.normal(size=(300, dim)), np.zeros((1, dim)), np.ones((1, dim)),
                                             rng.normal(size=(50, dim)) * 10.0 ** rng.integers(-2, 6, (50, 1))]))
    codes = HN.Codes(vectors)
    for query in vectors[::7]:
        least, most = codes.intervals(query)
        scores = vectors @ query
        assert (least <= scores).all() and (scores <= most).all()
    assert np.allclose(HN.rotation(dim) @ HN.rotation(dim).T, np.eye(dim))


def test_intervals_drop_candidates_of_other_clusters():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 64))
    vectors = np.floor(256 * np.repeat(centres, 50, 0) + 5 * rng.normal(size=(1000, 64)))
    codes = HN.Codes(vectors)
    least, most = codes.intervals(vectors[0])
    fifth = np.sort(vectors @ vectors[0])[-5]
    assert (most >= fifth).sum() < 500       # the others need no exact score


def test_shards_out_of_reach_are_not_visited(spark):
    """On clustered vectors an anchor visits far fewer shards than there are."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16)) * 4
    rows = [(i, (centres[i % 12] + 0.01 * rng.normal(size=16)).tolist(), i % 12) for i in range(1200)]
    cfg = HN.Mining(shard_rows=50)
    table = spark.createDataFrame(rows, VECTORS)
    dealt = HN.deal(HN.whole_vectors(table, cfg), cfg).cache()
    balls = HN.shard_balls(dealt).cache()
    n_shards = balls.count()
    assert dealt.count() == 1200 and dealt.groupBy("shard").count().agg(F.max("count")).first()[0] <= 200
    query = dealt.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "anchor_id").withColumn("part", F.lit(0))
    own = F.aggregate("vector", F.lit(0.0), lambda t, x: t + x * x)
    asked = query.withColumn("slots", F.array(F.struct((own * 0.98).alias("low"), F.lit(float("inf")).alias("high"))))
    pairs = HN.visits(asked, balls, n_shards, 1, cfg)
    assert pairs.count() < 24 * (n_shards - 1) / 4
    got = sorted(tuple(r) for r in HN.mine(table, F.col("vec_id") % 50 == 0, cfg).collect())
    assert got == sorted(brute_negatives(rows, 50))


def test_scores_beyond_float64_are_exact():
    vectors = np.array([[2.0 ** 30, 3.0], [2.0 ** 30, 2.0], [1.0, 0.0]])
    shard = HN.Shard(np.array([1, 2, 3]), np.array([1, 1, 1]), vectors)
    assert shard.scores(np.arange(3), np.array([2.0 ** 30, 1.0])).tolist() == [2 ** 60 + 3, 2 ** 60 + 2, 2 ** 30]


def test_hard_negatives_empty(spark):
    assert HN.mine(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).count() == 0


# ---------------------------------------------------------------- whitening

def brute_whitening(rows, weight="count", components=8):
    """(vec_id, component) -> (n, deviation, |whitened|, explained), from whole matrices."""
    ok = [(i, [int(np.floor(1024 * np.float64(np.float32(c)))) + 100_000 for c in v]) for i, v, _ in rows
          if v and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for dim in {len(x) for _, x in ok}:
        own = [(i, x) for i, x in ok if len(x) == dim]
        fit = np.array([x for _, x in own] if weight == "count" else sorted({tuple(x) for _, x in own}), np.int64)
        n, total = len(fit), fit.sum(0)
        centred = fit - total / n
        covariance = centred.T @ centred / n
        values, axes = np.linalg.eigh(covariance)
        kept = [k for k in range(dim)[::-1] if values[k] > 1e-12 * np.trace(covariance)][:components]
        for i, x in own:
            white = (np.array(x) - total / n) @ axes[:, kept] / np.sqrt(values[kept])
            off = sum((n * a - int(s)) ** 2 for a, s in zip(x, total))
            out += [(i, c + 1, n, off, abs(w), values[k] / np.trace(covariance)) for c, (k, w) in enumerate(zip(kept, white))]
    return out


def same_whitening(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], round(r[4], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-9, atol=1e-9)


def whitened_rows(df, **settings):
    rows = WH.whiten(df, **settings).collect()
    assert all(r.identity_error < 1e-9 for r in rows)
    return [(r.vec_id, r.component, r.n, int(r.deviation), abs(r.whitened), r.explained) for r in rows]


@pytest.mark.parametrize("weight", ["count", "one"])
@pytest.mark.parametrize("hot_share", [1000, 20])
def test_whitening_equals_whole_matrices(spark, weight, hot_share):
    """Copies (one vector holds a third of the rows), odd rows, two lengths, clashing columns."""
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=5) * [5, 4, 3, 2, 1]).tolist(), 0) for i in range(150)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(90)] + [rows[1], (None, rows[2][1], 0), (7, None, 0), (8, [], 0),
             (9, [1.0, None, 0.0, 0.0, 0.0], 0), (9, [float("nan")] * 5, 0), (9, [float("-inf")] * 5, 0)]
    rows += [(2000 + i, rng.normal(size=2).tolist(), 0) for i in range(30)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], VECTORS + ", x string, component int").repartition(4)
    got = whitened_rows(df, cfg=WH.Whitening(weight=weight), hot_share=hot_share)
    same_whitening(got, brute_whitening(rows, weight))


def test_whitening_query_equals_whole_matrices(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = queries()["op12_embedding_whitening"](spark, SF)
    types = dict(got.dtypes)
    assert (types["n"], types["deviation"], types["component"], types["whitened"]) == ("bigint", "bigint", "int", "double")
    out = got.collect()
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-4
    same_whitening([(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in out], brute_whitening(rows))
    signs = Counter()
    brute_rows = {r.vec_id: r.whitened for r in out if r.component == 1}
    x = np.stack([np.floor(1024 * np.array(v, float)) for _, v, _ in rows])
    axis = np.linalg.eigh(np.cov(x.T))[1][:, -1]
    for (i, _, _), value in zip(rows, (x - x.mean(0)) @ axis):
        signs[np.sign(value) == np.sign(brute_rows[i])] += 1
    assert len(signs) == 1                    # one sign for all rows


def test_whitening_without_a_direction(spark):
    """No rows, identical rows, one direction only."""
    assert WH.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert WH.whiten(spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)], VECTORS)).count() == 0
    line = [(i, [float(i), 2.0 * i, 0.0], 0) for i in range(6)]
    got = whitened_rows(spark.createDataFrame(line, VECTORS))
    assert [r[1] for r in got] == [1] * 6 and all(abs(r[5] - 1) < 1e-12 for r in got)


def test_deviations_beyond_a_long_are_exact():
    x = np.array([[10 ** 9, 5], [-10 ** 9, 7]], np.int64)
    own = WH.Axes(10 ** 6, np.array([123, 456], np.int64), np.eye(2), np.ones(2), 2.0)
    want = [sum((10 ** 6 * a - s) ** 2 for a, s in zip(row, (123, 456))) for row in x.tolist()]
    assert own.deviations(x) == want and max(want) > 2 ** 63

"""Per-segment linear models trained by full-batch gradient descent.

With full batches the gradient of the squared loss is ``(G w - b) / n`` with
``G = X'X`` and ``b = X'y`` (a bias column of 1.0 appended last).  One hash
aggregate therefore computes everything all iterations of all three model
kinds need: per segment ``n``, the upper triangle of ``G`` and ``b``.  Each
segment's moments are one row, and the iterations run as one JVM-side
expression on that row: nothing but the final coefficients is produced, and
the row data is scanned once instead of once per iteration.

Update rules (step ``s_i = step / sqrt(i)``, bias starts at 1.0 and is
regularised like every weight):

* linear: ``w - s_i g``
* ridge:  ``w (1 - s_i reg) - s_i g``
* lasso:  soft threshold of ``w - s_i g`` by ``s_i reg``

Iteration stops after ``max_iter`` steps or, from the second step on, when
``||w_new - w|| < tol * max(||w_new||, 1)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.schema import FEATURES_7
from hourcast.sources.writers import write_bucketed

# Optimiser defaults of the original trainer.
STEP_SIZE = 0.1
MAX_ITER = 100
REG_PARAM = 0.01
CONV_TOL = 0.001
MODEL_KINDS = ["linear", "ridge", "lasso"]


def _xcols(features: list[str]):
    return [F.col(c) for c in features] + [F.lit(1.0)]


def moments(df: DataFrame, features: list[str] | None = None, label: str = "label",
            segment: str = "segment") -> DataFrame:
    """Per segment: n, g{i}_{j} = sum(x_i x_j) for i <= j, b{i} = sum(x_i y)."""
    features = features or FEATURES_7
    xs = _xcols(features)
    d = len(xs)
    y = F.col(label)
    aggs = [F.count(F.lit(1)).cast("double").alias("n")]
    for i in range(d):
        for j in range(i, d):
            aggs.append(F.sum(xs[i] * xs[j]).alias(f"g{i}_{j}"))
    for i in range(d):
        aggs.append(F.sum(xs[i] * y).alias(f"b{i}"))
    return df.groupBy(segment).agg(*aggs)


def _sum(arr):
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def _dot(a, b):
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def _gd_step(kind, G, b, n, d, step, reg, tol):
    """One gradient step as a Column function of (state, iteration)."""
    def fn(state, it):
        w = state["w"]
        s = F.lit(step) / F.sqrt(it.cast("double"))
        grad = F.transform(F.sequence(F.lit(0), F.lit(d - 1)),
                           lambda k: (_dot(G[k], w) - b[k]) / n)
        plain = F.zip_with(w, grad, lambda wi, gi: wi - s * gi)
        ridge = F.zip_with(w, grad, lambda wi, gi: wi * (F.lit(1.0) - s * F.lit(reg)) - s * gi)
        lasso = F.transform(plain, lambda v: F.signum(v) * F.greatest(F.abs(v) - s * F.lit(reg), F.lit(0.0)))
        nw = F.when(kind == "ridge", ridge).when(kind == "lasso", lasso).otherwise(plain)

        def settle(new):
            diff = F.sqrt(_sum(F.zip_with(new, w, lambda x, y: (x - y) * (x - y))))
            norm = F.sqrt(_sum(F.transform(new, lambda x: x * x)))
            done = (it > 1) & (diff < F.lit(tol) * F.greatest(norm, F.lit(1.0)))
            return F.struct(new.alias("w"), it.alias("i"), done.alias("done"))
        # The lambda's parameter binds the new weights, so they are computed once.
        return F.when(state["done"], state).otherwise(F.get(F.transform(F.array(nw), settle), 0))
    return fn


def gd_fit(moments_df: DataFrame, n_features: int = len(FEATURES_7), kinds: list[str] | None = None,
           step: float = STEP_SIZE, max_iter: int = MAX_ITER, reg: float = REG_PARAM,
           tol: float = CONV_TOL) -> DataFrame:
    """Coefficients per (model, segment) from the moments.

    The iterations run as a Spark SQL ``aggregate`` over ``sequence(1,
    max_iter)`` on each segment's single moments row: a JVM-side expression,
    no Python worker, no driver round trip, and one row in / one row out per
    segment and model kind.
    """
    kinds = kinds or MODEL_KINDS
    d = n_features + 1
    G = F.array(*[F.array(*[F.col(f"g{min(i, j)}_{max(i, j)}") for j in range(d)]) for i in range(d)])
    b = F.array(*[F.col(f"b{i}") for i in range(d)])
    base = moments_df.where(F.col("n") > 0).select(
        "segment", F.col("n"), G.alias("G"), b.alias("b"),
        F.explode(F.array(*[F.lit(k) for k in kinds])).alias("model"))
    w0 = F.array(*([F.lit(0.0)] * (d - 1) + [F.lit(1.0)]))
    init = F.struct(w0.alias("w"), F.lit(0).alias("i"), F.lit(False).alias("done"))
    fn = _gd_step(F.col("model"), F.col("G"), F.col("b"), F.col("n"), d, step, reg, tol)
    fit = base.select("model", "segment",
                      F.aggregate(F.sequence(F.lit(1), F.lit(max_iter)), init, fn).alias("st"))
    return fit.select(
        "model", F.col("segment").cast("int").alias("segment"),
        F.col("st.i").alias("iterations"),
        F.element_at(F.col("st.w"), d).alias("intercept"),
        F.slice(F.col("st.w"), 1, d - 1).alias("weights"),
    )


def coefs_wide(coefs: DataFrame, features: list[str] | None = None) -> DataFrame:
    features = features or FEATURES_7
    return coefs.select("model", "segment", "iterations", "intercept",
                        *[F.col("weights")[i].alias(f"w_{c}") for i, c in enumerate(features)])


def coefs_long(coefs: DataFrame, features: list[str] | None = None) -> DataFrame:
    """(model, segment, feature, weight), the intercept as feature 'intercept'."""
    features = features or FEATURES_7
    names = F.array(*[F.lit(c) for c in features], F.lit("intercept"))
    vals = F.concat(F.col("weights"), F.array(F.col("intercept")))
    return coefs.select("model", "segment",
                        F.inline(F.arrays_zip(names.alias("feature"), vals.alias("weight"))))


def score_linear(df: DataFrame, coefs: DataFrame, features: list[str] | None = None,
                 how: str = "inner") -> DataFrame:
    """prediction = w . x + intercept, matched on segment (and model if several).

    ``coefs`` holds one row per (model, segment); the planner broadcasts it
    when its measured size is under the broadcast threshold and falls back to a
    shuffle join otherwise.  ``how='left'`` keeps rows of unseen segments with
    a NULL prediction.
    """
    return df.join(coefs, on="segment", how=how).withColumn("prediction", dot(features)).drop("weights", "intercept")


def dot(features: list[str] | None = None) -> Column:
    """w . x + intercept of a joined row."""
    out = F.col("intercept")
    for i, c in enumerate(features or FEATURES_7):
        out = out + F.col("weights")[i] * F.col(c)
    return out


def bucketed_rows(df: DataFrame, table: str, path: str, buckets: int, parts: int, key: str = "row_key") -> DataFrame:
    """Rows saved for scoring without an exchange, bucketed by (segment, part).

    ``part`` deals a segment's rows to ``parts`` buckets by a hash of ``key``, so a segment
    that holds a third of all rows is no single task.
    """
    rows = df.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    return write_bucketed(rows, table, path, ["segment", "part"], buckets)


def bucketed_models(coefs: DataFrame, table: str, path: str, buckets: int, parts: int) -> DataFrame:
    """The model table beside ``bucketed_rows``: each model once per part."""
    models = coefs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return write_bucketed(models, table, path, ["segment", "part"], buckets)


def score_bucketed(rows: DataFrame, models: DataFrame, features: list[str] | None = None,
                   how: str = "inner") -> DataFrame:
    """``score_linear`` on tables of the two functions above, of equal ``buckets`` and ``parts``.

    Both sides are read bucket by bucket, so neither is shuffled nor broadcast: the merge hint
    keeps the co-located join whatever the models' size is.
    """
    joined = rows.hint("merge").join(models, on=["segment", "part"], how=how)
    return joined.withColumn("prediction", dot(features)).drop("weights", "intercept", "part")

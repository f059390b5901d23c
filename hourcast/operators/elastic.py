"""Lasso, ridge and elastic net of all segments and settings from one pass of moments.

Penalised least squares needs the data only through its centred second moments: per segment the
count, the means and the covariances of the features with each other and with the label.  One
aggregate computes them (``covar_pop`` and ``var_pop`` merge centred partial results, so there is
a partial step before the shuffle and no cancellation), and each segment is one row of moments.
Coordinate descent then runs as one expression inside that row, for every setting of the family:
no fit per segment, no pass per iteration.

The objective is MLlib's: features and label are scaled to variance 1, the penalty is
``reg / std(label)``, its share ``alpha`` on the absolute values and the rest on half the squares,
and the intercept is free.  A constant feature gets weight 0; a constant label gets weights 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SWEEPS = 5000
TOLERANCE = 1e-11


def centred_moments(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """Per segment: n, means, the matrix of covariances of the features, theirs with the label, and its variance.

    Rows with a null label or feature are left out as a whole."""
    x = [F.col(c).cast("double") for c in features]
    y = F.col(label).cast("double")
    known = y.isNotNull()
    for c in x:
        known = known & c.isNotNull()
    d = len(x)
    pair = {(i, j): F.covar_pop(x[i], x[j]) for i in range(d) for j in range(i, d)}
    sums = df.where(known).groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in x]).alias("means"), F.avg(y).alias("label_mean"), F.var_pop(y).alias("label_var"),
        F.array(*[F.covar_pop(c, y) for c in x]).alias("with_label"),
        *[value.alias(f"c{i}_{j}") for (i, j), value in pair.items()])
    matrix = F.array(*[F.array(*[F.col(f"c{min(i, j)}_{max(i, j)}") for j in range(d)]) for i in range(d)])
    return sums.select("segment", "n", "means", "label_mean", "label_var", "with_label", matrix.alias("covariances"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, v: total + v)


def _descent(r: Column, c: Column, lasso: Column, ridge: Column, d: int, max_sweeps: int, tolerance: float) -> Column:
    """Weights that minimise w'Rw/2 - c'w + lasso |w| + ridge w'w/2, by sweeps over the coordinates."""
    def coordinate(w: Column, j: Column) -> Column:
        own = F.get(F.get(r, j), j)
        rest = F.get(c, j) - _dot(F.get(r, j), w) + own * F.get(w, j)
        pulled = F.signum(rest) * F.greatest(F.abs(rest) - lasso, F.lit(0.0))
        new = F.when(own > 0, pulled / (own + ridge)).otherwise(F.lit(0.0))
        # The lambda's parameter binds the new weight, so it is computed once.
        return F.get(F.transform(F.array(new), lambda v: F.transform(w, lambda old, i: F.when(i == j, v).otherwise(old))), 0)

    def sweep(state: Column, _: Column) -> Column:
        swept = F.aggregate(F.sequence(F.lit(0), F.lit(d - 1)), state["w"], coordinate)

        def settled(w: Column) -> Column:
            moved = F.array_max(F.zip_with(w, state["w"], lambda a, b: F.abs(a - b)))
            return F.struct(w.alias("w"), (moved < tolerance).alias("done"))
        return F.when(state["done"], state).otherwise(F.get(F.transform(F.array(swept), settled), 0))
    start = F.struct(F.array(*[F.lit(0.0)] * d).alias("w"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max_sweeps)), start, sweep, lambda s: s["w"])


def elastic_fit(moments: DataFrame, n_features: int, family: list[tuple[str, float, float]],
                max_sweeps: int = MAX_SWEEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per segment and setting (name, reg, alpha): model, segment, reg_param,
    elastic_net_param, weights, intercept, num_instances and the training rmse and r2, which
    follow from the moments as well."""
    settings = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(float(reg)).alias("reg_param"), F.lit(float(alpha)).alias("elastic_net_param"))
                         for name, reg, alpha in family])
    rows = moments.select("*", F.inline(settings))
    spread = F.transform(F.sequence(F.lit(0), F.lit(n_features - 1)), lambda i: F.sqrt(F.get(F.get("covariances", i), i)))
    rows = rows.withColumn("spread", spread).withColumn("label_std", F.sqrt("label_var"))
    inverse = F.transform("spread", lambda s: F.coalesce(F.try_divide(F.lit(1.0), s), F.lit(0.0)))
    rows = rows.withColumn("inverse", inverse).withColumn("y_inverse", F.coalesce(F.try_divide(F.lit(1.0), F.col("label_std")), F.lit(0.0)))
    scaled = F.transform("covariances", lambda line, i: F.zip_with(line, "inverse", lambda v, s: v * s * F.get("inverse", i)))
    rows = rows.withColumn("r", scaled).withColumn("c", F.zip_with("with_label", "inverse", lambda v, s: v * s * F.col("y_inverse")))
    penalty = F.col("reg_param") * F.col("y_inverse")
    fitted = rows.withColumn("w", _descent(F.col("r"), F.col("c"), penalty * F.col("elastic_net_param"),
                                           penalty * (F.lit(1.0) - F.col("elastic_net_param")), n_features, max_sweeps, tolerance))
    # The squared error in units of the label's variance.
    left = F.lit(1.0) - 2.0 * _dot(F.col("w"), F.col("c")) + _dot(F.col("w"), F.transform("r", lambda line: _dot(line, F.col("w"))))
    weights = F.zip_with("w", "inverse", lambda w, s: w * s * F.col("label_std"))
    out = fitted.withColumn("weights", weights).withColumn("mse", F.greatest(left, F.lit(0.0)) * F.col("label_var"))
    return out.select("model", F.col("segment").cast("int").alias("segment"), "reg_param", "elastic_net_param", "weights",
                      (F.col("label_mean") - _dot(F.col("weights"), F.col("means"))).alias("intercept"), F.col("n").alias("num_instances"),
                      F.sqrt("mse").alias("rmse"), (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("label_var"))).alias("r2"))

"""One-pass evaluation of (label, prediction) pairs.

Every metric is an aggregate expression, so a single hash aggregate computes
all of them for every group (model, segment, ...) in one scan.  Division goes
through ``try_divide`` so ANSI mode never raises; the zero cases follow IEEE
semantics of the original code (see each metric).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accuracy thresholds used by the original jobs.
ONE_SIDED_T = 0.35
TWO_SIDED_T = 0.15
ALERT_PCT = 45.0


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def one_sided_ok(actual: Column, predicted: Column, t: float) -> Column:
    """Correct unless the prediction falls short by more than t (relative).

    Over-prediction always counts as correct.  actual = 0 (NULL ratio) counts as
    correct: IEEE gives -Infinity or NaN there, neither of which exceeds t.
    """
    err = F.try_divide(actual - predicted, actual)
    return F.when(err > F.lit(t), F.lit(0.0)).otherwise(F.lit(1.0))


def two_sided_ok(actual: Column, predicted: Column, t: float) -> Column:
    """Correct iff |actual - predicted| / actual < t; actual = 0 only with predicted = 0."""
    err = F.abs(F.try_divide(actual - predicted, actual))
    return (F.when(err.isNull(), F.when(predicted == 0.0, 1.0).otherwise(0.0))
            .when(err < F.lit(t), F.lit(1.0)).otherwise(F.lit(0.0)))


def metric_columns(label: str = "label", prediction: str = "prediction", log_space: bool = True,
                   one_sided_t: float = ONE_SIDED_T, two_sided_t: float = TWO_SIDED_T) -> list[Column]:
    v, p = _c(label), _c(prediction)
    actual, predicted = (F.exp(v), F.exp(p)) if log_space else (v, p)
    sq = (v - p) * (v - p)
    n = F.count(F.lit(1))
    return [
        n.alias("n"),
        F.avg(sq).alias("mse"),
        F.sqrt(F.avg(sq)).alias("rmse"),
        F.avg(F.abs(v - p)).alias("mae"),
        # Relative to the prediction, as the original "MAE"; p = 0 rows are skipped.
        F.avg(F.try_divide(F.abs(v - p), p)).alias("mean_rel_error"),
        # Variance via Spark's stable central-moment aggregate: SS_tot = n * var_pop.
        (F.lit(1.0) - F.try_divide(F.sum(sq), F.var_pop(v) * n)).alias("r2"),
        F.avg(one_sided_ok(actual, predicted, one_sided_t)).alias("accuracy_one_sided"),
        F.avg(two_sided_ok(actual, predicted, two_sided_t)).alias("accuracy_two_sided"),
    ]


def metrics(pairs: DataFrame, by: list[str] | None = None, label: str = "label",
            prediction: str = "prediction", log_space: bool = True,
            one_sided_t: float = ONE_SIDED_T, two_sided_t: float = TWO_SIDED_T) -> DataFrame:
    cols = metric_columns(label, prediction, log_space, one_sided_t, two_sided_t)
    return pairs.groupBy(*(by or [])).agg(*cols)


# Items per level of a sketch: up to as many rows per group are held exactly, beyond that ranks are
# off by at most 0.1 % of the rows (normalised rank error at this size, 99 % confidence).
SKETCH_K = 4096


def error_sketches(scored: DataFrame, by: list[str], label: str = "label", prediction: str = "prediction", log_space: bool = True) -> DataFrame:
    """Per group a mergeable quantile sketch of the shortfall (actual - predicted) / actual.

    Sketches of other days or runs add up with ``kll_merge_agg_double``.  A row without a ratio
    (actual = 0) falls short of nothing."""
    v, p = _c(label), _c(prediction)
    actual, predicted = (F.exp(v), F.exp(p)) if log_space else (v, p)
    short = F.coalesce(F.try_divide(actual - predicted, actual), F.lit(float("-inf")))
    # The sketch takes finite values; -2^1000 lies below every threshold as well.
    return scored.groupBy(*by).agg(F.kll_sketch_agg_double(F.greatest(short, F.lit(-(2.0 ** 1000))), F.lit(SKETCH_K)).alias("errors"))


def curve_of(sketches: DataFrame, by: list[str], thresholds: list[float]) -> DataFrame:
    """(by..., threshold, accuracy_one_sided): the share of rows that fall short by no more than the threshold."""
    points = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.kll_sketch_get_rank_double("errors", F.lit(float(t))).alias("accuracy_one_sided"))
                       for t in thresholds])
    return sketches.select(*by, F.inline(points))


def accuracy_curve(scored: DataFrame, by: list[str], thresholds: list[float], **columns) -> DataFrame:
    """The accuracy at any thresholds in one pass over the rows."""
    return curve_of(error_sketches(scored, by, **columns), by, thresholds)

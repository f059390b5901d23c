"""Labels, feature rows, deterministic splits and standard scaling.

ML frames share one layout: ``segment`` (int), ``row_key`` (string),
``label`` (double, log space), ``raw_label`` (the measured count) and the
seven feature columns of ``FEATURES_7`` as doubles.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.functions.labels import log_label, log_label_zero_guard
from hourcast.schema import FEATURE_COLUMNS, FEATURES_7, LABEL_RAW, SEGMENT


def row_key(*cols: str) -> Column:
    """Stable text key of an hourly row: segment|date|hour."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def feature_rows(enriched: DataFrame) -> DataFrame:
    """Hourly rows -> the positional 8-double layout plus key columns."""
    return enriched.select(
        F.col(SEGMENT).alias("segment"),
        row_key(SEGMENT, "datepart", "hour_of_day").alias("row_key"),
        *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS],
    )


def with_label(df: DataFrame, kind: str = "zero_guard", src: str = LABEL_RAW,
               name: str = "label") -> DataFrame:
    """Add the log label.  kind: 'zero_guard' (0 -> 0.0) or 'null' (x <= 0 -> NULL)."""
    fn = log_label_zero_guard if kind == "zero_guard" else log_label
    return df.withColumn(name, fn(src))


def drop_label(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Remove the label column (index 4 of the positional row), keep the other seven in order."""
    keep = keep if keep is not None else []
    return df.select(*keep, *FEATURES_7)


def labeled(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """(segment, row_key, label, raw_label, features...) with NULL labels removed."""
    features = features or FEATURES_7
    out = with_label(df).where(F.col("label").isNotNull())
    return out.select("segment", "row_key", "label", F.col(LABEL_RAW).alias("raw_label"), *features)


def features_array(features: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in features])


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """MLlib vector column; invalid (NULL/NaN) inputs raise, as in the original job."""
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="error").transform(df)


# ---------------------------------------------------------------- splits

def hash_bucket(key: Column | str, buckets: int = 100) -> Column:
    """Bucket in [0, buckets) from the first 32 bits of md5(key).

    Unlike ``randomSplit`` the assignment depends only on the key, so it is
    stable under repartitioning, re-execution after executor loss, and across
    engines.
    """
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def hash_split(df: DataFrame, key: str = "row_key", train_pct: int = 70) -> tuple[DataFrame, DataFrame]:
    b = hash_bucket(key)
    return df.where(b < train_pct), df.where(b >= train_pct)


def with_split_flag(df: DataFrame, key: str = "row_key", train_pct: int = 70) -> DataFrame:
    return df.withColumn("is_train", hash_bucket(key) < F.lit(train_pct))


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Seeded Bernoulli split (membership depends on partitioning; use for parity only)."""
    return df.randomSplit(weights, seed)


# ---------------------------------------------------------------- scaling

def scaler_stats(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """One row: sample standard deviation of every feature, over all segments."""
    features = features or FEATURES_7
    return df.agg(*[F.stddev_samp(c).alias(f"std_{c}") for c in features])


def fit_scaler(df: DataFrame, features: list[str] | None = None) -> dict[str, float | None]:
    """The fitted scaler: one standard deviation per feature.

    A single global aggregate (partial aggregates per task, one row out); like
    MLlib's scaler models, the fitted values live on the driver, so applying
    them is a projection with literals and needs no join.
    """
    features = features or FEATURES_7
    row = scaler_stats(df, features).first()
    return {c: row[f"std_{c}"] for c in features}


def apply_scaler(df: DataFrame, std: dict[str, float | None]) -> DataFrame:
    """x / std without centering; a zero or undefined (single-row) std gives 0.0."""
    def scaled(c):
        s = std[c]
        if s is None or s == 0.0:
            return F.lit(0.0)
        return F.col(c) / F.lit(float(s))
    keep = [c for c in df.columns if c not in std]
    return df.select(*keep, *[scaled(c).alias(c) for c in std])


def scale_split(train: DataFrame, test: DataFrame, features: list[str] | None = None,
                refit: bool = False) -> tuple[DataFrame, DataFrame]:
    """Scale train by its own statistics and test by the train statistics.

    ``refit=True`` scales the test part by its own statistics instead (the
    behaviour of the original trainer, kept for parity checks).
    """
    s_train = fit_scaler(train, features)
    s_test = fit_scaler(test, features) if refit else s_train
    return apply_scaler(train, s_train), apply_scaler(test, s_test)

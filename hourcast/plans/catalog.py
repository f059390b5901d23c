"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (or files Spark derives from them in the
shared scratch folder), so its work grows with the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.functions.numeric import canonical
from hourcast import schema as S
from hourcast.operators import elastic as EN
from hourcast.operators import evaluate as EVL
from hourcast.operators import features as FE
from hourcast.operators import linear as LN
from hourcast.operators import monitor as MON
from hourcast.operators import pooled_trees as PT
from hourcast.operators import profile as P
from hourcast.operators import profile_state as PS
from hourcast.operators import silent as SI
from hourcast.operators import tree as TR
from hourcast.session import is_directory, scratch_path, table_path
from hourcast.sources import events as EV
from hourcast.sources import readers as RD
from hourcast.sources import writers as WR
from hourcast import streaming as ST

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- inputs

def segment_ids(df: DataFrame, column: str = "segment") -> list[int]:
    """Distinct segment ids (one value per segment, bounded by the segmentation), without NULL."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def persisted(spark, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a (bounded, aggregated) frame once and read it back.

    Partitioned by segment; later per-segment fits and scans prune to their own
    files and do not re-run the upstream aggregation; lineage is cut for
    executor loss.
    """
    path = WR.write_checkpoint(df, scratch_path(spark, name), partition_by=partition_by, cluster=True)
    return RD.read_parquet(spark, path)


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = EV.load_table(spark, sf_dir, "events")
    return EV.hourly_from_events(events)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.with_week_of_month(hourly(spark, sf_dir))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.hourly_profile(enriched(spark, sf_dir))


def cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.running_profile(enriched(spark, sf_dir))


# ---------------------------------------------------------------- sources

@register("hourly_from_events")
def q_hourly_from_events(spark, sf_dir):
    return canonical(hourly(spark, sf_dir))


@register("csv_roundtrip_hourly")
def q_csv_roundtrip_hourly(spark, sf_dir):
    path = WR.write_hourly_csv(hourly(spark, sf_dir), scratch_path(spark, "hourly-csv"))
    return canonical(RD.read_hourly_csv(spark, path))


@register("csv_pipe_roundtrip")
def q_csv_pipe_roundtrip(spark, sf_dir):
    """The hourly rows as text with | between fields and ISO timestamps, read back."""
    rows = hourly(spark, sf_dir)
    cells = [F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if c in ("first_attempt", "last_attempt") else F.col(c).cast("string")
             for c in S.HOURLY_SCHEMA.fieldNames()]
    path = scratch_path(spark, "hourly-pipe")
    rows.select(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in cells]).alias("value")).write.text(path)
    return canonical(RD.read_hourly_csv(spark, path, header=False, delimiter="|",
                                        timestamp_format="yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"))


@register("csv_drop_malformed")
def q_csv_drop_malformed(spark, sf_dir):
    """Good hourly lines plus derived malformed companions; only good lines survive."""
    path = scratch_path(spark, "hourly-csv-bad")
    WR.write_hourly_csv(hourly(spark, sf_dir), path + "/good")
    # Companions derived from the written text (no second scan of the events).
    header = ",".join(S.HOURLY_SCHEMA.fieldNames())
    line = F.col("value")
    bad = spark.read.text(path + "/good").where(line != F.lit(header)).select(
        F.explode(F.array(
            F.concat(F.lit("x"), line),                                   # wrong type
            F.regexp_replace(line, ",[^,]*$", ""),                         # too few fields
            F.concat(line, F.lit(",1.0")),                                 # too many fields
            F.lit(""),                                                     # empty line
        )).alias("value"))
    bad.write.mode("overwrite").text(path + "/bad")
    return canonical(RD.read_hourly_csv(spark, path + "/*"))


# ---------------------------------------------------------------- calendar, profiles

@register("week_of_month")
def q_week_of_month(spark, sf_dir):
    return canonical(enriched(spark, sf_dir).select("datepart", "week_of_month").distinct())


@register("count_by_week")
def q_count_by_week(spark, sf_dir):
    return P.count_by_week(enriched(spark, sf_dir))


@register("row_count")
def q_row_count(spark, sf_dir):
    return P.row_count(hourly(spark, sf_dir))


@register("hourly_profile")
def q_hourly_profile(spark, sf_dir):
    return canonical(profile(spark, sf_dir))


@register("incremental_profile")
def q_incremental_profile(spark, sf_dir):
    """The profile from a state that the log is merged into, a week of days after the other."""
    events = EV.load_table(spark, sf_dir, "events")
    path = scratch_path(spark, "profile-state")
    first, last = events.select(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    for offset in range(0, (last - first).days + 1 if first else 0, 7):
        PS.merge_days(spark, events, path, first + dt.timedelta(days=offset), min(last, first + dt.timedelta(days=offset + 6)))
    return canonical(PS.profile_of(spark, path))


@register("cumulative_profile")
def q_cumulative_profile(spark, sf_dir):
    return canonical(cumulative(spark, sf_dir))


@register("checkpoint_roundtrip")
def q_checkpoint_roundtrip(spark, sf_dir):
    path = WR.write_checkpoint(cumulative(spark, sf_dir), scratch_path(spark, "profile-ckpt"),
                               partition_by=["carrier_id"], cluster=True)
    back = RD.read_parquet(spark, path)
    return canonical(back.select(*P.PROFILE_KEYS, *P.MEASURES))


@register("union_segments")
def q_union_segments(spark, sf_dir):
    """The frames of all segments in one: the profile, written partitioned by segment, joined with
    the segments wanted (here all there are).  One plan for any number of segments.
    """
    path = WR.write_checkpoint(cumulative(spark, sf_dir), scratch_path(spark, "profile-seg"),
                               partition_by=["carrier_id"], cluster=True)
    back = RD.read_parquet(spark, path).select(*P.PROFILE_KEYS, *P.MEASURES)
    return canonical(P.of_segments(back, back.select("carrier_id").distinct()))


# ---------------------------------------------------------------- projections, filters, preview

@register("preview_first_rows")
def q_preview_first_rows(spark, sf_dir):
    """show(5) made deterministic: a top-5 by key (TakeOrderedAndProject, no full sort)."""
    return canonical(P.preview(hourly(spark, sf_dir), ["carrier_id", "datepart", "hour_of_day"], 5))


@register("first_match_row")
def q_first_match_row(spark, sf_dir):
    """First hourly row of segment 1 with an error, in (date, hour) order."""
    m = P.first_match(hourly(spark, sf_dir), "carrier_id = 1 AND errors > 0", ["datepart", "hour_of_day"])
    return canonical(m)


@register("project_measures")
def q_project_measures(spark, sf_dir):
    return canonical(P.project_measures(hourly(spark, sf_dir)))


@register("segment_filter")
def q_segment_filter(spark, sf_dir):
    return canonical(P.segment_filter(cumulative(spark, sf_dir), 1))


@register("point_filter_raw")
def q_point_filter_raw(spark, sf_dir):
    e = enriched(spark, sf_dir)
    out = P.point_filter(e, "carrier_id = 2 AND Hour_Of_Day = 11 AND week_of_MONTH = 3")
    return canonical(out.select("carrier_id", "datepart", "hour_of_day", "week_of_month", *P.MEASURES))


@register("point_filter_profile")
def q_point_filter_profile(spark, sf_dir):
    return canonical(P.point_filter(profile(spark, sf_dir),
                                        "carrier_id = 2 AND Hour_Of_Day = 11 AND week_of_MONTH = 3"))


# ---------------------------------------------------------------- labels and features

def features(spark, sf_dir):
    return FE.feature_rows(enriched(spark, sf_dir))


def labeled(spark, sf_dir):
    return FE.labeled(features(spark, sf_dir))


def ml_frame(spark, sf_dir):
    """Labeled hourly feature rows with the 70/30 hash-split flag, written once.

    Every model job (scaler fit, moments, scoring) reads this small table, so
    the raw event log is scanned exactly once per job however many consumers
    follow, and a lost executor never re-runs the scan.
    """
    lab = FE.with_split_flag(labeled(spark, sf_dir))
    return persisted(spark, lab, "ml-frame", ["segment"])


def split_scaled(spark, sf_dir, frame=None):
    """Hash split 70/30, scaler fitted on the training part and applied to both."""
    frame = frame if frame is not None else ml_frame(spark, sf_dir)
    train, test = frame.where(F.col("is_train")), frame.where(~F.col("is_train"))
    return FE.scale_split(train.drop("is_train"), test.drop("is_train"))


@register("log_label_null")
def q_log_label_null(spark, sf_dir):
    f = FE.with_label(features(spark, sf_dir), kind="null")
    return canonical(f.select("segment", "row_key", "successful_charges", "label"))


@register("log_label_zero_guard")
def q_log_label_zero_guard(spark, sf_dir):
    f = FE.with_label(features(spark, sf_dir), kind="zero_guard")
    return canonical(f.select("segment", "row_key", "successful_charges", "label"))


@register("label_not_null")
def q_label_not_null(spark, sf_dir):
    f = FE.with_label(features(spark, sf_dir), kind="null")
    return canonical(f.where(F.col("label").isNotNull()).select("segment", "row_key", "label"))


@register("drop_label_project")
def q_drop_label_project(spark, sf_dir):
    return canonical(FE.drop_label(features(spark, sf_dir), keep=["row_key"]))


@register("labeled_features")
def q_labeled_features(spark, sf_dir):
    lab = labeled(spark, sf_dir)
    return canonical(lab.select("row_key", "label", FE.features_array(FE.FEATURES_7).alias("features")))


@register("assemble_features")
def q_assemble_features(spark, sf_dir):
    """VectorAssembler output, exposed as array<double> so SQL can see it."""
    from pyspark.ml.functions import vector_to_array
    e = enriched(spark, sf_dir)
    v = FE.assemble(e.select(FE.row_key("carrier_id", "datepart", "hour_of_day").alias("row_key"),
                             *S.FEATURES_6), S.FEATURES_6, "features_success")
    return canonical(v.select("row_key", vector_to_array("features_success").alias("features_success")))


@register("hash_split")
def q_hash_split(spark, sf_dir):
    f = FE.with_split_flag(features(spark, sf_dir))
    return f.groupBy("is_train").agg(F.count(F.lit(1)).alias("n_rows"))


@register("hash_split_ratios")
def q_hash_split_ratios(spark, sf_dir):
    """Sizes of the 70/30, 80/20 and 90/10 splits."""
    bucket = FE.hash_bucket("row_key")
    rows = features(spark, sf_dir).select(bucket.alias("bucket"), F.explode(F.array(F.lit(70), F.lit(80), F.lit(90))).alias("train_pct"))
    return rows.groupBy("train_pct").agg(F.count_if(F.col("bucket") < F.col("train_pct")).alias("n_train"),
                                         F.count_if(F.col("bucket") >= F.col("train_pct")).alias("n_test"))


@register("random_split_cover")
def q_random_split_cover(spark, sf_dir):
    """Seeded 70/30 Bernoulli split: the parts are disjoint and together cover the input.

    Membership depends on partitioning, so the check is on the cover: total
    rows, distinct keys and keys present in both parts.
    """
    f = features(spark, sf_dir).select("row_key")
    a, b = FE.random_split(f, [0.7, 0.3], seed=13)
    parts = a.withColumn("part", F.lit(0)).unionByName(b.withColumn("part", F.lit(1)))
    per_key = parts.groupBy("row_key").agg(F.count(F.lit(1)).alias("c"),
                                           F.countDistinct("part").alias("p"))
    return per_key.agg(F.sum("c").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                       F.count_if(F.col("p") > 1).alias("n_overlap"))


@register("scaler_stats")
def q_scaler_stats(spark, sf_dir):
    train, _ = FE.hash_split(labeled(spark, sf_dir))
    return canonical(FE.scaler_stats(train))


@register("scaler_apply")
def q_scaler_apply(spark, sf_dir):
    _, test = split_scaled(spark, sf_dir)
    return canonical(test.select("segment", "row_key", *FE.FEATURES_7))


# ---------------------------------------------------------------- linear models

def fit_coefficients(spark, train):
    """GD coefficients of all model kinds, persisted as a small model table.

    Writing the table cuts the lineage and gives the planner a measured size
    for the scoring join (broadcast below the threshold, shuffle join above).
    """
    coefs = LN.gd_fit(LN.moments(train))
    return persisted(spark, coefs, "gd-coefs")


def coefficients(spark, sf_dir):
    train, _ = split_scaled(spark, sf_dir)
    return fit_coefficients(spark, train)


def linear_predictions(spark, sf_dir):
    train, test = split_scaled(spark, sf_dir)
    return LN.score_linear(test, fit_coefficients(spark, train))


@register("moments_per_segment")
def q_moments_per_segment(spark, sf_dir):
    train, _ = split_scaled(spark, sf_dir)
    return canonical(LN.moments(train))


def _coefs_of(kind):
    def q(spark, sf_dir):
        c = coefficients(spark, sf_dir).where(F.col("model") == kind)
        return canonical(LN.coefs_wide(c))
    return q


register("linear_gd_coefs")(_coefs_of("linear"))
register("ridge_gd_coefs")(_coefs_of("ridge"))
register("lasso_gd_coefs")(_coefs_of("lasso"))


@register("linear_coefs_long")
def q_linear_coefs_long(spark, sf_dir):
    return canonical(LN.coefs_long(coefficients(spark, sf_dir)))


@register("linear_score_join")
def q_linear_score_join(spark, sf_dir):
    p = linear_predictions(spark, sf_dir)
    return canonical(p.select("model", "segment", "row_key", "label", "prediction"))


@register("bucketed_score_join")
def q_bucketed_score_join(spark, sf_dir):
    """Held-out rows and models saved as tables of equal buckets, then scored without an exchange."""
    train, test = split_scaled(spark, sf_dir)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "bucketed")
    name = "bucketed_" + path.rsplit("-", 1)[1]
    rows = LN.bucketed_rows(test, f"{name}_rows", f"{path}/rows", buckets, parts=4)
    models = LN.bucketed_models(fit_coefficients(spark, train), f"{name}_models", f"{path}/models", buckets, parts=4)
    return canonical(LN.score_bucketed(rows, models).select("model", "segment", "row_key", "label", "prediction"))


# ---------------------------------------------------------------- evaluation

@register("metrics_log_space")
def q_metrics_log_space(spark, sf_dir):
    m = EVL.metrics(linear_predictions(spark, sf_dir), by=["model"])
    return canonical(m.select("model", "n", "mse", "rmse", "mean_rel_error", "accuracy_one_sided"))


@register("metrics_per_segment")
def q_metrics_per_segment(spark, sf_dir):
    return canonical(EVL.metrics(linear_predictions(spark, sf_dir), by=["model", "segment"]))


@register("metrics_r2")
def q_metrics_r2(spark, sf_dir):
    m = EVL.metrics(linear_predictions(spark, sf_dir), by=["model"])
    return canonical(m.select("model", "n", "r2"))


@register("accuracy_one_sided")
def q_accuracy_one_sided(spark, sf_dir):
    p = linear_predictions(spark, sf_dir)
    ok = EVL.one_sided_ok(F.exp("label"), F.exp("prediction"), EVL.ONE_SIDED_T)
    return canonical(p.groupBy("model").agg(F.avg(ok).alias("accuracy_one_sided")))


@register("accuracy_thresholds")
def q_accuracy_thresholds(spark, sf_dir):
    """One-sided accuracy in percent at the stricter thresholds 0.1 and 0.2."""
    p = linear_predictions(spark, sf_dir)
    pct = lambda t: F.avg(EVL.one_sided_ok(F.exp("label"), F.exp("prediction"), t)) * 100.0
    return canonical(p.groupBy("model", "segment").agg(pct(0.1).alias("pct_at_01"), pct(0.2).alias("pct_at_02")))


@register("accuracy_curve")
def q_accuracy_curve(spark, sf_dir):
    """One-sided accuracy at seven thresholds, all read off one sketch per model and segment."""
    p = linear_predictions(spark, sf_dir)
    return canonical(EVL.accuracy_curve(p, ["model", "segment"], [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35]))


@register("accuracy_two_sided")
def q_accuracy_two_sided(spark, sf_dir):
    p = linear_predictions(spark, sf_dir)
    ok = EVL.two_sided_ok(F.exp("label"), F.exp("prediction"), EVL.TWO_SIDED_T)
    return canonical(p.groupBy("model").agg(F.avg(ok).alias("accuracy_two_sided")))


# ---------------------------------------------------------------- alerts

def linear_alert_input(spark, sf_dir):
    return linear_predictions(spark, sf_dir).where(F.col("model") == "linear")


@register("score_alerts")
def q_score_alerts(spark, sf_dir):
    """Score the held-out hours with the linear model and keep the alert rows."""
    return canonical(MON.alerts(linear_alert_input(spark, sf_dir)))


@register("outage_alerts")
def q_outage_alerts(spark, sf_dir):
    """Alerts appended to the alerts table (partitioned by segment), then the outages read back."""
    raised = MON.alerts(linear_alert_input(spark, sf_dir))
    path = WR.append_alerts(raised, scratch_path(spark, "alerts"), partition_by=["segment"])
    a = RD.read_parquet(spark, path, schema=raised.schema)  # no alert, no file
    return a.where(F.col("measured") == 0).select("segment", "row_key", "measured", "predicted", "message")


@register("alert_message")
def q_alert_message(spark, sf_dir):
    a = MON.alerts(linear_alert_input(spark, sf_dir))
    return a.select("row_key", "message")


# ---------------------------------------------------------------- silent hours

@register("completed_hours")
def q_completed_hours(spark, sf_dir):
    """Every segment and hour between the first and the last hour, silent ones with zero counts."""
    rows = persisted(spark, hourly(spark, sf_dir), "hourly")
    return canonical(SI.completed_hours(rows, SI.expected_hours(rows)).drop("first_attempt", "last_attempt"))


def batch_models(spark, sf_dir):
    """Coefficients and scaler of the linear model, trained on the training hours."""
    frame = ml_frame(spark, sf_dir)
    train = frame.where(F.col("is_train")).drop("is_train")
    std = FE.fit_scaler(train)
    return persisted(spark, LN.gd_fit(LN.moments(FE.apply_scaler(train, std))), "hour-coefs"), std


def silent_scores(spark, sf_dir):
    """Silent hours scored by the linear model with the usual features of their hour."""
    rows = persisted(spark, hourly(spark, sf_dir), "hourly")
    silent = SI.silent_rows(rows, P.hourly_profile(P.with_week_of_month(rows)), SI.expected_hours(rows))
    coefs, std = batch_models(spark, sf_dir)
    scored = LN.score_linear(FE.apply_scaler(FE.labeled(FE.feature_rows(silent)), std), coefs.where("model = 'linear'"), how="left")
    return MON.score_errors(scored)


@register("silent_hour_scores")
def q_silent_hour_scores(spark, sf_dir):
    """Every hour in which a segment sent nothing: expected volume, and whether it alerts."""
    return canonical(silent_scores(spark, sf_dir).select("segment", "row_key", "measured", "predicted", "error_pct", "is_alert"))


def key_hour():
    """The start of the hour that a row key (segment|date|hour) names."""
    part = F.split("row_key", "[|]")
    return F.to_timestamp_ntz(part[1], F.lit("yyyy-MM-dd")) + F.make_dt_interval(hours=part[2].cast("int"))


@register("incidents")
def q_incidents(spark, sf_dir):
    """Alerting hours, measured and silent ones, joined to incidents with their lost volume."""
    columns = ["segment", key_hour().alias("hour"), "measured", "predicted"]
    measured = MON.score_errors(linear_alert_input(spark, sf_dir)).where("is_alert").select(columns)
    silent = silent_scores(spark, sf_dir).where("is_alert").select(columns)
    found = MON.incidents(measured.unionByName(silent))
    return canonical(found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started", "ended")}))


def daily(spark, sf_dir):
    """Events at the grain of segment x day (hour 0), where counts are well above 1."""
    rows = enriched(spark, sf_dir).groupBy("carrier_id", "datepart", "week_of_month").agg(
        F.lit(0).alias("hour_of_day"),
        (F.sum(F.col("avg_response_time") * F.col("total_attempts")) / F.sum("total_attempts")).alias("avg_response_time"),
        *[F.sum(m).alias(m) for m in S.SUM_MEASURES])
    return FE.labeled(FE.feature_rows(rows))


def scored_days(spark, sf_dir):
    """Every held-out day, scored by its segment's tree of depth 1, and the text of its features."""
    frame = persisted(spark, FE.with_split_flag(daily(spark, sf_dir)), "daily-frame", ["segment"])
    _, trees = saved_trees(spark, frame.where("is_train"), STUMP_FEATURES, "day-trees", max_depth=1)
    test = frame.where("not is_train").withColumn("features", MON.features_text(FE.FEATURES_7))
    return TR.score_trees(test, trees, STUMP_FEATURES, ["segment", "row_key", "raw_label", "features"])


@register("score_days")
def q_score_days(spark, sf_dir):
    """All scored days, alert or not."""
    out = MON.score_errors(scored_days(spark, sf_dir))
    return canonical(out.select("segment", "row_key", "measured", "predicted", "error_pct", "is_alert"))


@register("day_alerts")
def q_day_alerts(spark, sf_dir):
    """Alerts of whole days; the message tells the named feature values."""
    return canonical(MON.alerts(scored_days(spark, sf_dir), features=F.col("features")))


# ---------------------------------------------------------------- positional feature files

@register("feature_vector_scan")
def q_feature_vector_scan(spark, sf_dir):
    """Hourly rows exported as headerless 8-double lines, parsed back (bad field = job failure)."""
    path = WR.write_feature_csv(features(spark, sf_dir), scratch_path(spark, "features-csv"))
    return canonical(RD.read_feature_csv(spark, path))


@register("feature_parquet_scan")
def q_feature_parquet_scan(spark, sf_dir):
    path = WR.write_feature_parquet(features(spark, sf_dir), scratch_path(spark, "features-pq"))
    return canonical(RD.read_feature_parquet(spark, path))


# ---------------------------------------------------------------- trees

def raw_tree_frames(spark, sf_dir):
    """Hourly rows with the 7 raw features, zero-guard label, 70/30 hash split."""
    frame = ml_frame(spark, sf_dir)
    return frame.where(F.col("is_train")), frame.where(~F.col("is_train"))


def profile_frame(spark, sf_dir):
    """Running profile rows with ln(success) label (NULLs removed) and 6 features."""
    cum = cumulative(spark, sf_dir)
    lab = cum.select(
        F.col("carrier_id").alias("segment"),
        FE.row_key("carrier_id", "week_of_month", "hour_of_day").alias("row_key"),
        FE.log_label(F.col("successful_charges")).alias("label"),
        F.col("successful_charges").alias("raw_label"),
        *[F.col(c).cast("double").alias(c) for c in S.FEATURES_6],
    ).where(F.col("label").isNotNull())
    return persisted(spark, lab, "profile-frame", ["segment"])


def saved_trees(spark, train, features, name, **settings):
    """A tree per segment, fitted and saved (``root/segment=<id>``): (root, table of the trees)."""
    models = TR.fit_segment_trees(train, features, segment_ids(train), **settings)
    root = TR.save_segment_models(models, scratch_path(spark, name))
    return root, TR.segment_trees(spark, root)


@register("tree_score_segments")
def q_tree_score_segments(spark, sf_dir):
    """Every row scored by its own segment's tree (one join, any number of segments)."""
    train, test = raw_tree_frames(spark, sf_dir)
    _, trees = saved_trees(spark, train, FE.FEATURES_7, "tree-models")
    return TR.score_trees(test, trees, FE.FEATURES_7, ["segment", "row_key", "label"])


@register("tree_save_load_score")
def q_tree_save_load_score(spark, sf_dir):
    """Fit, save one model directory per segment, read the saved trees, score and flag alerts."""
    train, test = raw_tree_frames(spark, sf_dir)
    _, trees = saved_trees(spark, train, FE.FEATURES_7, "tree-models")
    scored = TR.score_trees(test, trees, FE.FEATURES_7, ["segment", "row_key", "label", "raw_label"])
    return MON.score_errors(scored).select("segment", "row_key", "measured", "predicted", "error_pct", "is_alert")


@register("tree_fit_check")
def q_tree_fit_check(spark, sf_dir):
    """Per segment, on the rows a tree was fitted on: rows, sums of labels and predictions, and rows
    whose prediction is not the mean label of their leaf."""
    train, _ = raw_tree_frames(spark, sf_dir)
    _, trees = saved_trees(spark, train, FE.FEATURES_7, "tree-models")
    scored = TR.score_trees(train, trees, FE.FEATURES_7, ["segment", "row_key", "label"])
    # Rows of one leaf share its prediction; leaves with equal predictions have equal means.
    leaves = scored.groupBy("segment", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("total"), F.avg("label").alias("mean"))
    off = F.abs(F.col("mean") - F.col("prediction")) > 1e-9 * F.greatest(F.abs("mean"), F.lit(1.0))
    return canonical(leaves.groupBy("segment").agg(
        F.sum("n").alias("n_rows"), F.sum("total").alias("sum_label"),
        F.sum(F.col("prediction") * F.col("n")).alias("sum_prediction"),
        F.sum(F.when(off, F.col("n")).otherwise(0)).alias("n_off")))


STUMP_FEATURES = ["hour_of_day", "week_of_month"]


@register("tree_stump")
def q_tree_stump(spark, sf_dir):
    """Trees of depth 1 on hour and week, ties between splits settled: the rules with their predictions,
    and the segment's leaves and squared error."""
    train, _ = raw_tree_frames(spark, sf_dir)
    _, fitted = saved_trees(spark, train, STUMP_FEATURES, "stumps", max_depth=1)
    trees = persisted(spark, TR.settle_ties(fitted, train, STUMP_FEATURES), "settled-stumps")
    rules = TR.tree_rules(trees, STUMP_FEATURES).select("segment", "conditions", "prediction")
    leaves = rules.groupBy("segment").agg(F.count(F.lit(1)).alias("n_leaves"))
    scored = TR.score_trees(train, trees, STUMP_FEATURES, ["segment", "row_key", "label"])
    errors = scored.groupBy("segment").agg(F.sum((F.col("label") - F.col("prediction")) ** 2).alias("squared_error"))
    return canonical(rules.join(leaves, "segment").join(errors, "segment"))


@register("grid_search_report")
def q_grid_search_report(spark, sf_dir):
    """Depth x bins grid of all segments (one fit grows all trees, depths by truncation)."""
    return canonical(PT.grid_search(profile_frame(spark, sf_dir), S.FEATURES_6, scratch_path(spark, "grid")))


@register("grid_search_candidates")
def q_grid_search_candidates(spark, sf_dir):
    """The candidates of the grid, their validation rows, and the number of winners per segment."""
    report = q_grid_search_report(spark, sf_dir)
    winners = F.sum(F.col("is_best").cast("int")).over(Window.partitionBy("segment"))
    return report.select("segment", "max_depth", "max_bins", "n_validation", winners.alias("n_winners"))


@register("tree_rules")
def q_tree_rules(spark, sf_dir):
    frame = profile_frame(spark, sf_dir)
    _, trees = saved_trees(spark, frame, S.FEATURES_6, "rule-models")
    return TR.tree_rules(trees, S.FEATURES_6)


@register("train_segments_report")
def q_train_segments_report(spark, sf_dir):
    """Per segment: 90/10 split, grid search on 90, save the best tree, load it, score the 10, one metrics pass."""
    frame = FE.with_split_flag(profile_frame(spark, sf_dir), train_pct=90)
    train, test = frame.where(F.col("is_train")), frame.where(~F.col("is_train"))
    scratch = scratch_path(spark, "train-segments")
    report = PT.grid_search(train, S.FEATURES_6, f"{scratch}/grid")
    path = PT.save_trees(PT.refit_best(train, report, S.FEATURES_6, f"{scratch}/refit"), f"{scratch}/best-trees")
    trees = PT.load_trees(spark, path)
    scored = TR.score_trees(test, trees.select("segment", "nodes", "depth"), S.FEATURES_6, ["segment", "label"])
    met = EVL.metrics(scored, by=["segment"], one_sided_t=0.1)
    params = trees.select("segment", "max_depth", "max_bins", PT.n_nodes().alias("num_nodes"))
    return canonical(params.join(met, "segment", "left"))


def pooled_trees(spark, sf_dir):
    """The test rows and the trees of all segments, from one fit."""
    train, test = raw_tree_frames(spark, sf_dir)
    return test, PT.fit_trees(train, FE.FEATURES_7, scratch_path(spark, "pooled-trees")).drop("max_bins")


@register("pooled_tree_scores")
def q_pooled_tree_scores(spark, sf_dir):
    """Every held-out row scored by its segment's tree; all trees grown together."""
    test, trees = pooled_trees(spark, sf_dir)
    return canonical(TR.score_trees(test, trees, FE.FEATURES_7, ["segment", "row_key", "label"]))


@register("feature_file_alerts")
def q_feature_file_alerts(spark, sf_dir):
    """A feature file scored with the trees of all segments: alerts with the named feature values."""
    _, trees = pooled_trees(spark, sf_dir)
    path = WR.write_feature_csv(features(spark, sf_dir), scratch_path(spark, "features-csv"))
    rows = RD.read_feature_csv(spark, path).withColumns({
        "segment": F.col("carrier_id").cast("int"), "raw_label": F.col(S.LABEL_RAW),
        "row_key": FE.row_key("carrier_id", "week_of_month", "hour_of_day")})
    scored = TR.score_trees(rows, trees, FE.FEATURES_7, ["segment", "row_key", "raw_label", *FE.FEATURES_7])
    return canonical(MON.alerts(scored, features=MON.features_text(FE.FEATURES_7)))


ELASTIC = [(name, reg, alpha) for name, reg, alpha, _ in TR.ELASTIC_FAMILY]


def elastic_models(spark, sf_dir):
    """Lasso, ridge and elastic net of every segment, from the moments of the 80 % part, and the other rows."""
    train, test = FE.hash_split(profile_frame(spark, sf_dir), train_pct=80)
    fits = EN.elastic_fit(EN.centred_moments(train, S.FEATURES_6), len(S.FEATURES_6), ELASTIC)
    return persisted(spark, fits, "elastic-models"), test


@register("elastic_family_rmse")
def q_elastic_family_rmse(spark, sf_dir):
    """Training summary of the family: all segments and settings from one pass of moments."""
    fits, _ = elastic_models(spark, sf_dir)
    return canonical(fits.select("segment", "model", "reg_param", "elastic_net_param", "num_instances", "rmse", "r2"))


@register("elastic_coefs")
def q_elastic_coefs(spark, sf_dir):
    fits, _ = elastic_models(spark, sf_dir)
    return canonical(LN.coefs_long(fits.drop("reg_param", "elastic_net_param"), S.FEATURES_6))


@register("elastic_score_join")
def q_elastic_score_join(spark, sf_dir):
    """The held-out rows scored by the whole family."""
    fits, test = elastic_models(spark, sf_dir)
    scored = LN.score_linear(test, fits.select("model", "segment", "weights", "intercept"), S.FEATURES_6)
    return canonical(scored.select("model", "segment", "row_key", "label", "prediction"))


# ---------------------------------------------------------------- streaming

def state_partitions(spark) -> int:
    """State-store partitions for the stream queries: the cluster's default parallelism."""
    return int(spark.sparkContext.defaultParallelism)


def event_source(spark, sf_dir) -> tuple[str, str | None]:
    """Stream source for the events table: its directory, or its folder + a file
    filter when the table is a single Parquet file."""
    path = table_path(sf_dir, "events")
    return (path, None) if is_directory(spark, path) else (sf_dir, "events.parquet")


def event_stream(spark, sf_dir):
    schema = EV.load_table(spark, sf_dir, "events").schema
    path, glob = event_source(spark, sf_dir)
    return ST.read_event_stream(spark, path, schema, glob=glob)


@register("stream_hourly_replay")
def q_stream_hourly_replay(spark, sf_dir):
    """Replay the event table as a stream (availableNow, complete mode)."""
    out = ST.replay_to_parquet(ST.stream_hourly(event_stream(spark, sf_dir)),
                               scratch_path(spark, "stream-hourly"), scratch_path(spark, "stream-hourly-ckpt"),
                               state_partitions=state_partitions(spark))
    return canonical(RD.read_parquet(spark, out))


@register("stream_silent_replay")
def q_stream_silent_replay(spark, sf_dir):
    """Closed hours of the event stream with heartbeats: the alerts of silent hours."""
    rows = persisted(spark, hourly(spark, sf_dir), "hourly")
    beats = ST.write_heartbeats(SI.expected_hours(rows), scratch_path(spark, "heartbeats"))
    usual = persisted(spark, P.hourly_profile(P.with_week_of_month(rows)), "profile")
    coefs, std = batch_models(spark, sf_dir)
    out = scratch_path(spark, "stream-silent")
    path, glob = event_source(spark, sf_dir)
    ST.run_monitor(spark, path, EV.load_table(spark, sf_dir, "events").schema, ST.linear_scorer(coefs, std, profile=usual), out,
                   scratch_path(spark, "stream-silent-ckpt"), glob=glob, state_partitions=state_partitions(spark),
                   heartbeats=ST.read_heartbeats(spark, beats))
    alerts = RD.read_parquet(spark, out).join(rows.select(FE.row_key(*SI.HOUR_KEYS).alias("row_key")), "row_key", "left_anti")
    return canonical(alerts.select("segment", "row_key", "measured", "predicted", "message"))


@register("stream_once_replay")
def q_stream_once_replay(spark, sf_dir):
    """The event table delivered twice, replayed without counting an event twice."""
    events = EV.load_table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-twice")
    for copy in ("first", "again"):
        events.write.parquet(f"{path}/{copy}")
    stream = ST.once(ST.read_event_stream(spark, f"{path}/*", events.schema), "1 hour")
    out = ST.replay_to_parquet(ST.stream_hourly(stream), scratch_path(spark, "stream-once"), scratch_path(spark, "stream-once-ckpt"),
                               state_partitions=state_partitions(spark))
    return canonical(RD.read_parquet(spark, out))


@register("stream_alerts_replay")
def q_stream_alerts_replay(spark, sf_dir):
    """Closed hours from the stream scored with the batch-trained linear model."""
    frame = ml_frame(spark, sf_dir)
    train = frame.where(F.col("is_train")).drop("is_train")
    std = FE.fit_scaler(train)
    coefs = persisted(spark, LN.gd_fit(LN.moments(FE.apply_scaler(train, std))), "stream-coefs")
    schema = EV.load_table(spark, sf_dir, "events").schema
    out = scratch_path(spark, "stream-alerts")
    path, glob = event_source(spark, sf_dir)
    ST.run_monitor(spark, path, schema, ST.linear_scorer(coefs, std), out,
                   scratch_path(spark, "stream-alerts-ckpt"), glob=glob, state_partitions=state_partitions(spark))
    alerts = RD.read_parquet(spark, out)
    return canonical(alerts.select("segment", "row_key", "measured", "predicted", "error_pct", "message"))

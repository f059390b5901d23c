"""Per-segment regression trees: fit, grid search, persistence, scoring, rules.

Each segment gets its own MLlib tree (a distributed fit: one aggregation pass
per tree level).  Segments are independent jobs, submitted from a small driver
thread pool so the cluster runs several fits at once.  The training frame is
an aggregate of the raw data (segment x date x hour rows), persisted once and
read per segment.

Saved trees are read back as a table with one row per tree that holds the
tree's nodes in an array.  Rows are scored by one join with that table on the
segment, and the walk from the root to a leaf is an expression inside the
joined row: one plan for any number of segments and any depth.  The grid search
fits one deep tree per (segment, maxBins) and reads every shallower candidate
off it by stopping the walk early.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.operators.features import with_split_flag

# Tree settings and grids of the original jobs.
MAX_DEPTH = 7
MAX_BINS = 32
GRID_DEPTHS = [6, 7, 8]
GRID_BINS = list(range(15, 33))
TRAIN_PCT = 80
# Elastic-net family: (name, regParam, elasticNetParam, maxIter).
ELASTIC_FAMILY = [("lasso", 0.5, 1.0, 100), ("ridge", 0.5, 0.0, 100), ("elastic_net", 0.005, 0.2, 1000)]

DEFAULT_POOL = 8


def _pool_map(fn, items, parallelism: int = DEFAULT_POOL):
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        return list(ex.map(fn, items))


def tree_pipeline(features: list[str], label: str = "label", max_depth: int = MAX_DEPTH,
                  max_bins: int = MAX_BINS, seed: int = 42) -> tuple[Pipeline, DecisionTreeRegressor]:
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    tree = DecisionTreeRegressor(labelCol=label, featuresCol="features", predictionCol="prediction",
                                 impurity="variance", maxDepth=max_depth, maxBins=max_bins, seed=seed)
    return Pipeline(stages=[assembler, tree]), tree


def fit_segment_trees(train: DataFrame, features: list[str], segments: list[int],
                      label: str = "label", max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS,
                      parallelism: int = DEFAULT_POOL) -> dict[int, PipelineModel]:
    """One [assembler, tree] pipeline per segment, fitted concurrently."""
    def fit(seg):
        pipe, _ = tree_pipeline(features, label, max_depth, max_bins)
        return seg, pipe.fit(train.where(F.col("segment") == seg))
    return dict(_pool_map(fit, segments, parallelism))


def save_segment_models(models: dict[int, PipelineModel], root: str,
                        parallelism: int = DEFAULT_POOL) -> str:
    """One model directory per segment (``root/segment=<id>``), written concurrently."""
    _pool_map(lambda kv: kv[1].write().overwrite().save(f"{root}/segment={kv[0]}"),
              list(models.items()), parallelism)
    return root


def tree_of(model: PipelineModel) -> DecisionTreeRegressionModel:
    return model.stages[-1]


# ---------------------------------------------------------------- node tables and scoring

def _depth(nodes: Column) -> Column:
    """Depth of a tree from its nodes in preorder: a stack holds the depths of the nodes to come."""
    def visit(state, node):
        here = F.element_at(state["todo"], -1)
        rest = F.slice(state["todo"], 1, F.size(state["todo"]) - 1)
        todo = F.when(node["left"] < 0, rest).otherwise(F.concat(rest, F.array(here + 1, here + 1)))
        return F.struct(todo.alias("todo"), F.greatest(state["depth"], here).alias("depth"))
    start = F.struct(F.array(F.lit(0)).alias("todo"), F.lit(0).alias("depth"))
    return F.aggregate(nodes, start, visit, lambda state: state["depth"])


def read_trees(spark: SparkSession, files: str, keys: list[str]) -> DataFrame:
    """(keys..., nodes, depth): one row per saved tree.

    ``files`` is a pattern of the trees' node files whose paths carry ``key=<int>``
    for every key.  This is the only place that knows how MLlib stores a tree: node
    ids number the nodes from 0 in preorder, a leaf's children are negative.
    """
    path = F.col("_metadata.file_path")
    node = F.struct("id", "prediction", F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
                    F.col("split.featureIndex").alias("feature"),
                    F.get(F.col("split.leftCategoriesOrThreshold"), 0).alias("threshold"))
    rows = spark.read.parquet(files).select(
        *[F.regexp_extract(path, rf"{k}=(-?\d+)", 1).cast("int").alias(k) for k in keys], node.alias("node"))
    trees = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    return trees.withColumn("depth", _depth(F.col("nodes")))


def segment_trees(spark: SparkSession, root: str) -> DataFrame:
    """(segment, nodes, depth) of the pipelines saved under ``root/segment=<id>``."""
    return read_trees(spark, f"{root}/segment=*/stages/*DecisionTree*/data", ["segment"])


def walk(values: Column, levels: Column) -> Column:
    """The node reached in the row's ``nodes`` after at most ``levels`` splits."""
    def step(at, _):
        node = F.get("nodes", at)
        down = F.when(F.get(values, node["feature"]) <= node["threshold"], node["left"]).otherwise(node["right"])
        return F.when(node["left"] < 0, at).otherwise(down)
    end = F.aggregate(F.sequence(F.lit(1), levels), F.lit(0), step)
    return F.get("nodes", F.when(levels > 0, end).otherwise(F.lit(0)))


def checked(features: list[str]) -> Column:
    """The features as an array; a NULL or NaN raises, as it does when a vector is assembled."""
    cells = [F.col(c).cast("double") for c in features]
    bad = F.lit(False)
    for c in cells:
        bad = bad | c.isNull() | F.isnan(c)
    message = F.lit("a feature is NULL or NaN: " + ", ".join(features))
    return F.when(bad, F.raise_error(message)).otherwise(F.array(*cells))


def score_trees(df: DataFrame, trees: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and ``prediction`` of every row: one join on segment, the walk inside the row.

    Rows of a segment without a tree are kept with a NULL prediction; a NULL
    feature raises.  The tree table has one row per segment; the planner
    broadcasts it when its measured size allows and shuffles otherwise.
    """
    rows = df.select(*keep, *[c for c in ["segment"] if c not in keep], checked(features).alias("_x"))
    leaf = F.when(F.col("nodes").isNotNull(), walk(F.col("_x"), F.col("depth"))["prediction"])
    return rows.join(trees, "segment", "left").select(*keep, leaf.alias("prediction"))


# ---------------------------------------------------------------- ties

# Falls of the squared error are compared in this part of a segment's whole squared error.
TIE = 1e-9


def settle_ties(trees: DataFrame, train: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """Trees of depth 1 with ties settled: of all splits as good as the fitted one, up to ``TIE``, the first
    by feature and threshold stands.

    MLlib takes the split whose gain is the largest to the last bit, and last bits depend on the order
    in which rows are added.  A tree whose split is no tie stays as it was fitted; a split without
    a fall of one ``TIE`` becomes a leaf.  The features must have fewer values than the trees had
    bins, so that every midpoint was a candidate.  ``trees`` is as from ``read_trees`` by segment.
    """
    root = F.get("nodes", 0)
    rows = train.join(trees.select("segment", root.alias("root")), "segment").select(
        "segment", "root", (F.col(label) - F.col("root.prediction")).alias("y"), F.posexplode(checked(features)).alias("feature", "value"))
    # One row per segment, feature and value reaches the windows.
    hist = rows.groupBy("segment", "feature", "value").agg(
        F.first("root").alias("root"), F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))
    whole = Window.partitionBy("segment", "feature")
    order = whole.orderBy("value")
    below = order.rowsBetween(Window.unboundedPreceding, 0)
    sums = hist.select("segment", "feature", "value", "root", F.lead("value").over(order).alias("above"),
                       *[F.sum(c).over(w).alias(f"{p}{c}") for p, w in (("l", below), ("t", whole)) for c in "nsq"])
    right_n, right_s = F.col("tn") - F.col("ln"), F.col("ts") - F.col("ls")
    error = F.col("tq") - F.col("ts") * F.col("ts") / F.col("tn")
    fall = F.col("ls") * F.col("ls") / F.col("ln") + F.try_divide(right_s * right_s, right_n) - F.col("ts") * F.col("ts") / F.col("tn")
    # Labels that differ in their last bits only have no error to share out.
    spread = F.sqrt(F.greatest(error, F.lit(0.0)) / F.col("tn")) > TIE * F.greatest(F.abs(F.col("root.prediction")), F.lit(1.0))
    units = F.when(spread, F.floor(fall / error / TIE + 0.5))
    mean = F.col("root.prediction")
    splits = sums.where("above is not null").select(
        "segment", "root", "feature", ((F.col("value") + F.col("above")) / 2.0).alias("threshold"), units.alias("units"),
        ((F.col("root.feature") == F.col("feature")) & (F.col("root.threshold") >= F.col("value"))
         & (F.col("root.threshold") < F.col("above"))).alias("fitted"),
        (mean + F.col("ls") / F.col("ln")).alias("low"), (mean + F.try_divide(right_s, right_n)).alias("high"))
    fitted = splits.where("fitted and units >= 1").select("segment", "units")
    first = splits.join(fitted, ["segment", "units"]).groupBy("segment").agg(
        F.min(F.struct("feature", "threshold", "fitted", "low", "high")).alias("first"))

    def renewed(node):
        at = F.when(node["id"] == 0, node["prediction"]).when(node["id"] == root["left"], F.col("first.low")).otherwise(F.col("first.high"))
        return F.struct(node["id"].alias("id"), at.alias("prediction"), node["left"].alias("left"), node["right"].alias("right"),
                        F.when(node["id"] == 0, F.col("first.feature")).otherwise(node["feature"]).alias("feature"),
                        F.when(node["id"] == 0, F.col("first.threshold")).otherwise(node["threshold"]).alias("threshold"))
    leaf = F.array(F.struct(F.lit(0).alias("id"), root["prediction"].alias("prediction"), F.lit(-1).alias("left"), F.lit(-1).alias("right"),
                            F.lit(-1).alias("feature"), F.lit(None).cast("double").alias("threshold")))
    kept = F.when(F.col("first").isNull(), leaf).when(F.col("first.fitted"), F.col("nodes")).otherwise(F.transform("nodes", renewed))
    settled = trees.join(first, "segment", "left").select("segment", kept.alias("nodes"))
    return settled.withColumn("depth", _depth(F.col("nodes")))


# ---------------------------------------------------------------- grid search

@contextmanager
def _cached(frames: list[DataFrame]):
    """The frames, cached until the block ends, whichever way it does."""
    held = [f.persist() for f in frames]
    try:
        yield held
    finally:
        for f in held:
            f.unpersist()


def grid_search(spark: SparkSession, train: DataFrame, features: list[str], segments: list[int], scratch: str,
                label: str = "label", depths: list[int] | None = None, bins: list[int] | None = None,
                train_pct: int = TRAIN_PCT, key: str = "row_key", parallelism: int = DEFAULT_POOL):
    """The depth x bins grid search with one tree fit per (segment, maxBins).

    MLlib grows a tree greedily level by level and keeps a prediction on every
    node, so the tree fitted with maxDepth=d equals the deepest candidate cut
    at depth d.  Rows are split into fit and validation part by a hash of their
    key, so every run and engine sees the same parts.  Per segment and maxBins
    one tree of the largest depth is fitted on the fit part; the validation rows
    join the tree table on the segment, walk their trees once per candidate depth,
    and one grouped aggregate gives every candidate's RMSE.  The best candidate per
    segment (smallest depth, then bins, on ties) is refitted on the segment's
    whole data.

    Returns (report, {segment: PipelineModel}); the report has one row per
    candidate: segment, max_depth, max_bins, n_validation, validation_rmse, is_best.
    """
    depths = sorted(depths or GRID_DEPTHS)
    bins = bins or GRID_BINS
    flagged = with_split_flag(train, key, train_pct)
    fit_rows, validation = flagged.where("is_train"), flagged.where("not is_train")

    def fit_deep(job):
        part, seg, b = job
        pipe, _ = tree_pipeline(features, label, depths[-1], b)
        tree_of(pipe.fit(part)).write().overwrite().save(f"{scratch}/bins={b}/segment={seg}")
    with _cached([fit_rows.where(F.col("segment") == seg) for seg in segments]) as parts:
        _pool_map(fit_deep, [(p, seg, b) for p, seg in zip(parts, segments) for b in bins], parallelism)

    trees = read_trees(spark, f"{scratch}/bins=*/segment=*/data", ["segment", "bins"])
    rows = validation.select("segment", F.col(label).alias("_y"), checked(features).alias("_x"))
    at_depth = [F.struct(F.lit(d).alias("max_depth"),
                         walk(F.col("_x"), F.least("depth", F.lit(d)))["prediction"].alias("p")) for d in depths]
    candidates = rows.join(trees, "segment").select("segment", "bins", "_y", F.inline(F.array(*at_depth)))
    rmse = candidates.groupBy("segment", "max_depth", F.col("bins").alias("max_bins")).agg(
        F.count(F.lit(1)).alias("n_validation"), F.sqrt(F.avg((F.col("_y") - F.col("p")) ** 2)).alias("validation_rmse"))
    # One row per candidate and segment, written once (the walk runs a single time).
    rmse.write.mode("overwrite").parquet(f"{scratch}/rmse")
    first = Window.partitionBy("segment").orderBy("validation_rmse", "max_depth", "max_bins")
    report = spark.read.parquet(f"{scratch}/rmse").withColumn("is_best", F.row_number().over(first) == 1)
    best = {r.segment: r for r in report.where("is_best").collect()}

    def refit(seg):
        pipe, _ = tree_pipeline(features, label, best[seg].max_depth, best[seg].max_bins)
        return seg, pipe.fit(train.where(F.col("segment") == seg))
    return report, dict(_pool_map(refit, list(best), parallelism))


# ---------------------------------------------------------------- rules

def tree_rules(trees: DataFrame, features: list[str]) -> DataFrame:
    """One rule per leaf: the AND of split conditions on the root-to-leaf path.

    Each tree's nodes are visited in preorder inside its row; a stack holds the
    conditions of the nodes to come, so any depth yields all its leaves.
    """
    names = F.array(*[F.lit(c) for c in features])
    none = F.array().cast("array<string>")
    no_rules = F.array().cast("array<struct<rule_id:int,depth:int,conditions:string,prediction:double>>")

    def visit(state, node):
        here = F.element_at(state["todo"], -1)
        rest = F.slice(state["todo"], 1, F.size(state["todo"]) - 1)
        name, value = F.get(names, node["feature"]), node["threshold"].cast("string")
        left = F.concat(here, F.array(F.concat_ws(" <= ", name, value)))
        right = F.concat(here, F.array(F.concat_ws(" > ", name, value)))
        leaf = node["left"] < 0
        rule = F.struct(node["id"].alias("rule_id"), F.size(here).alias("depth"),
                        F.concat_ws(" AND ", here).alias("conditions"), node["prediction"].alias("prediction"))
        return F.struct(F.when(leaf, rest).otherwise(F.concat(rest, F.array(right, left))).alias("todo"),
                        F.when(leaf, F.concat(state["rules"], F.array(rule))).otherwise(state["rules"]).alias("rules"))
    start = F.struct(F.array(none).alias("todo"), no_rules.alias("rules"))
    return trees.select("segment", F.inline(F.aggregate("nodes", start, visit, lambda state: state["rules"])))


# ---------------------------------------------------------------- elastic-net family

def fit_elastic_family(train: DataFrame, features: list[str], segments: list[int], label: str = "label",
                       family=None, tol: float = 1e-6, parallelism: int = DEFAULT_POOL):
    """Lasso / ridge / elastic-net fits per segment.

    Returns {(segment, name): (model, regParam, elasticNetParam, maxIter)}.
    Fits run concurrently; the training metrics are computed afterwards for all
    fits in one aggregate (``elastic_report``) rather than by each summary.
    """
    family = family or ELASTIC_FAMILY
    assembled = VectorAssembler(inputCols=features, outputCol="features").transform(train).select("segment", label, "features")

    def fit(job):
        part, seg, (name, reg, alpha, iters) = job
        lr = LinearRegression(labelCol=label, featuresCol="features", regParam=reg,
                              elasticNetParam=alpha, maxIter=iters, tol=tol)
        return (seg, name), (lr.fit(part), reg, alpha, iters)
    # A segment's rows are assembled once for its fits.
    with _cached([assembled.where(F.col("segment") == seg) for seg in segments]) as parts:
        return dict(_pool_map(fit, [(p, seg, f) for p, seg in zip(parts, segments) for f in family], parallelism))


def elastic_report(spark: SparkSession, train: DataFrame, features: list[str], fits: dict,
                   label: str = "label") -> DataFrame:
    """Training RMSE / R2 / instance count of every fit in one pass.

    The fitted models are linear, so their coefficients form a small table
    (segments x family rows) that is joined to the training rows on segment
    and scored with a dot product: one scan and one grouped aggregate for all
    fits.
    """
    from hourcast.operators.linear import score_linear

    coefs = spark.createDataFrame(
        [(int(seg), name, [float(x) for x in m.coefficients.toArray()], float(m.intercept),
          float(reg), float(alpha), int(iters), int(m.summary.totalIterations))
         for (seg, name), (m, reg, alpha, iters) in sorted(fits.items())],
        "segment int, model string, weights array<double>, intercept double, reg_param double, "
        "elastic_net_param double, max_iter int, iterations int")
    scored = score_linear(train.select("segment", label, *features), coefs, features)
    sq = (F.col(label) - F.col("prediction")) ** 2
    n = F.count(F.lit(1))
    return scored.groupBy("segment", "model", "reg_param", "elastic_net_param", "max_iter", "iterations").agg(
        n.alias("num_instances"), F.sqrt(F.avg(sq)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(sq), F.var_pop(label) * n)).alias("r2"))



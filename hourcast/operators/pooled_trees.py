"""Regression trees of all segments at once, grown level by level from histograms.

One fit serves any number of segments and of ``max_bins`` values: a tree is a key (segment,
max_bins), and every level is one aggregate over all rows, keyed by (tree, node, feature, bin),
with its partial step before the shuffle.  The number of jobs is the depth, whatever the number of
segments, and a segment with most of the rows costs the same shuffle as any other.

Candidate thresholds follow MLlib's rule for continuous features: midpoints of neighbouring
values when these are fewer than the bins, else the values nearest to equal shares of the rows.
Like there, they come from a sample where a segment has more than ``SAMPLE_ROWS`` rows (rows of
the smallest hashes); histograms hold every row.  A node is split where the squared error falls
most.  Falls are compared in units of 1e-9 of the segment's squared error, ties go to the first
feature and then to the lowest threshold, so the last bits of a sum never decide; a node that
gains less than one unit is a leaf.

The result has the layout of ``tree.read_trees``: (segment, max_bins, nodes, depth), one row per
tree, so ``score_trees``, ``tree_rules`` and the walk to any depth work on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.operators import tree as TR
from hourcast.operators.features import with_split_flag

SAMPLE_ROWS = 10_000
UNITS = 1e9
TREE = ["segment", "max_bins"]


# ---------------------------------------------------------------- candidate thresholds

def _long_rows(df: DataFrame, features: list[str], *keep: Column) -> DataFrame:
    cells = F.array(*[F.col(c).cast("double") for c in features])
    return df.select(*keep, F.posexplode(cells).alias("feature", "value"))


def _thresholds(values: Column, total: Column, max_bins: Column) -> Column:
    """Thresholds of one feature from its sorted (value, n) and the number of rows."""
    n_splits = F.least(max_bins.cast("long"), total) - 1
    stride = total / (n_splits + 1)
    middle = lambda i: (F.get(values, i - 1)["value"] + F.get(values, i)["value"]) / 2.0
    later = F.sequence(F.lit(1), F.size(values) - 1)

    def step(state: Column, i: Column) -> Column:
        seen = state["seen"] + F.get(values, i)["n"]
        cut = F.abs(state["seen"] - state["target"]) < F.abs(seen - state["target"])
        return F.struct(seen.alias("seen"), F.when(cut, state["target"] + stride).otherwise(state["target"]).alias("target"),
                        F.when(cut, F.concat(state["cuts"], F.array(middle(i)))).otherwise(state["cuts"]).alias("cuts"))
    start = F.struct(F.get(values, 0)["n"].alias("seen"), stride.alias("target"), F.array().cast("array<double>").alias("cuts"))
    return (F.when(F.size(values) < 2, F.array().cast("array<double>"))
            .when(F.size(values) - 1 <= n_splits, F.transform(later, middle))
            .otherwise(F.aggregate(later, start, step, lambda s: s["cuts"])))


def tree_setup(fit: DataFrame, features: list[str], max_bins: list[int], label: str, key: str) -> DataFrame:
    """One row per tree: its thresholds by feature, the centre of its labels and the root of their
    squared error."""
    totals = fit.groupBy("segment").agg(F.count(F.lit(1)).alias("rows"), F.avg(label).alias("centre"),
                                        F.sqrt(F.var_pop(label) * F.count(F.lit(1))).alias("scale"))
    share = F.lit(float(SAMPLE_ROWS)) / F.col("rows") * F.lit(float(1 << 62))
    drawn = fit.join(totals.select("segment", "rows"), "segment").where(
        (F.col("rows") <= SAMPLE_ROWS) | (F.shiftrightunsigned(F.xxhash64(key), 2).cast("double") < share))
    counts = _long_rows(drawn, features, F.col("segment")).groupBy("segment", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    # At most SAMPLE_ROWS values, so the array is bounded.
    by_feature = counts.groupBy("segment", "feature").agg(F.sort_array(F.collect_list(F.struct("value", "n"))).alias("values"), F.sum("n").alias("total"))
    cuts = by_feature.withColumn("max_bins", F.explode(F.array(*[F.lit(b) for b in max_bins]))).select(
        *TREE, "feature", _thresholds(F.col("values"), F.col("total"), F.col("max_bins")).alias("cuts"))
    per_tree = cuts.groupBy(*TREE).agg(F.sort_array(F.collect_list(F.struct("feature", "cuts"))).alias("cuts"))
    return per_tree.select(*TREE, F.transform("cuts", lambda c: c["cuts"]).alias("cuts")).join(totals, "segment")


def binned(rows: DataFrame, setup: DataFrame, features: list[str], label: str) -> DataFrame:
    """A row per row and tree: the label, centred and scaled to a squared error of 1, and for each
    feature how many thresholds lie below."""
    values = TR.checked(features)
    cells = F.zip_with("x", "cuts", lambda x, cuts: F.size(F.filter(cuts, lambda t: t < x)))
    return (rows.select("segment", F.col(label).alias("label"), values.alias("x")).join(setup, "segment")
            .select(*TREE, F.coalesce(F.try_divide(F.col("label") - F.col("centre"), F.col("scale")), F.lit(0.0)).alias("y"), cells.alias("cells")))


# ---------------------------------------------------------------- growth

def _sse(n: Column, s: Column, q: Column) -> Column:
    return q - s * s / n


def _at(cells: Column, splits: Column, levels: int) -> Column:
    """The node (root 1, children 2i and 2i + 1) that a row reaches after the splits known so far."""
    def step(node, _):
        split = F.try_element_at(splits, node)
        return F.when(split.isNull(), node).otherwise(
            node * 2 + F.when(F.get(cells, split["feature"]) > split["cut"], 1).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(1).cast("long"), step) if levels else F.lit(1).cast("long")


def _level(rows: DataFrame, last: bool) -> DataFrame:
    """(tree, node, n, s, feature, cut) of every node in ``rows`` (tree, node, y, cells); feature
    and cut are null for a leaf.  ``last``: no node is split."""
    if last:
        return rows.groupBy(*TREE, "node").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).select(
            "*", F.lit(None).cast("int").alias("feature"), F.lit(None).cast("int").alias("cut"))
    cells = rows.select(*TREE, "node", "y", F.posexplode("cells").alias("feature", "cell"))
    hist = cells.groupBy(*TREE, "node", "feature", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))
    # A node's sums (features x bins at most) meet in one place for the window and for the choice.
    hist = hist.repartition(*TREE, "node")
    whole = Window.partitionBy(*TREE, "node", "feature")
    below = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    sums = hist.select(*TREE, "node", "feature", "cell", *[F.sum(c).over(w).alias(f"{p}{c}") for p, w in (("l", below), ("t", whole)) for c in "nsq"])
    left = _sse(F.col("ln"), F.col("ls"), F.col("lq"))
    right = _sse(F.col("tn") - F.col("ln"), F.col("ts") - F.col("ls"), F.col("tq") - F.col("lq"))
    fall = F.when(F.col("ln") < F.col("tn"), _sse(F.col("tn"), F.col("ts"), F.col("tq")) - left - right)
    units = F.floor(fall * UNITS + 0.5)
    # The totals of all features are equal but for their last bits: those of the first one are kept.
    found = sums.withColumn("units", F.when(units >= 1, units))
    best = F.max(F.when(F.col("units").isNotNull(), F.struct("units", (-F.col("feature")).alias("f"), (-F.col("cell")).alias("c"))))
    first = F.min(F.struct("feature", "tn", "ts"))
    return found.groupBy(*TREE, "node").agg(best.alias("best"), first.alias("first")).select(
        *TREE, "node", F.col("first.tn").alias("n"), F.col("first.ts").alias("s"),
        (-F.col("best.f")).alias("feature"), (-F.col("best.c")).alias("cut"))


def _nodes(levels: DataFrame, setup: DataFrame) -> DataFrame:
    """(tree, nodes, depth) in the layout of ``tree.read_trees``: nodes in preorder."""
    path = F.substring(F.bin("node"), 2, 64)
    threshold = F.get(F.get("cuts", F.col("feature")), F.col("cut"))
    rows = levels.join(setup.select(*TREE, "cuts", "centre", "scale"), TREE).select(*TREE, F.struct(
        path.alias("path"), (F.col("centre") + F.col("scale") * F.col("s") / F.col("n")).alias("prediction"),
        F.coalesce("feature", F.lit(-1)).alias("feature"), threshold.alias("threshold")).alias("node"))
    # A path sorts behind the paths it begins with, so sorted paths are the preorder.
    trees = rows.groupBy(*TREE).agg(F.sort_array(F.collect_list("node")).alias("found"))
    paths = F.transform("found", lambda node: node["path"])

    def placed(node: Column, i: Column) -> Column:
        inner = node["feature"] >= 0
        right = (F.array_position("paths", F.concat(node["path"], F.lit("1"))) - 1).cast("int")
        return F.struct(i.alias("id"), node["prediction"].alias("prediction"), F.when(inner, i + 1).otherwise(-1).alias("left"),
                        F.when(inner, right).otherwise(-1).alias("right"), node["feature"].alias("feature"), node["threshold"].alias("threshold"))
    return trees.withColumn("paths", paths).select(
        *TREE, F.transform("found", placed).alias("nodes"), F.array_max(F.transform("paths", lambda p: F.length(p))).alias("depth"))


def fit_trees(df: DataFrame, features: list[str], scratch: str, label: str = "label", key: str = "row_key",
              max_depth: int = TR.MAX_DEPTH, max_bins: list[int] | int = TR.MAX_BINS) -> DataFrame:
    """A tree for every segment and every value of ``max_bins``: (segment, max_bins, nodes, depth).

    ``scratch`` is a fresh folder.  The binned rows and the nodes of each level are written there
    once, so a lost executor redoes part of one level only.
    """
    spark = df.sparkSession
    max_bins = [max_bins] if isinstance(max_bins, int) else max_bins

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{scratch}/{name}")

    df = df.where(F.col(label).isNotNull() & F.col("segment").isNotNull())
    setup = kept(tree_setup(df, features, max_bins, label, key), "setup")
    rows = kept(binned(df, setup, features, label), "binned")
    here, levels = rows.withColumn("node", F.lit(1).cast("long")), None
    for level in range(max_depth + 1):
        split = Observation()
        found = _level(here, level == max_depth)
        found.observe(split, F.count("feature").alias("n")).write.parquet(f"{scratch}/levels/level={level}")
        levels = spark.read.schema(found.schema).parquet(f"{scratch}/levels").select(found.columns)
        if not split.get["n"]:
            break
        splits = levels.where("feature is not null").groupBy(*TREE).agg(
            F.map_from_entries(F.collect_list(F.struct("node", F.struct("feature", "cut").alias("split")))).alias("splits"))
        here = rows.join(splits, TREE).withColumn("node", _at(F.col("cells"), F.col("splits"), level + 1)).where(F.col("node") >= (2 << level))
    return kept(_nodes(levels, setup), "trees")


def save_trees(trees: DataFrame, path: str) -> str:
    """One table for all trees."""
    trees.write.mode("overwrite").parquet(path)
    return path


def load_trees(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ---------------------------------------------------------------- grid search

def grid_search(df: DataFrame, features: list[str], scratch: str, label: str = "label", key: str = "row_key",
                depths: list[int] | None = None, bins: list[int] | None = None, train_pct: int = TR.TRAIN_PCT) -> DataFrame:
    """The depth x bins grid of all segments.

    One fit grows a tree of the largest depth for every segment and bins value on the fit part of a
    hash split; a shallower candidate is that tree cut at its depth.  The validation rows walk their
    segment's trees once per depth, and one aggregate gives every candidate's RMSE.  Best is the
    least RMSE in units of 1e-9, then the least depth and bins.

    One row per candidate: segment, max_depth, max_bins, n_validation, validation_rmse, is_best.
    """
    depths, bins = sorted(depths or TR.GRID_DEPTHS), bins or TR.GRID_BINS
    flagged = with_split_flag(df, key, train_pct)
    trees = fit_trees(flagged.where("is_train"), features, f"{scratch}/fit", label, key, depths[-1], bins)
    rows = flagged.where("not is_train").select("segment", F.col(label).alias("_y"), TR.checked(features).alias("_x"))
    at_depth = [F.struct(F.lit(d).alias("max_depth"), TR.walk(F.col("_x"), F.least("depth", F.lit(d)))["prediction"].alias("p")) for d in depths]
    candidates = rows.join(trees, "segment").select("segment", "max_bins", "_y", F.inline(F.array(*at_depth)))
    rmse = candidates.groupBy("segment", "max_depth", "max_bins").agg(
        F.count(F.lit(1)).alias("n_validation"), F.sqrt(F.avg((F.col("_y") - F.col("p")) ** 2)).alias("validation_rmse"))
    rmse.write.parquet(f"{scratch}/rmse")
    first = Window.partitionBy("segment").orderBy(F.floor(F.col("validation_rmse") * UNITS + 0.5), "max_depth", "max_bins")
    return df.sparkSession.read.parquet(f"{scratch}/rmse").withColumn("is_best", F.row_number().over(first) == 1)


def refit_best(df: DataFrame, report: DataFrame, features: list[str], scratch: str, label: str = "label", key: str = "row_key") -> DataFrame:
    """The best candidate of each segment, fitted on all its rows: segment, max_depth, max_bins,
    nodes, depth.  One fit for all bins values that won; each tree is cut at its depth."""
    best = report.where("is_best").select("segment", "max_depth", "max_bins")
    won = best.agg(F.sort_array(F.collect_set("max_bins")).alias("bins"), F.max("max_depth").alias("depth")).first()   # the grid's values
    trees = fit_trees(df, features, scratch, label, key, won.depth or 0, won.bins or [TR.MAX_BINS])
    return trees.join(best, TREE).select(*TREE, "max_depth", "nodes", F.least("depth", "max_depth").alias("depth"))


def n_nodes() -> Column:
    """How many nodes each tree of a table (nodes, depth) has down to its depth."""
    def visit(state: Column, node: Column) -> Column:
        here = F.element_at(state["todo"], -1)
        rest = F.slice(state["todo"], 1, F.size(state["todo"]) - 1)
        todo = F.when(node["left"] < 0, rest).otherwise(F.concat(rest, F.array(here + 1, here + 1)))
        return F.struct(todo.alias("todo"), (state["n"] + F.when(here <= F.col("depth"), 1).otherwise(0)).alias("n"))
    start = F.struct(F.array(F.lit(0)).alias("todo"), F.lit(0).alias("n"))
    return F.aggregate("nodes", start, visit, lambda s: s["n"])

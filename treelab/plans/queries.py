"""The registered queries: every operator over whole supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from treelab.operators import (boosting, clean, exact, explain, forest, full_tree as full, grower, metrics, nodes, profile, pruning,
                               resample)
from treelab.plans import compare
from treelab.plans.fixtures import (MIXED_COLS, SCALE_COLS, WIDE_COLS, mixed_raw, mixed_types, scale_rows, scored_rows,
                                    sine_rows, split_rows, table, wide_numeric)
from treelab.sources import sinks, tables

CLASS_NAMES = {0: "negative", 1: "positive"}
#: Settings shared with the SQL side.
TREE_DEPTH, TREE_BINS = 4, 64
SWEEP_DEPTHS = list(range(1, 20))
FOREST_TREES, FOREST_DEPTH, FOREST_BINS = 12, 4, 32
FOREST_SIZES, REFERENCE_DEPTH = [1, 5, 10, 20, 50, 100, 200, 300, 500], 8
PERM_REPEATS = 30
BOOST = boosting.BoostConfig(name="boost", n_rounds=3, learning_rate=0.3, max_depth=2, subsample=0.8,
                             colsample_bytree=0.8, gamma=1.0, reg_lambda=2.0, reg_alpha=0.5)
REG_BASE = boosting.BoostConfig(n_rounds=200, learning_rate=0.1, max_depth=4)
REG_SETTINGS = [
    {"label": "default", "gamma": 0.0, "lambda": 1.0, "alpha": 0.0},
    {"label": "gamma=1", "gamma": 1.0, "lambda": 1.0, "alpha": 0.0},
    {"label": "lambda=10", "gamma": 0.0, "lambda": 10.0, "alpha": 0.0},
    {"label": "alpha=1", "gamma": 0.0, "lambda": 1.0, "alpha": 1.0},
    {"label": "combined", "gamma": 1.0, "lambda": 5.0, "alpha": 0.5},
]
RATES = [(1.0, 10), (0.5, 50), (0.1, 100), (0.05, 200), (0.01, 500)]
GBT_ROUNDS = 3


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round to six places; thresholds to eight, where equal-width edges never fall on a half."""
    return df.withColumns({c: F.round(c, 8 if c == "threshold" else 6) for c in cols})


# --- sources, cleaning, profiling -------------------------------------------------------------------------------

def scan_numeric(spark, d):
    return wide_numeric(spark, d)


def scan_mixed(spark, d):
    return mixed_raw(spark, d)


def assemble_features(spark, d):
    from pyspark.ml.functions import vector_to_array
    v = vector_to_array(F.col("features"))
    df = tables.assemble(scale_rows(spark, d), SCALE_COLS)
    return df.select("label", F.size(v).alias("n_features"), *[v[i].alias(f"v{i}") for i in range(4)]).groupBy("label").agg(
        F.count("*").alias("n"), F.min("n_features").cast("long").alias("width"), F.min("v0").alias("min_v0"), F.max("v1").alias("max_v1"),
        F.max("v2").alias("max_v2"), F.max("v3").alias("max_v3")).withColumn("label", F.col("label").cast("int"))


def shape_report(spark, d):
    return tables.shape_report(scale_rows(spark, d), SCALE_COLS)


def sine_demo(spark, d):
    return r6(sine_rows(spark, d), "x", "y")


def sine_demo_round0(spark, d):
    df = profile.global_mean_prediction(sine_rows(spark, d), "y")
    return r6(profile.mean_squared_error(df, "y", "f0"), "mse")


def text_report(spark, d):
    return sinks.text_report(_model_metrics(spark, d), "model", ["accuracy", "log_loss"], 12)


def label_encode_target(spark, d):
    df = table(spark, d, "orders").select(F.col("o_orderkey").alias("row_id"), "o_orderpriority")
    return clean.encode_sorted(df, ["o_orderpriority"], "_code")


def target_classes(spark, d):
    return clean.target_classes(table(spark, d, "orders"), "o_orderpriority")


def collapse_binary(spark, d):
    df = clean.encode_sorted(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderpriority"])
    return clean.collapse_binary(df, "o_orderpriority", "label").groupBy("o_orderpriority", "label").agg(F.count("*").alias("n"))


def drop_missing(spark, d):
    return clean.drop_missing(mixed_raw(spark, d), MIXED_COLS).select("row_id", "c_acctbal", "label")


def encode_categoricals(spark, d):
    df = clean.drop_missing(mixed_raw(spark, d), MIXED_COLS)
    return clean.encode_sorted(df, clean.categorical_columns(df, MIXED_COLS)).select(
        "row_id", "o_orderpriority", "c_mktsegment", "o_orderstatus")


def coerce_numeric(spark, d):
    # the part name ends in a number for some rows only; the rest becomes missing
    df = table(spark, d, "part").select(F.col("p_partkey").alias("row_id"), F.regexp_extract("p_brand", "#(.*)$", 1).alias("brand_no"), "p_type")
    return clean.coerce_numeric(df, ["brand_no", "p_type"])


def clean_flow(spark, d):
    return mixed_types(spark, d)


def class_filter(spark, d):
    return scale_rows(spark, d).where("label = 1").agg(
        F.count("*").alias("n"), F.min("l_quantity").alias("min_quantity"), F.max("l_discount").alias("max_discount"))


def column_subset(spark, d):
    return scale_rows(spark, d).select("l_quantity", "l_discount").groupBy("l_quantity", "l_discount").agg(F.count("*").alias("n"))


def relabel_codes(spark, d):
    df = clean.relabel(scale_rows(spark, d), "label", CLASS_NAMES, "class_name")
    return df.groupBy("class_name").agg(F.count("*").alias("n"))


def align_target(spark, d):
    df = scale_rows(spark, d)
    joined = tables.align_target(df.select("row_id", *SCALE_COLS), df.select("row_id", "label"))
    return joined.groupBy("label").agg(F.count("*").alias("n"), F.max("l_extendedprice").alias("max_price"))


def feature_name_join(spark, d):
    long = profile.to_long(scale_rows(spark, d), SCALE_COLS).groupBy("feature").agg(F.max("value").alias("max_value"))
    index = F.array_position(F.array(*[F.lit(c) for c in SCALE_COLS]), F.col("feature")).cast("int") - 1
    return tables.with_feature_names(long.select(index.alias("feature_idx"), "max_value"), SCALE_COLS)


def class_distribution(spark, d):
    return profile.class_distribution(scale_rows(spark, d))


def class_ratio_by_split(spark, d):
    return r6(profile.class_ratio(split_rows(scale_rows(spark, d))), "class_ratio")


def describe_features(spark, d):
    return profile.describe(scale_rows(spark, d), SCALE_COLS)


def class_histograms(spark, d):
    return r6(profile.class_histograms(scale_rows(spark, d), SCALE_COLS, bins=30), "bin_left", "bin_right")


def box_summary(spark, d):
    long = table(spark, d, "lineitem").select("l_returnflag", F.pow("l_extendedprice", 3).alias("value"))
    return profile.box_summary(long.withColumn("value", F.floor(F.col("value") / 1e6).cast("double")), "l_returnflag", "value")


def box_outliers(spark, d):
    long = table(spark, d, "orders").select("o_orderpriority", F.floor(F.pow(F.col("o_totalprice") / 1000.0, 8) / 1e9).cast("double").alias("value"))
    return profile.box_outliers(long, "o_orderpriority", "value").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))


def fold_mean_std(spark, d):
    return r6(profile.fold_mean_std(_fold_accuracy(spark, d), ["model"]), "cv_mean", "cv_std")


def _fold_accuracy(spark, d):
    return metrics.accuracy(scored_rows(spark, d, 5), ["model", "fold"])


def best_param_first_tie(spark, d):
    s = scored_rows(spark, d).where("model = 'price'").withColumn(
        "cut", F.explode(F.array(*[F.lit(c / 20) for c in range(1, 20)])))
    curve = metrics.accuracy(s.withColumn("prediction", (F.col("p1") >= F.col("cut")).cast("int")), ["cut"])
    return profile.best_param(r6(curve, "accuracy"), "cut", "accuracy")


# --- splitting and resampling -------------------------------------------------------------------------------------

def stratified_split(spark, d):
    return split_rows(scale_rows(spark, d)).select("row_id", "label", "split")


def stratified_folds(spark, d):
    return resample.stratified_folds(scale_rows(spark, d), 10).select("row_id", "label", "fold")


def split_repeated_ids(spark, d):
    """Rows that share an id (here the order of a line item) are ordered by their content where a class is cut: quotas stay exact."""
    df = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("row_id"), (F.col("l_quantity") > 30).cast("int").alias("label"), "l_partkey",
                                            "l_suppkey", "l_linenumber", "l_extendedprice")
    return split_rows(df).groupBy("label", "split").agg(F.count("*").alias("n"))


def internal_holdout(spark, d):
    train = split_rows(scale_rows(spark, d)).where("split = 'train'").drop("split")
    return resample.stratified_split(train, test_fraction=0.2, seed=43, out="part", names=("fit", "valid")).select("row_id", "part")


def bootstrap_weights(spark, d):
    bag = resample.bootstrap_weights(mixed_raw(spark, d).select("row_id"), 10)
    return bag.select("row_id", F.posexplode("bag").alias("tree_id", "weight")).withColumn("weight", F.col("weight").cast("int"))


def row_subsample(spark, d):
    df = mixed_raw(spark, d).select("row_id")
    return df.where(resample.row_subsample(F.col("row_id"), 0.8, 3))


def colsample_subset(spark, d):
    rounds = table(spark, d, "nation").select(F.col("n_nationkey").alias("iteration"))
    return resample.colsample_table(rounds, WIDE_COLS, 0.8)


def permute_column(spark, d):
    return resample.permute_column(mixed_types(spark, d), "o_totalprice", 2)


# --- metrics over the deterministic scores ------------------------------------------------------------------------

def accuracy(spark, d):
    return r6(metrics.accuracy(scored_rows(spark, d), ["model"]), "accuracy")


def confusion_matrix(spark, d):
    return metrics.confusion_matrix(scored_rows(spark, d), by=["model"])


def specificity_recall(spark, d):
    return r6(metrics.binary_rates(scored_rows(spark, d), 1, ["model"]), "specificity", "recall")


def classification_report(spark, d):
    return r6(metrics.classification_report(scored_rows(spark, d), CLASS_NAMES, by=["model"]), "precision", "recall", "f1")


def roc_points(spark, d):
    return r6(metrics.roc_points(scored_rows(spark, d), ["model"], drop_collinear=False), "fpr", "tpr", "threshold")


def roc_points_reduced(spark, d):
    return r6(metrics.roc_points(scored_rows(spark, d), ["model"], baseline=True), "fpr", "tpr", "threshold")


def auc_roc(spark, d):
    return r6(metrics.auc(scored_rows(spark, d), ["model"]), "auc")


def log_loss(spark, d):
    return r6(metrics.log_loss(scored_rows(spark, d), ["model"], eps=0.001), "log_loss")


def overfit_gap(spark, d):
    return r6(metrics.overfit_gap(scored_rows(spark, d), by=["model"]), "train_acc", "test_acc", "gap")


def _model_metrics(spark, d):
    s = scored_rows(spark, d)
    long = metrics.accuracy(s, ["model"]).select("model", F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")).unionByName(
        metrics.log_loss(s, ["model"], eps=0.001).select("model", F.lit("log_loss").alias("metric"), F.col("log_loss").alias("value")))
    return clean.metrics_wide(long.withColumn("model", F.concat("model", F.lit("\nscore"))), metrics=["accuracy", "log_loss"])


def metric_pivot(spark, d):
    return r6(clean.clean_names(_model_metrics(spark, d)), "accuracy", "log_loss")


def running_vote_accuracy(spark, d):
    # three fixed scores vote one after the other, in name order
    votes = scored_rows(spark, d).groupBy("row_id", "label").agg(F.array_sort(F.collect_list(F.struct("model", "p1"))).alias("v"))
    votes = votes.select("row_id", F.lit("test").alias("split"), "label", F.transform("v", lambda s: s["p1"]).alias("p"))
    return r6(forest.prefix_accuracy(votes).select("n_trees", F.col("test_acc").alias("accuracy")), "accuracy")


def patience_stop(spark, d):
    return r6(metrics.patience_stop(_daily_losses(spark, d), 5), "best_loss")


def window_stop(spark, d):
    return metrics.window_stop(_daily_losses(spark, d), 8, 1e-4)


def _daily_losses(spark, d):
    s = table(spark, d, "orders").withColumn("iteration", F.year("o_orderdate") * 12 + F.month("o_orderdate"))
    return s.groupBy("iteration").agg(F.round(F.avg("o_totalprice") / 1e6, 6).alias("loss"))


# --- trees --------------------------------------------------------------------------------------------------------

def missing_routing(spark, d):
    """One second-order split over a feature with planted nulls and NaN: where the missing rows go."""
    raw = mixed_raw(spark, d)
    nan = F.when(F.col("c_acctbal").isNull() & (F.col("row_id") % 2 == 0), F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    df = raw.select("row_id", "label", nan.alias("c_acctbal"), F.lit("train").alias("role"))
    config = boosting.BoostConfig(n_rounds=1, learning_rate=1.0, max_depth=1, reg_lambda=1.0, min_child_weight=0.0)
    model, = boosting.boost(df, ["c_acctbal"], [config], role="role", max_bins=16, method="width", track=False)
    return r6(nodes.node_table(spark, model.nodes).select("node_id", "is_leaf", "threshold", "missing_left", "n_samples", "cover", "value", "gain"),
              "threshold", "cover", "value", "gain")


def gini_root_split(spark, d):
    df = scale_rows(spark, d).selectExpr(*SCALE_COLS, "0 AS node", "CAST(1 - label AS DOUBLE) AS s0", "CAST(label AS DOUBLE) AS s1")
    return r6(exact.exact_splits(df, SCALE_COLS, grower.GiniRule()), "threshold", "gain")


def gini_node_splits(spark, d):
    """The same for several nodes at once: here the rows of each return flag are a node."""
    flags = table(spark, d, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("node"))
    df = mixed_types(spark, d).join(flags, "row_id").selectExpr(
        *MIXED_COLS, "node", "CAST(1 - label AS DOUBLE) AS s0", "CAST(label AS DOUBLE) AS s1")
    return r6(exact.exact_splits(df, MIXED_COLS, grower.GiniRule()), "threshold", "gain")


def second_order_root_split(spark, d):
    rule = grower.NewtonRule([2.0], [0.5], [1.0], [1.0])
    df = scale_rows(spark, d).selectExpr(*SCALE_COLS, "0 AS node", "0.5D - label AS g", "0.25D AS h")
    return r6(exact.exact_splits(df, SCALE_COLS, rule), "threshold", "gain")


def _scale_tree(spark, d, depth=TREE_DEPTH):
    data = split_rows(scale_rows(spark, d)).persist()
    found, _ = forest.grow_tree(data.where("split = 'train'"), SCALE_COLS, depth, TREE_BINS, "width")
    return data, found


def tree_nodes(spark, d):
    _, found = _scale_tree(spark, d)
    df = nodes.node_table(spark, found).select(
        "node_id", "depth", "feature", "threshold", "is_leaf", "n_samples", F.col("class_counts")[0].alias("count_0"),
        F.col("class_counts")[1].alias("count_1"), "impurity", "gain", "prediction")
    return r6(df, "threshold", "impurity", "gain")


def tree_size(spark, d):
    _, found = _scale_tree(spark, d)
    return nodes.tree_summary(nodes.node_table(spark, found))


def tree_report(spark, d):
    _, found = _scale_tree(spark, d, 3)
    return r6(nodes.node_report(nodes.node_table(spark, found), 2, CLASS_NAMES), "impurity", "purity")


def tree_rules(spark, d):
    _, found = _scale_tree(spark, d, 3)
    return nodes.leaf_rules(nodes.node_table(spark, found))


def tree_rules_text(spark, d):
    _, found = _scale_tree(spark, d, 3)
    return nodes.rules_text(nodes.node_table(spark, found))


def depth_sweep(spark, d):
    data, found = _scale_tree(spark, d, SWEEP_DEPTHS[-1])
    return r6(pruning.depth_sweep(data, found, SCALE_COLS, SWEEP_DEPTHS), "train_acc", "test_acc")


def pruning_path(spark, d):
    _, found = _scale_tree(spark, d, 8)
    return r6(pruning.pruning_path(pruning.prune_alphas(nodes.node_table(spark, found))), "alpha", "total_impurity")


def tree_size_by_alpha(spark, d):
    _, found = _scale_tree(spark, d, 8)
    return pruning.tree_sizes(pruning.prune_alphas(nodes.node_table(spark, found)))


def alpha_sweep(spark, d):
    data, found = _scale_tree(spark, d, 8)
    return pruning.alpha_sweep(data, pruning.prune_alphas(nodes.node_table(spark, found)), SCALE_COLS)


def pruned_tree_report(spark, d):
    """Depth and alpha chosen by sweep, tree pruned, scored on the test rows."""
    return flagship(spark, d)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Clean, split, grow, pick depth and alpha by sweep, prune, and report on the test rows."""
    data = split_rows(mixed_types(spark, d)).persist()
    train = data.where("split = 'train'")
    found, _ = forest.grow_tree(train, MIXED_COLS, 6, 32, "width")
    depth = profile.best_param(pruning.depth_sweep(data, found, MIXED_COLS, list(range(1, 7))), "depth", "test_acc").first()[0]
    cut = pruning.prune_alphas(nodes.node_table(spark, pruning.truncate(found, depth)))
    rows = nodes.rows_of(cut)
    alpha = profile.best_param(pruning.alpha_sweep(data, rows, MIXED_COLS), "alpha", "test_acc").first()[0]
    scored = nodes.predict_forest(data.where("split = 'test'"), pruning.prune(rows, alpha), MIXED_COLS)
    return r6(metrics.classification_report(scored, CLASS_NAMES), "precision", "recall", "f1")


def ml_tree_nodes(spark, d):
    """Spark's own tree, read into the node table."""
    train = tables.assemble(split_rows(wide_numeric(spark, d)).where("split = 'train'"), WIDE_COLS)
    model = forest.decision_tree(5, 512).fit(train)
    return nodes.node_report(nodes.node_table(spark, nodes.model_nodes(model, WIDE_COLS)))


def full_tree(spark, d):
    """The tree without any limit: every leaf is pure, or its rows are equal in all features."""
    found, _ = full.full_tree(split_rows(mixed_types(spark, d)), MIXED_COLS, split="split")
    return r6(found, "threshold", "impurity", "gain")


def full_tree_summary(spark, d):
    found, hits = full.full_tree(split_rows(mixed_types(spark, d)), MIXED_COLS, split="split")
    return r6(full.summary(found, hits), "train_acc", "test_acc")


def cv_fold_scores(spark, d):
    folded = resample.stratified_folds(scale_rows(spark, d), 5).persist()
    found = forest.cross_validated_trees(folded, SCALE_COLS, 5, 3, TREE_BINS, "width")
    return r6(forest.fold_scores(folded, found, SCALE_COLS), "accuracy")


# --- forests ------------------------------------------------------------------------------------------------------

def _mixed_forest(spark, d):
    data = split_rows(mixed_types(spark, d)).persist()
    found = forest.grow_forest(data.where("split = 'train'"), MIXED_COLS, FOREST_TREES, FOREST_DEPTH, FOREST_BINS, "width")
    return data, found


def forest_nodes(spark, d):
    _, found = _mixed_forest(spark, d)
    return r6(nodes.node_table(spark, found).select("tree_id", "node_id", "feature", "threshold", "n_samples", "cover", "value", "gain"),
              "threshold", "value", "gain")


def forest_first_tree(spark, d):
    _, found = _mixed_forest(spark, d)
    return r6(nodes.node_report(nodes.node_table(spark, found).where("tree_id = 0"), 3, CLASS_NAMES), "impurity", "purity")


def oob_score(spark, d):
    data, found = _mixed_forest(spark, d)
    curve = forest.oob_curve(data.where("split = 'train'"), found, MIXED_COLS)
    return r6(curve.where(F.col("n_trees") == FOREST_TREES), "oob_score", "oob_error")


def oob_convergence(spark, d):
    data, found = _mixed_forest(spark, d)
    return r6(forest.oob_curve(data.where("split = 'train'"), found, MIXED_COLS), "oob_score", "oob_error")


def oob_warm_start(spark, d):
    """200 trees added in two goes; the curve is the one of a forest grown at once."""
    train = split_rows(mixed_types(spark, d)).where("split = 'train'").persist()
    half = forest.add_trees(forest.warm_forest(train, MIXED_COLS, REFERENCE_DEPTH, FOREST_BINS, "width"), 100)
    whole = forest.add_trees(half, 100)
    train.unpersist()
    return r6(forest.warm_curve(whole), "oob_score", "oob_error")


def forest_sizes(spark, d):
    """Train and test accuracy of forests of 1 to 500 trees, from one growth."""
    data = _kept(split_rows(mixed_types(spark, d)))
    found = forest.grow_forest(data.where("split = 'train'"), MIXED_COLS, FOREST_SIZES[-1], REFERENCE_DEPTH, FOREST_BINS, "width")
    return r6(forest.forest_size_curve(data, found, MIXED_COLS).where(F.col("n_trees").isin(FOREST_SIZES)), "train_acc", "test_acc")


def forest_size_sweep(spark, d):
    data, found = _mixed_forest(spark, d)
    return r6(forest.forest_size_curve(data, found, MIXED_COLS), "train_acc", "test_acc")


def mdi_importance(spark, d):
    _, found = _mixed_forest(spark, d)
    return r6(explain.impurity_importance(nodes.node_table(spark, found), MIXED_COLS), "importance")


def topk_features(spark, d):
    _, found = _mixed_forest(spark, d)
    return r6(explain.top_features(explain.impurity_importance(nodes.node_table(spark, found), MIXED_COLS), 3), "importance")


def permutation_scores(spark, d):
    data, found = _mixed_forest(spark, d)
    predict = nodes.ForestPredictor(found, MIXED_COLS)
    return r6(explain.permutation_scores(data.where("split = 'test'"), predict, MIXED_COLS, PERM_REPEATS, used=_used(found)), "accuracy")


def permutation_importance(spark, d):
    data, found = _mixed_forest(spark, d)
    predict = nodes.ForestPredictor(found, MIXED_COLS)
    return r6(explain.permutation_importance(data.where("split = 'test'"), predict, MIXED_COLS, PERM_REPEATS, used=_used(found)),
              "importance_mean", "importance_std")


def _used(found: list[dict]) -> list[str]:
    return sorted({r["feature"] for r in found if not r["is_leaf"]})


# --- boosting -----------------------------------------------------------------------------------------------------

def _kept(data: DataFrame) -> DataFrame:
    """The rows on disk: some passes read them, and executors need their memory for Python."""
    return data.persist(StorageLevel.DISK_ONLY)


def _scale_boost(spark, d):
    data = _kept(split_rows(scale_rows(spark, d)))
    model, = boosting.boost(data, SCALE_COLS, [BOOST], role="split", max_bins=TREE_BINS, method="width")
    return data, model


def boost_nodes(spark, d):
    _, model = _scale_boost(spark, d)
    return r6(nodes.node_table(spark, model.nodes).select("tree_id", "node_id", "feature", "threshold", "n_samples", "cover", "value", "gain"),
              "threshold", "cover", "value", "gain")


def boost_history(spark, d):
    data, model = _scale_boost(spark, d)
    return r6(boosting.history_table(spark, [model]), "logloss", "accuracy")


def boost_scores(spark, d):
    data, model = _scale_boost(spark, d)
    scored = boosting.score_boost(data.where("split = 'test'"), model)
    return scored.groupBy(F.round("p1", 4).alias("p1"), "prediction").agg(F.count("*").alias("n"), F.sum("label").alias("positives"))


def split_gain_cover(spark, d):
    _, model = _scale_boost(spark, d)
    return r6(explain.split_gain_cover(nodes.node_table(spark, model.nodes)), "gain", "cover", "mean_samples")


def regularisation_table(spark, d):
    data = _kept(split_rows(scale_rows(spark, d)))
    return r6(compare.regularisation_table(data, SCALE_COLS, REG_SETTINGS, REG_BASE, max_bins=TREE_BINS, method="width"),
              "train_acc", "test_acc", "gap")


def boost_early_stop(spark, d):
    """Up to 1,000 rounds, until the test loss has not improved for 30."""
    data = split_rows(wide_numeric(spark, d)).persist()
    config = boosting.BoostConfig(n_rounds=1000, learning_rate=0.05, max_depth=4, subsample=0.8, colsample_bytree=0.8, gamma=1.0, reg_lambda=2.0)
    model = boosting.boost_early_stop(data, WIDE_COLS, config, "split", patience=30, eval_sets=["train", "test"])
    data.unpersist()
    return boosting.history_table(spark, [model]).withColumn("kept", F.col("iteration") < model.config.n_rounds)


def _gbt(spark, data, cols, configs, **kw):
    """Log-odds models side by side; the data is released."""
    data = _kept(data)
    models = boosting.boost(data, cols, configs, role="split", **kw)
    data.unpersist()
    return models


def gbt_nodes(spark, d):
    """The first rounds of log-odds boosting with a square-root subset of features at every split."""
    config = boosting.log_odds_config(GBT_ROUNDS, max_features="sqrt", subsample=0.8)
    model, = _gbt(spark, split_rows(scale_rows(spark, d)), SCALE_COLS, [config], max_bins=TREE_BINS, method="width", track=False)
    return r6(nodes.node_table(spark, model.nodes).select("tree_id", "node_id", "feature", "threshold", "n_samples", "cover", "value", "gain"),
              "threshold", "cover", "value", "gain")


def gbt_staged_loss(spark, d):
    """Loss and accuracy after each of 100 rounds."""
    config = boosting.log_odds_config(100, 0.1, 3, subsample=0.8, max_features="sqrt")
    model, = _gbt(spark, split_rows(wide_numeric(spark, d)), WIDE_COLS, [config])
    return boosting.history_table(spark, [model]).select(F.col("eval_set").alias("split"), "iteration", F.col("logloss").alias("log_loss"), "accuracy")


def gbt_early_stop(spark, d):
    """Up to 300 rounds, until the loss of an inner hold-out has not fallen by 1e-4 in 20."""
    data = split_rows(wide_numeric(spark, d))
    inner = resample.stratified_split(data.where("split = 'train'").drop("split"), test_fraction=0.2, seed=43, names=("train", "valid"))
    model, = _gbt(spark, inner, WIDE_COLS, [boosting.log_odds_config(300, 0.05, 3, subsample=0.8)], no_change=(20, 1e-4))
    losses = boosting.history_table(spark, [model]).where("eval_set = 'valid'")
    return metrics.window_stop(losses, 20, 1e-4, loss="logloss")


def gbt_rate_table(spark, d):
    """Five pairs of learning rate and rounds, grown side by side."""
    configs = [boosting.log_odds_config(n, rate, name=f"lr={rate}, n={n}") for rate, n in RATES]
    models = _gbt(spark, split_rows(mixed_types(spark, d)), MIXED_COLS, configs, track={n - 1 for _, n in RATES})
    return compare.last_scores(spark, models, {c.name: {"lr": c.learning_rate, "n": c.n_rounds} for c in configs})


def residual_boosting(spark, d):
    return r6(boosting.residual_boosting(sine_rows(spark, d), ["x"], method="width"), "mse")


# --- explanations -------------------------------------------------------------------------------------------------

def shap_values(spark, d):
    data, model = _scale_boost(spark, d)
    return r6(explain.shap_values(data.where("split = 'test'"), model.nodes, SCALE_COLS), "phi")


def shap_global(spark, d):
    data, model = _scale_boost(spark, d)
    return r6(explain.shap_global(explain.shap_values(data.where("split = 'test'"), model.nodes, SCALE_COLS)), "mean_abs_phi", "direction")


def shap_local(spark, d):
    data, model = _scale_boost(spark, d)
    row = data.where("split = 'test'").agg(F.min("row_id")).first()[0]
    return r6(explain.shap_local(explain.shap_values(data.where("split = 'test'"), model.nodes, SCALE_COLS), row), "phi")


def importance_by_model(spark, d):
    data, found = _mixed_forest(spark, d)
    one, _ = forest.grow_tree(data.where("split = 'train'"), MIXED_COLS, FOREST_DEPTH, FOREST_BINS, "width")
    parts = [explain.impurity_importance(nodes.node_table(spark, n), MIXED_COLS).select(F.lit(m).alias("model"), "feature", "importance")
             for m, n in (("forest", found), ("tree", one))]
    return r6(explain.importance_by_model(parts[0].unionByName(parts[1]).withColumn("importance", F.round("importance", 6)), 3), "importance")


def interpretability_summary(spark, d):
    data, found = _mixed_forest(spark, d)
    one, _ = forest.grow_tree(data.where("split = 'train'"), MIXED_COLS, FOREST_DEPTH, FOREST_BINS, "width")
    tree = nodes.tree_summary(nodes.node_table(spark, one)).select(
        F.lit("tree").alias("model"), F.lit(1).alias("n_trees"), "depth", "leaves", F.col("root_feature").alias("top_feature"),
        F.lit(None).cast("double").alias("oob_score"))
    top = explain.top_features(explain.impurity_importance(nodes.node_table(spark, found), MIXED_COLS), 1).first()["feature"]
    oob = forest.oob_curve(data.where("split = 'train'"), found, MIXED_COLS).where(F.col("n_trees") == FOREST_TREES)
    size = nodes.tree_summary(nodes.node_table(spark, found)).agg(F.max("depth").alias("d"), F.sum("leaves").alias("l")).first()
    wood = oob.select(F.lit("forest").alias("model"), "n_trees", F.lit(size.d).alias("depth"), F.lit(size.l).cast("long").alias("leaves"),
                      F.lit(top).alias("top_feature"), F.round("oob_score", 6).alias("oob_score"))
    return tree.unionByName(wood)


# --- comparisons --------------------------------------------------------------------------------------------------

def _fits():
    return {
        "Decision Tree": compare.spark_fit(forest.decision_tree(5), WIDE_COLS),
        "Random Forest": compare.spark_fit(forest.random_forest(10, 5), WIDE_COLS),
        "GBM": compare.spark_fit(boosting.gbt(5, 0.1, 3), WIDE_COLS),
        "Second Order": compare.boost_fit(boosting.BoostConfig(n_rounds=3, learning_rate=0.3, max_depth=3), WIDE_COLS, max_bins=16),
    }


def model_comparison(spark, d):
    data = split_rows(wide_numeric(spark, d)).persist()
    folded = resample.stratified_folds(data.where("split = 'train'"), 3).persist()
    return compare.model_comparison(data, folded, _fits(), 3)


def metric_matrix(spark, d):
    data = split_rows(wide_numeric(spark, d)).persist()
    folded = resample.stratified_folds(data.where("split = 'train'"), 2).persist()
    fits = {k: v for k, v in _fits().items() if k in ("Decision Tree", "Random Forest")}
    return compare.metric_matrix(compare.model_comparison(data, folded, fits, 2))


def cv_distribution(spark, d):
    folded = resample.stratified_folds(wide_numeric(spark, d), 10).persist()
    fits = {k: v for k, v in _fits().items() if k in ("Decision Tree", "Random Forest")}
    return compare.cv_distribution(compare.cv_scores(folded, fits, 10))


def grid_search(spark, d):
    data = resample.stratified_folds(split_rows(wide_numeric(spark, d)), 3, seed=44).persist()
    grid = {"n_rounds": [2, 4], "learning_rate": [0.1, 0.3], "max_depth": [2, 3], "subsample": [0.7, 0.9], "colsample_bytree": [0.7]}
    table_, best, final = compare.grid_search(data, WIDE_COLS, grid, 3, max_bins=16)
    test_acc = next(h["accuracy"] for h in final.history if h["eval_set"] == "test")
    chosen = ", ".join(f"{k}={best[k]}" for k in sorted(best))
    return table_.withColumns({"is_best": F.col("params") == chosen, "test_acc": F.when(F.col("params") == chosen, F.lit(test_acc))})


QUERIES: dict[str, Callable] = {f.__name__: f for f in (
    scan_numeric, scan_mixed, assemble_features, shape_report, sine_demo, sine_demo_round0, text_report,
    label_encode_target, target_classes, collapse_binary, drop_missing, encode_categoricals, coerce_numeric, clean_flow,
    class_filter, column_subset, relabel_codes, align_target, feature_name_join, class_distribution, class_ratio_by_split,
    describe_features, class_histograms, box_summary, box_outliers, fold_mean_std, best_param_first_tie,
    stratified_split, stratified_folds, split_repeated_ids, internal_holdout, bootstrap_weights, row_subsample, colsample_subset, permute_column,
    accuracy, confusion_matrix, specificity_recall, classification_report, roc_points, roc_points_reduced, auc_roc, log_loss,
    overfit_gap, metric_pivot, running_vote_accuracy, patience_stop, window_stop,
    gini_root_split, gini_node_splits, second_order_root_split, missing_routing, tree_nodes, tree_size, tree_report, tree_rules,
    tree_rules_text, depth_sweep, pruning_path, tree_size_by_alpha, alpha_sweep, pruned_tree_report, ml_tree_nodes,
    full_tree, full_tree_summary, cv_fold_scores, forest_nodes, forest_first_tree, oob_score, oob_convergence, oob_warm_start, forest_sizes, forest_size_sweep, mdi_importance,
    topk_features, permutation_scores, permutation_importance, boost_nodes, boost_history, boost_scores, split_gain_cover,
    regularisation_table, boost_early_stop, gbt_nodes, gbt_staged_loss, gbt_early_stop, gbt_rate_table, residual_boosting,
    shap_values, shap_global, shap_local, importance_by_model, interpretability_summary, model_comparison, metric_matrix,
    cv_distribution, grid_search)}

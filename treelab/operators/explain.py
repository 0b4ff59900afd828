"""Explanations: impurity, permutation and split/gain/cover importance, SHAP values, rankings."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from treelab.functions.storage import cut_lineage, local_table
from treelab.operators.metrics import accuracy
from treelab.operators.nodes import ForestPredictor, TreeArrays, broadcast_trees, rows_of, shuffled_predictions, vector_column
from treelab.operators.resample import permuted_blocks, permuted_values, received, row_positions


def impurity_importance(nodes: DataFrame, cols: list[str]) -> DataFrame:
    """Mean decrease in impurity: weighted gains per tree, normalised within the tree, averaged over trees."""
    root = nodes.where("node_id = 0").select("tree_id", F.col("cover").alias("total"))
    gains = nodes.where(~F.col("is_leaf")).join(root, "tree_id").groupBy("tree_id", "feature").agg(
        F.sum(F.col("gain") * F.col("cover") / F.col("total")).alias("s"))
    share = gains.withColumn("s", F.col("s") / F.sum("s").over(Window.partitionBy("tree_id")))
    n_trees = nodes.select("tree_id").distinct().count()
    known = share.groupBy("feature").agg((F.sum("s") / F.lit(float(n_trees))).alias("importance"))
    return _all_features(nodes, cols).join(known, "feature", "left").select(
        "feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))


def _all_features(df: DataFrame, cols: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField("feature", T.StringType())])
    return local_table(df.sparkSession, [{"feature": c} for c in cols], schema)


def top_features(importance: DataFrame, k: int, value: str = "importance") -> DataFrame:
    return importance.orderBy(F.desc(value), F.asc("feature")).limit(k)


def _positioned(df: DataFrame, cols: list[str], row_id: str, seed: int) -> DataFrame:
    return cut_lineage(row_positions(df.select(row_id, "label", *[F.col(c).cast("double").alias(c) for c in cols]), row_id, seed))


def permuted_rows(df: DataFrame, cols: list[str], repeats: int = 30, row_id: str = "row_id", seed: int = 42, shuffle: list[str] | None = None) -> DataFrame:
    """One row per (row, feature, repeat) in which that feature holds the shuffled value; ``shuffle`` names the features (default: all).

    The shuffled values of a row meet it once, as an array; the rows are written out after that, within the task.
    """
    shuffle = cols if shuffle is None else shuffle
    base = _positioned(df, cols, row_id, seed)
    sent = permuted_values(base, shuffle, repeats, base.count(), seed)
    received = sent.groupBy("pos").agg(F.collect_list(F.struct("slot", "permuted")).alias("got"))  # features x repeats of one row
    both = base.join(received, "pos").select(row_id, "label", *cols, F.explode("got").alias("g"))
    both = both.select("*", F.floor(F.col("g.slot") / repeats).cast("int").alias("i"), (F.col("g.slot") % repeats).cast("int").alias("rep"))
    name = F.element_at(F.array(*[F.lit(c) for c in shuffle]), F.col("i") + 1)
    both = both.withColumn("feature", name)
    return both.select(row_id, "label", "feature", "rep", *[F.when(F.col("feature") == c, F.col("g.permuted")).otherwise(F.col(c)).alias(c) for c in cols])


def _forest_scores(df: DataFrame, predict: ForestPredictor, cols: list[str], repeats: int, row_id: str, seed: int, shuffle: list[str]) -> DataFrame:
    """The accuracies of ``permuted_rows`` under a forest: a block of rows receives its shuffled values as arrays and is scored where it is."""
    base = _positioned(df, cols, row_id, seed)
    n, own, models = base.count(), len(shuffle) * repeats, predict.broadcast()
    of_model, asked = [cols.index(c) for c in predict.cols], [predict.cols.index(c) for c in shuffle]

    def run(block: pa.Table) -> pa.Table:
        got = received(block, own + len(cols) + 1, n)
        x, label, trees = np.ascontiguousarray(got[own:-1][of_model].T), got[-1], [TreeArrays.of(m.value) for m in models]
        hits = [int((found == label).sum()) for i, feature in enumerate(asked)
                for found in shuffled_predictions(trees, x, feature, got[i * repeats : (i + 1) * repeats])]
        return pa.table({"slot": pa.array(range(own), pa.int32()), "hits": pa.array(hits, pa.int64()), "n": pa.array([int((~np.isnan(label)).sum())] * own, pa.int64())})

    sums = permuted_blocks(base, cols, shuffle, repeats, n, seed).groupBy("block").applyInArrow(run, "slot int, hits long, n long")
    name = F.element_at(F.array(*[F.lit(c) for c in shuffle]), F.floor(F.col("slot") / repeats).cast("int") + 1)
    return sums.groupBy("slot").agg(F.try_divide(F.sum("hits"), F.sum("n")).alias("accuracy")).select(
        name.alias("feature"), (F.col("slot") % repeats).cast("int").alias("rep"), "accuracy")


def permutation_scores(df: DataFrame, predict, cols: list[str], repeats: int = 30, row_id: str = "row_id",
                       seed: int = 42, used: list[str] | None = None) -> DataFrame:
    """Accuracy per (feature, rep) with that feature shuffled; ``predict`` adds ``prediction`` to a table.

    ``used`` names the features that the model asks for; shuffling any other changes nothing, so it gets the accuracy as it is.
    A ``ForestPredictor`` scores the shuffled values as arrays; any other function gets a row per row, feature and repeat.
    """
    shuffle = [c for c in cols if used is None or c in used]
    parts = []
    if shuffle and isinstance(predict, ForestPredictor) and set(shuffle) <= set(predict.cols) <= set(cols):
        parts.append(_forest_scores(df, predict, cols, repeats, row_id, seed, shuffle))
    elif shuffle:
        parts.append(accuracy(predict(permuted_rows(df, cols, repeats, row_id, seed, shuffle)), ["feature", "rep"]))
    if len(shuffle) < len(cols):
        idle = F.array(*[F.lit(c) for c in cols if c not in shuffle])
        same = accuracy(predict(df)).withColumn("feature", F.explode(idle)).withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        parts.append(same.select("feature", "rep", "accuracy"))
    return reduce(DataFrame.unionByName, parts)


def permutation_importance(df: DataFrame, predict, cols: list[str], repeats: int = 30, row_id: str = "row_id",
                           seed: int = 42, used: list[str] | None = None) -> DataFrame:
    """Mean and population deviation of the accuracy lost when a feature is shuffled.

    All features and repeats are shuffled and scored in one job.
    """
    baseline = accuracy(predict(df)).first()[0]
    scores = permutation_scores(df, predict, cols, repeats, row_id, seed, used)
    drop = F.lit(baseline) - F.col("accuracy")
    return scores.groupBy("feature").agg(F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std"))


def split_gain_cover(nodes: DataFrame) -> DataFrame:
    """Split count, mean gain, mean cover (hessian sum) and mean row count per used feature."""
    return nodes.where(~F.col("is_leaf")).groupBy("feature").agg(
        F.count("*").alias("weight"), F.avg("gain").alias("gain"), F.avg("cover").alias("cover"),
        F.avg("n_samples").alias("mean_samples"))


def expected_value(nodes: DataFrame | list[dict], base_margin: float = 0.0) -> float:
    """The SHAP base value: leaf values weighted by the cover share of their path."""
    rows = rows_of(nodes)
    root = {r["tree_id"]: r["cover"] for r in rows if r["node_id"] == 0}
    return base_margin + sum(r["value"] * r["tree_weight"] * r["cover"] / root[r["tree_id"]] for r in rows if r["is_leaf"])


def shap_values(df: DataFrame, nodes: DataFrame | list[dict], cols: list[str], row_id: str = "row_id") -> DataFrame:
    """Path-dependent SHAP values: ``(row_id, feature, value, phi)``; phi and the base value add up to the margin."""
    total = None
    rows = rows_of(nodes)
    covers = {(r["tree_id"], r["node_id"]): r["cover"] for r in rows}
    for model in broadcast_trees(rows):
        members = set(model.value["tree_ids"])
        cover = np.array([covers[k] for k in sorted(covers) if k[0] in members])

        def phi(a: TreeArrays, x: np.ndarray, cover=cover) -> pd.Series:
            return pd.Series(list(_shap(a, cover, x)))

        part = vector_column(model, cols, phi, T.ArrayType(T.DoubleType()))
        total = part if total is None else F.zip_with(total, part, lambda u, v: u + v)
    cells = df.select(row_id, F.array(*[F.col(c).cast("double") for c in cols]).alias("x"), total.alias("phi"))
    cells = cells.select(row_id, "x", F.posexplode("phi").alias("i", "phi"))
    return cells.select(row_id, F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("i") + 1).alias("feature"),
                        F.element_at("x", F.col("i") + 1).alias("value"), "phi")


def _shap(a: TreeArrays, cover: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Shapley values of the rows of ``x``: per leaf, a polynomial over the features of its path.

    A feature on the path is known and met (o = 1), known and missed (0), or unknown (its cover share z).
    The coefficient of t^s in the product of (z + o*t) collects all subsets with s known features.
    """
    out = np.zeros(x.shape)
    for root in a.roots:
        stack = [(int(root), {})]
        while stack:
            at, path = stack.pop()
            if a.left[at] == at:
                _add_leaf(out, a.value[at] * a.weight[at], path)
                continue
            f = int(a.feature[at])
            v = x[:, f]
            left = np.where(np.isnan(v), a.missing_left[at], v <= a.threshold[at])
            for child, met in ((a.left[at], left), (a.right[at], ~left)):
                z0, o0 = path.get(f, (1.0, True))
                stack.append((int(child), {**path, f: (z0 * cover[child] / cover[at], met & o0)}))
    return out


def _add_leaf(out: np.ndarray, value: float, path: dict) -> None:
    k = len(path)
    size_weight = [math.factorial(s) * math.factorial(k - 1 - s) / math.factorial(k) for s in range(k)]
    for f, (z, o) in path.items():
        poly = [np.ones(len(out))] + [np.zeros(len(out)) for _ in range(k - 1)]
        for other, (zj, oj) in path.items():
            if other != f:
                for s in range(k - 1, 0, -1):
                    poly[s] = poly[s] * zj + poly[s - 1] * oj
                poly[0] = poly[0] * zj
        out[:, f] += value * (o - z) * sum(w * c for w, c in zip(size_weight, poly))


def shap_global(shap: DataFrame) -> DataFrame:
    """Mean absolute SHAP value per feature, with the direction as correlation of phi and value."""
    spread = F.stddev_pop("phi") * F.stddev_pop("value")
    return shap.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"),
                                       F.try_divide(F.covar_pop("phi", "value"), spread).alias("direction"))


def shap_local(shap: DataFrame, row, row_id: str = "row_id") -> DataFrame:
    """The contributions to one row's score, largest first."""
    return shap.where(F.col(row_id) == row).orderBy(F.desc(F.abs("phi")), "feature")


def importance_by_model(importances: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` features of each model with rank, and how many models have the feature in their top ``k``."""
    ranked = importances.withColumn("rank", F.rank().over(
        Window.partitionBy("model").orderBy(F.desc("importance")))).where(F.col("rank") <= k)
    return ranked.withColumn("n_models", F.count("*").over(Window.partitionBy("feature")))

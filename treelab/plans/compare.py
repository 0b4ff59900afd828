"""Model comparison, cross-validated scores, grid search and parameter tables."""

from __future__ import annotations

import itertools
import operator
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from treelab.functions.storage import local_table
from treelab.operators.boosting import BoostConfig, BoostModel, boost, gbt, score_boost
from treelab.operators.clean import metrics_wide
from treelab.operators.metrics import accuracy, auc
from treelab.operators.profile import box_summary
from treelab.sources.tables import assemble

#: Fits a model on a training table and returns a function that adds ``prediction`` and ``p1``.
Fit = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]


def spark_fit(estimator, cols: list[str]) -> Fit:
    """A Spark classifier as a ``Fit``."""
    def fit(train: DataFrame):
        model = estimator.fit(assemble(train, cols))
        return lambda df: model.transform(assemble(df, cols)).withColumn(
            "p1", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability")
    return fit


def boost_fit(config: BoostConfig, cols: list[str], row_id: str = "row_id", **kw) -> Fit:
    """A second-order boosted model as a ``Fit``."""
    def fit(train: DataFrame):
        model, = boost(train, cols, [config], row_id=row_id, track=False, **kw)
        return lambda df: score_boost(df, model).drop("margin")
    return fit


def score_models(df: DataFrame, models: dict[str, Callable], keep: list[str]) -> DataFrame:
    """The scored rows of all models below each other: ``(model, keep, label, prediction, p1)``."""
    parts = [predict(df).select(F.lit(name).alias("model"), *keep, F.col("label").cast("int").alias("label"),
                                F.col("prediction").cast("int").alias("prediction"), "p1")
             for name, predict in models.items()]
    return reduce(DataFrame.unionByName, parts)


def cv_scores(folded: DataFrame, fits: dict[str, Fit], k: int, fold: str = "fold", parallelism: int = 4) -> DataFrame:
    """Accuracy per model and fold: ``(model, fold, accuracy)``; up to ``parallelism`` fits run at a time."""
    def one(job):
        name, f = job
        predict = fits[name](folded.where(F.col(fold) != f).drop(fold))
        return score_models(folded.where(F.col(fold) == f), {name: predict}, [fold])

    with ThreadPool(parallelism) as pool:
        scored = pool.map(one, list(itertools.product(fits, range(k))))
    return accuracy(reduce(DataFrame.unionByName, scored), ["model", fold])


def model_comparison(data: DataFrame, folded: DataFrame, fits: dict[str, Fit], k: int = 5, split: str = "split",
                     fold: str = "fold") -> DataFrame:
    """One row per model: train and test accuracy, CV mean and deviation, AUC on the test rows."""
    train = data.where(F.col(split) == "train")
    models = {name: fit(train) for name, fit in fits.items()}
    scored = score_models(data, models, [split]).persist()
    acc = accuracy(scored, ["model", split])
    rows = acc.select("model", F.concat(split, F.lit("_acc")).alias("metric"), F.col("accuracy").alias("value"))
    area = auc(scored.where(F.col(split) == "test"), ["model"])
    rows = rows.unionByName(area.select("model", F.lit("auc_roc").alias("metric"), F.col("auc").alias("value")))
    cv = cv_scores(folded, fits, k, fold).groupBy("model").agg(F.avg("accuracy").alias("m"), F.stddev_pop("accuracy").alias("s"))
    for source, metric in (("m", "cv_mean"), ("s", "cv_std")):
        rows = rows.unionByName(cv.select("model", F.lit(metric).alias("metric"), F.col(source).alias("value")))
    return metrics_wide(rows, metrics=["train_acc", "test_acc", "cv_mean", "cv_std", "auc_roc"])


def metric_matrix(comparison: DataFrame) -> DataFrame:
    """The heat-map data: four metrics per model."""
    return comparison.select("model", "train_acc", "test_acc", "cv_mean", "auc_roc")


def cv_distribution(scores: DataFrame) -> DataFrame:
    """Box summary of the fold scores per model."""
    return box_summary(scores, "model", "accuracy")


def last_scores(spark: SparkSession, models: list[BoostModel], settings: dict[str, dict]) -> DataFrame:
    """Train and test accuracy after the last round of each model, next to its ``settings`` (by name)."""
    rows = []
    for m in models:
        last = {h["eval_set"]: h["accuracy"] for h in m.history if h["iteration"] == m.config.n_rounds - 1}
        rows.append({"label": m.config.name, "lr": settings[m.config.name]["lr"], "n": settings[m.config.name]["n"],
                     "train_acc": last.get("train"), "test_acc": last.get("test")})
    return local_table(spark, rows, T.StructType([T.StructField("label", T.StringType()), T.StructField("lr", T.DoubleType()), T.StructField("n", T.IntegerType()),
                                                  T.StructField("train_acc", T.DoubleType()), T.StructField("test_acc", T.DoubleType())]))


def regularisation_table(data: DataFrame, cols: list[str], settings: list[dict], base: BoostConfig, split: str = "split",
                         row_id: str = "row_id", **kw) -> DataFrame:
    """Train and test accuracy for several (gamma, lambda, alpha); all models are grown side by side."""
    configs = [replace(base, name=s["label"], gamma=s["gamma"], reg_lambda=s["lambda"], reg_alpha=s["alpha"]) for s in settings]
    models = boost(data, cols, configs, role=split, row_id=row_id, track={base.n_rounds - 1}, **kw)
    rows = []
    for s, m in zip(settings, models):
        acc = {h["eval_set"]: h["accuracy"] for h in m.history if h["iteration"] == m.config.n_rounds - 1}
        rows.append({**s, "train_acc": acc["train"], "test_acc": acc["test"], "gap": acc["train"] - acc["test"],
                     "leaves": sum(r["is_leaf"] for r in m.nodes)})
    schema = T.StructType([T.StructField("label", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in (
        "gamma", "lambda", "alpha", "train_acc", "test_acc", "gap")], T.StructField("leaves", T.LongType())])
    return local_table(data.sparkSession, rows, schema)


def grid_points(grid: dict[str, list]) -> list[dict]:
    """All combinations; keys in sorted order, the last key changing fastest."""
    keys = sorted(grid)
    return [dict(zip(keys, values)) for values in itertools.product(*[grid[k] for k in keys])]


def grid_search(data: DataFrame, cols: list[str], grid: dict[str, list], k: int = 5, base: BoostConfig = BoostConfig(),
                split: str = "split", fold: str = "fold", row_id: str = "row_id", models_per_pass: int = 30,
                **kw) -> tuple[DataFrame, dict, BoostModel]:
    """Grid search over second-order boosting with k-fold accuracy on the training rows.

    ``n_rounds`` costs nothing: fewer rounds are a prefix of more. All other combinations times folds are
    grown ``models_per_pass`` at a time, and a fold's accuracy comes from its held-out margins. The best
    point (ties: the earliest) is fitted again on all training rows. Returns the score table, the best
    point and the final model, whose history holds its test accuracy.
    """
    points = grid_points(grid)
    rounds = sorted({p.get("n_rounds", base.n_rounds) for p in points})
    heads = [dict(t) for t in dict.fromkeys(tuple(sorted((a, b) for a, b in p.items() if a != "n_rounds")) for p in points)]
    jobs = [(h, f) for h in heads for f in range(k)]
    train = data.where(F.col(split) == "train")
    seen: dict = {}
    for start in range(0, len(jobs), models_per_pass):
        part = jobs[start:start + models_per_pass]
        configs = [replace(base, **h, n_rounds=rounds[-1], holdout_fold=f) for h, f in part]
        models = boost(train, cols, configs, fold=fold, row_id=row_id, track={r - 1 for r in rounds}, **kw)
        for (h, f), m in zip(part, models):
            for rec in m.history:
                if rec["eval_set"] == "holdout":
                    seen[(tuple(sorted(h.items())), rec["iteration"] + 1, f)] = rec["accuracy"]
    rows = []
    for i, p in enumerate(points):
        head = tuple(sorted((a, b) for a, b in p.items() if a != "n_rounds"))
        scores = [seen[(head, p.get("n_rounds", base.n_rounds), f)] for f in range(k)]
        mean = reduce(operator.add, scores) / k
        std = (sum((s - mean) ** 2 for s in scores) / k) ** 0.5
        rows.append({"point": i, "params": ", ".join(f"{a}={b}" for a, b in p.items()), "cv_mean": mean, "cv_std": std})
    best = points[max(range(len(rows)), key=lambda i: (rows[i]["cv_mean"], -i))]
    schema = T.StructType([T.StructField("point", T.IntegerType()), T.StructField("params", T.StringType()),
                           T.StructField("cv_mean", T.DoubleType()), T.StructField("cv_std", T.DoubleType())])
    table = local_table(data.sparkSession, rows, schema)
    config = replace(base, **best)
    final, = boost(data, cols, [config], role=split, row_id=row_id, track={config.n_rounds - 1}, **kw)
    return table, best, final

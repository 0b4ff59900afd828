"""Profiles of a feature table: distributions, describe, histograms, box summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from treelab.functions.ranks import exact_quantiles
from treelab.functions.storage import settle_small


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("count")).orderBy(F.desc("count"), label)


def class_ratio(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("n_rows"), F.avg(label).alias("class_ratio"))


def to_long(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """One row per (row, feature); NaN is missing, as null is."""
    keep = keep or []
    return df.select(*keep, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols]).unpivot(keep, cols, "feature", "value")


def describe(df: DataFrame, cols: list[str], digits: int = 2) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max per feature, rounded half-even."""
    long = to_long(df, cols)
    basic = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quart = exact_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75])
    quart = quart.groupBy("feature").agg(*[
        F.max(F.when(F.col("prob") == q, F.col("quantile"))).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)])
    out = basic.join(quart, "feature", "left")
    stats = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return out.select("feature", "count", *[F.bround(c, digits).alias(c) for c in stats])


def class_histograms(df: DataFrame, cols: list[str], label: str = "label", bins: int = 30) -> DataFrame:
    """Equal-width histogram of each feature within each class, over that class's own range.

    The last bin is closed on the right, a constant column gets the range value -/+ 0.5, and empty bins
    are listed with count 0.
    """
    long = to_long(df, cols, [label])
    rng = long.groupBy("feature", label).agg(F.min("value").alias("lo0"), F.max("value").alias("hi0"))
    flat = F.col("lo0") == F.col("hi0")
    rng = rng.select("feature", label, F.when(flat, F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                     F.when(flat, F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    rng = settle_small(rng)  # one row per feature and class, used twice
    index = F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    counts = (long.join(rng, ["feature", label]).where(F.col("value").isNotNull())
              .groupBy("feature", label, index.cast("int").alias("bin")).agg(F.count("*").alias("cnt")))
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, ["feature", label, "bin"], "left").select(
        "feature", label, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_left"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_right"),
        F.coalesce("cnt", F.lit(0)).cast("long").alias("count"))


def box_summary(long: DataFrame, series: str, value: str) -> DataFrame:
    """Median, quartiles, 1.5-IQR whiskers and outlier count per series."""
    fenced = _fences(long, series, value)
    inside = (F.col(value) >= F.col("fence_lo")) & (F.col(value) <= F.col("fence_hi"))
    return fenced.groupBy(series, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_lo"), F.max(F.when(inside, F.col(value))).alias("whisker_hi"),
        F.count(F.when(~inside, 1)).alias("n_outliers"))


def box_outliers(long: DataFrame, series: str, value: str) -> DataFrame:
    """The values outside the whiskers, one row each."""
    fenced = _fences(long, series, value)
    return fenced.where((F.col(value) < F.col("fence_lo")) | (F.col(value) > F.col("fence_hi"))).select(series, value)


def _fences(long: DataFrame, series: str, value: str) -> DataFrame:
    quart = settle_small(exact_quantiles(long, [series], value, [0.25, 0.5, 0.75]).groupBy(series).agg(*[
        F.max(F.when(F.col("prob") == q, F.col("quantile"))).alias(name)
        for q, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]))
    spread = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    quart = quart.withColumn("fence_lo", F.col("q1") - spread).withColumn("fence_hi", F.col("q3") + spread)
    return long.where(F.col(value).isNotNull()).select(series, value).join(quart, series)


def fold_mean_std(scores: DataFrame, by: list[str], value: str = "accuracy") -> DataFrame:
    """Mean and population deviation over folds."""
    return scores.groupBy(*by).agg(F.avg(value).alias("cv_mean"), F.stddev_pop(value).alias("cv_std"))


def mean_squared_error(df: DataFrame, y: str, pred: str) -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(y) - F.col(pred), 2)).alias("mse"))


def global_mean_prediction(df: DataFrame, y: str, out: str = "f0") -> DataFrame:
    """Every row predicted by the mean of ``y``: the start of boosting."""
    mean = df.agg(F.avg(y)).first()[0]
    return df.withColumn(out, F.lit(mean))


def best_param(curve: DataFrame, param: str, score: str) -> DataFrame:
    """The parameter with the highest score; of equal scores the smallest parameter (the first)."""
    return curve.orderBy(F.desc(score), F.asc(param)).limit(1).select(
        F.col(param).alias("best_param"), F.col(score).alias("best_score"))

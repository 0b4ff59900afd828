"""Evaluation of scored tables ``(label, prediction, p1)``, optionally per group (for instance per model)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from treelab.functions.ranks import bucketize, running_totals, splitters


def accuracy(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    return scored.groupBy(*(by or [])).agg(
        F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("accuracy"))


def overfit_gap(scored: DataFrame, split: str = "split", by: list[str] | None = None) -> DataFrame:
    """Train accuracy, test accuracy and their difference, in one pass."""
    hit = (F.col("label") == F.col("prediction")).cast("int")
    return scored.groupBy(*(by or [])).agg(F.avg(F.when(F.col(split) == "train", hit)).alias("train_acc"),
                      F.avg(F.when(F.col(split) == "test", hit)).alias("test_acc")
                      ).withColumn("gap", F.col("train_acc") - F.col("test_acc"))


def confusion_matrix(scored: DataFrame, classes: list[int] = (0, 1), by: list[str] | None = None) -> DataFrame:
    """All cells of the label x prediction grid, empty ones with 0; one aggregation, whose rows are then unfolded into cells."""
    cells = [(int(a), int(b)) for a in classes for b in classes]
    counts = scored.groupBy(*(by or [])).agg(*[
        F.count(F.when((F.col("label") == a) & (F.col("prediction") == b), 1)).alias(f"n_{a}_{b}") for a, b in cells])
    lines = [F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(f"n_{a}_{b}").alias("count")) for a, b in cells]
    return counts.select(*(by or []), F.inline(F.array(*lines)))


def binary_rates(scored: DataFrame, positive_label: int = 1, by: list[str] | None = None) -> DataFrame:
    """TN, FP, FN, TP with specificity and recall; an empty denominator gives null."""
    y, p = F.col("label") == positive_label, F.col("prediction") == positive_label

    def n(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    return scored.groupBy(*(by or [])).agg(
        n(~y & ~p).alias("tn"), n(~y & p).alias("fp"), n(y & ~p).alias("fn"), n(y & p).alias("tp")
    ).withColumn("specificity", F.try_divide("tn", F.col("tn") + F.col("fp"))
                 ).withColumn("recall", F.try_divide("tp", F.col("tp") + F.col("fn")))


def classification_report(scored: DataFrame, names: dict | None = None, classes: list[int] = (0, 1),
                          by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages; 0/0 is 0.

    One aggregation yields all counts; the report rows are built from the one row of each group.
    """
    def n(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    y, p = F.col("label"), F.col("prediction")
    counts = scored.groupBy(*(by or [])).agg(n(y == p).alias("hits"), F.count("*").alias("total"), *[e for k in classes for e in (
        n((y == k) & (p == k)).alias(f"tp{k}"), n(y == k).alias(f"support{k}"), n(p == k).alias(f"predicted{k}"))])
    for k in classes:
        counts = counts.withColumns({f"precision{k}": ratio(F.col(f"tp{k}"), F.col(f"predicted{k}")),
                                     f"recall{k}": ratio(F.col(f"tp{k}"), F.col(f"support{k}"))})
        counts = counts.withColumn(f"f1{k}", ratio(F.lit(2.0) * F.col(f"precision{k}") * F.col(f"recall{k}"),
                                                   F.col(f"precision{k}") + F.col(f"recall{k}")))
    stats = ("precision", "recall", "f1")

    def line(name: str, values: list[Column], support: Column) -> Column:
        return F.struct(F.lit(name).alias("class_name"), *[v.alias(s) for s, v in zip(stats, values)],
                        support.alias("support"))

    total = F.col("total")
    lines = [line((names or {}).get(k, str(k)), [F.col(f"{s}{k}") for s in stats], F.col(f"support{k}")) for k in classes]
    lines.append(line("accuracy", [ratio(F.col("hits"), total)] * 3, total))
    lines.append(line("macro avg", [reduce(Column.__add__, [F.col(f"{s}{k}") for k in classes]) / F.lit(float(len(classes)))
                                    for s in stats], total))
    lines.append(line("weighted avg", [ratio(reduce(Column.__add__, [F.col(f"{s}{k}") * F.col(f"support{k}")
                                                                     for k in classes]), total) for s in stats], total))
    return counts.select(*(by or []), F.inline(F.array(*lines)))


def score_counts(scored: DataFrame, by: list[str], score: str, positive_label: int, buckets: int) -> DataFrame:
    """Running counts of positives and negatives from the highest distinct score downwards.

    Scores are first reduced to one row per distinct value; the order is then built bucket by bucket.
    """
    down = scored.select(*by, (-F.col(score)).alias("down"), (F.col("label") == positive_label).cast("long").alias("pos"))
    edges = splitters(down, ["down"], buckets)
    counts = (bucketize(down, ["down"], edges, ["bucket"]).groupBy(*by, "bucket", "down")
              .agg(F.sum("pos").alias("pos"), F.sum(F.lit(1) - F.col("pos")).cast("long").alias("neg")))
    return running_totals(counts, by, "bucket", "down", ["pos", "neg"])


def roc_points(scored: DataFrame, by: list[str] | None = None, score: str = "p1", positive_label: int = 1,
               drop_collinear: bool = True, baseline: bool = False, buckets: int = 64) -> DataFrame:
    """ROC curve points ``(fpr, tpr, threshold)`` with the origin (threshold infinity).

    ``drop_collinear`` leaves out points in the middle of a straight run: those whose step (positives,
    negatives) repeats in the next point. ``baseline`` adds the two ends of the random-classifier line.
    """
    by = by or []
    run = score_counts(scored, by, score, positive_label, buckets)
    if drop_collinear:
        first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        bend = (F.col("next.pos") != F.col("pos")) | (F.col("next.neg") != F.col("neg"))
        run = run.where(first | F.col("next").isNull() | bend)
    kind = [F.lit("curve").alias("kind")] if baseline else []
    points = run.select(*by, *kind, F.try_divide("cum_neg", "tot_neg").alias("fpr"),
                        F.try_divide("cum_pos", "tot_pos").alias("tpr"), (-F.col("down")).alias("threshold"))
    heads = scored.select(*by).distinct() if by else scored.sparkSession.range(1)
    origin = heads.select(*by, *kind, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
                          F.lit(float("inf")).alias("threshold"))
    out = points.unionByName(origin)
    if baseline:
        for end in (0.0, 1.0):
            out = out.unionByName(heads.select(*by, F.lit("baseline").alias("kind"), F.lit(end).alias("fpr"),
                                               F.lit(end).alias("tpr"), F.lit(None).cast("double").alias("threshold")))
    return out


def auc(scored: DataFrame, by: list[str] | None = None, score: str = "p1", positive_label: int = 1,
        buckets: int = 64) -> DataFrame:
    """Area under the ROC curve; tied scores share half of their pairs. Null if a class is absent."""
    by = by or []
    run = score_counts(scored, by, score, positive_label, buckets)
    above = F.col("cum_pos") - F.col("pos")
    won = F.sum(F.col("neg").cast("double") * (above + F.col("pos") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return run.groupBy(*by).agg(F.try_divide(won, pairs).alias("auc"))


def log_loss(scored: DataFrame, by: list[str] | None = None, score: str = "p1", eps: float = 1e-15) -> DataFrame:
    return scored.groupBy(*(by or [])).agg(F.avg(log_loss_term(F.col("label"), F.col(score), eps)).alias("log_loss"))


def log_loss_term(label: Column, p1: Column, eps: float = 1e-15) -> Column:
    p = F.least(F.greatest(p1, F.lit(eps)), F.lit(1.0 - eps))
    return -F.when(label == 1, F.log(p)).otherwise(F.log(F.lit(1.0) - p))


def patience_stop(losses: DataFrame, patience: int, by: list[str] | None = None, iteration: str = "iteration",
                  loss: str = "loss", tol: float = 0.0) -> DataFrame:
    """Where a patience rule stops: the first run of ``patience`` rounds without a new best loss.

    Rounds count from 0. ``best_iteration`` is the first minimum up to the stop; a series that never stops
    ends at its last round. A series has one row per round, so it fits one window.
    """
    by = by or []
    key = by or [F.lit(0)]
    order = Window.partitionBy(*key).orderBy(iteration)
    before = F.min(loss).over(order.rowsBetween(Window.unboundedPreceding, -1))
    better = before.isNull() | (F.col(loss) < before - F.lit(tol))
    marked = losses.withColumn("__better", better).withColumn(
        "__best_at", F.max(F.when(F.col("__better"), F.col(iteration))).over(order))
    stop = F.min(F.when(F.col(iteration) - F.col("__best_at") >= patience, F.col(iteration))).over(Window.partitionBy(*key))
    kept = marked.withColumn("__stop", stop).where(F.col("__stop").isNull() | (F.col(iteration) <= F.col("__stop")))
    return kept.groupBy(*by).agg(
        F.max("__best_at").cast("int").alias("best_iteration"),
        F.max_by(loss, F.when(F.col("__better"), F.col(iteration))).alias("best_loss"),
        F.max(iteration).cast("int").alias("last_iteration"))


def window_stop(losses: DataFrame, n_no_change: int, tol: float = 1e-4, by: list[str] | None = None,
                iteration: str = "iteration", loss: str = "loss") -> DataFrame:
    """Early stop of the boosting classifier: the first round whose loss is not at least ``tol`` below
    any of the last ``n_no_change`` losses. ``n_estimators`` counts the trees kept, that round included.
    """
    by = by or []
    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy(iteration)
    recent = order.rowsBetween(-n_no_change, -1)
    stalled = (F.count("*").over(recent) == n_no_change) & (F.col(loss) + F.lit(tol) >= F.max(loss).over(recent))
    marked = losses.withColumn("__stop", stalled)
    return marked.groupBy(*by).agg(
        (F.coalesce(F.min(F.when(F.col("__stop"), F.col(iteration))), F.max(iteration)) + 1).cast("int").alias("n_estimators"),
        F.max("__stop").alias("stopped"))

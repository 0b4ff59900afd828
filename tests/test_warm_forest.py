"""Forests that grow on, and residual trees, against plain computations."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from treelab.operators import boosting, forest, nodes
from treelab.plans.queries import r6


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(300, 3)), 1)
    y = ((x[:, 0] + x[:, 1] > 0.3) ^ (rng.random(300) < 0.1)).astype(int)
    pdf = pd.DataFrame({"row_id": np.arange(300), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "label": y})
    return spark.createDataFrame(pdf).persist(), pdf


COLS = ["a", "b", "c"]


def test_going_on_equals_growing_at_once(spark, sample):
    df, _ = sample
    start = forest.warm_forest(df, COLS, 3)
    parts = forest.add_trees(forest.add_trees(forest.add_trees(start, 3), 1), 5)
    once = forest.add_trees(start, 9)
    assert parts.curve == once.curve and parts.nodes == once.nodes
    votes = lambda f: sorted(map(tuple, f.state.select("row_id", "votes", "ones").collect()))
    assert votes(parts) == votes(once)
    plain = forest.grow_forest(df, COLS, 9, 3)
    assert [r["threshold"] for r in plain] == [r["threshold"] for r in once.nodes]
    key = ["n_trees", "n_rows", "oob_score"]
    assert r6(forest.oob_curve(df, plain, COLS), "oob_score").select(key).orderBy("n_trees").collect() == r6(forest.warm_curve(once), "oob_score").select(key).collect()


def residual_tree(x, r, h, rows, depth):
    """Leaf of each row: splits by the fall of squared error, a Newton step per leaf."""
    best = None
    if depth and len(rows) > 1:
        for j in range(x.shape[1]):
            values = np.unique(x[rows, j])
            for low, high in zip(values, values[1:]):
                left = rows[x[rows, j] <= low]
                right = rows[x[rows, j] > low]
                gain = round((r[left].sum() ** 2 / len(left) + r[right].sum() ** 2 / len(right) - r[rows].sum() ** 2 / len(rows)) / len(rows), 10)
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, left, right)
    if best is None:
        return [(rows, r[rows].sum() / h[rows].sum())]
    return residual_tree(x, r, h, best[1], depth - 1) + residual_tree(x, r, h, best[2], depth - 1)


@pytest.mark.parametrize("cells", [0, 10**9])
def test_log_odds_boosting_equals_plain(spark, sample, monkeypatch, cells):
    """In one task or a job per level: the same margins as by trying every threshold."""
    monkeypatch.setattr(boosting, "TASK_CELLS", cells)
    df, pdf = sample
    x, y = pdf[COLS].to_numpy(), pdf["label"].to_numpy()
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    for _ in range(3):
        p = 1 / (1 + np.exp(-margin))
        for rows, step in residual_tree(x, y - p, p * (1 - p), np.arange(len(y)), 2):
            margin[rows] += 0.3 * step
    model, = boosting.boost(df, COLS, [boosting.log_odds_config(3, 0.3, 2)], max_bins=128)
    got = [r.margin for r in boosting.score_boost(df, model).orderBy("row_id").collect()]
    assert got == pytest.approx(list(margin), abs=1e-9)
    p = 1 / (1 + np.exp(-margin))
    assert model.history[-1]["logloss"] == pytest.approx(-np.log(np.where(y == 1, p, 1 - p)).mean())


def test_stops_when_nothing_changes(spark, sample):
    df, _ = sample
    model, = boosting.boost(df, COLS, [boosting.log_odds_config(40, 1.0, 1)], no_change=(3, 0.01))
    curve = [h["logloss"] for h in model.history]
    assert 4 <= len(curve) < 40 and curve[-1] + 0.01 >= max(curve[-4:-1])
    assert all(curve[i] + 0.01 < max(curve[i - 3:i]) for i in range(3, len(curve) - 1))
    assert {r["tree_id"] for r in nodes.rows_of(model.nodes)} == set(range(len(curve)))


def test_rounds_in_one_task_are_one_job_and_equal_those_over_a_table(spark, sample, monkeypatch):
    df, _ = sample
    df = df.withColumn("fold", F.col("row_id").cast("int") % 3).withColumn("split", F.when(F.col("row_id") % 5 == 0, "test").otherwise("train"))
    configs = [boosting.BoostConfig(name=str(i), n_rounds=n, learning_rate=0.3, max_depth=2, subsample=share, seed=seed, holdout_fold=fold)
               for i, (n, share, seed, fold) in enumerate([(4, 0.7, 1, None), (2, 0.7, 1, 0), (4, 0.4, 2, 1), (3, 1.0, 2, None)])]
    models = {}
    for cells in (0, 10**9):
        monkeypatch.setattr(boosting, "TASK_CELLS", cells)
        models[cells] = boosting.boost(df, COLS, configs, role="split", fold="fold")
    for a, b in zip(models[0], models[10**9], strict=True):
        assert [(r["tree_id"], r["node_id"], r["feature"], r["threshold"], r["n_samples"]) for r in a.nodes] == [
            (r["tree_id"], r["node_id"], r["feature"], r["threshold"], r["n_samples"]) for r in b.nodes]
        assert [r["value"] for r in a.nodes] == pytest.approx([r["value"] for r in b.nodes])
        key = lambda h: (h["iteration"], h["eval_set"])
        assert [(*key(h), pytest.approx(h["logloss"])) for h in sorted(a.history, key=key)] == [(*key(h), h["logloss"]) for h in sorted(b.history, key=key)]
    jobs = []
    for n in (1, 12):
        spark.sparkContext.setJobGroup(f"rounds {n}", "")
        boosting.boost(df, COLS, [boosting.BoostConfig(n_rounds=n, max_depth=2, subsample=0.5)], role="split")
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds {n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] > 0

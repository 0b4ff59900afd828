"""Fully grown trees against plain recursion, wherever the work is done."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from treelab.operators import exact, full_tree as full, grower


def plain(x, y, path=""):
    """Node table of a full tree by recursion over all thresholds."""
    n, s1 = len(y), int(y.sum())
    best = None
    if 0 < s1 < n:
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            for low, high in zip(values, values[1:]):
                left = y[x[:, j] <= low]
                right = y[x[:, j] > low]
                score = sum(((len(s) - s.sum()) ** 2 + s.sum() ** 2) / len(s) for s in (left, right)) - ((n - s1) ** 2 + s1 ** 2) / n
                gain = round(score / n, 10)
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, j, (low + high) / 2)
    out = {path: (n, s1, None if best is None else best[1], None if best is None else best[2])}
    if best:
        left = x[:, best[1]] <= best[2]
        out |= plain(x[left], y[left], path + "0") | plain(x[~left], y[~left], path + "1")
    return out


@pytest.fixture(scope="module")
def noisy():
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(220, 3)), 1)
    y = ((x[:, 0] > 0.2) ^ (rng.random(220) < 0.15)).astype(int)
    x[200:], y[200:] = x[0], np.arange(20) % 2  # equal rows of both classes: no split can part them
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "label": y, "part": ["test" if i % 7 == 0 else "train" for i in range(len(y))]}))


@pytest.mark.parametrize("task_rows", [1_000_000, 60])
def test_same_tree_wherever_it_grows(spark, noisy, task_rows):
    x, y = noisy
    df = frame(spark, x, y)
    nodes, hits = full.full_tree(df, ["a", "b", "c"], split="part", task_rows=task_rows)
    train = np.arange(len(y)) % 7 != 0
    want = plain(x[train], y[train])
    got = {r["path"]: r for r in nodes.collect()}
    assert set(got) == set(want)
    for path, (n, s1, feature, threshold) in want.items():
        r = got[path]
        assert (r["n_samples"], r["count_1"], r["is_leaf"], r["depth"]) == (n, s1, feature is None, len(path))
        assert feature is None or (r["feature"] == "abc"[feature] and r["threshold"] == pytest.approx(threshold))
    line = full.summary(nodes, hits).first()
    tree = full.grow_exact(x[train], y[train])
    assert line["test_acc"] == pytest.approx((full.predict_exact(tree, x[~train]) == y[~train]).mean())
    assert line["leaves"] == sum(v[2] is None for v in want.values())


def test_edges(spark, noisy):
    """Missing values are left out, a pure table is one leaf, an empty one has no node, a chain may be deep."""
    x, y = noisy
    df = frame(spark, x, y)
    holes = df.unionByName(df.limit(5).withColumn("b", F.lit(float("nan")))).unionByName(df.limit(5).withColumn("c", F.lit(None).cast("double")))
    count = lambda t: {r["path"]: r["n_samples"] for r in full.full_tree(t, ["a", "b", "c"])[0].collect()}
    assert count(holes) == count(df)
    assert list(count(df.withColumn("label", F.lit(1))).values()) == [220]
    assert count(df.limit(0)) == {}
    chain = spark.range(400).selectExpr("id AS a", "0 AS b", "0 AS c", "CAST(id % 2 AS INT) AS label")
    nodes, hits = full.full_tree(chain, ["a", "b", "c"])
    line = full.summary(nodes, hits).first()
    assert line["train_acc"] == 1.0 and line["leaves"] == 400


def test_missing_values_take_no_part_in_exact_splits(spark):
    rows = [(float(i) if i % 10 else float("nan"), int(i >= 50)) for i in range(100)]
    df = spark.createDataFrame(rows, "x double, label int").selectExpr("x", "0 AS node", "1D - label AS s0", "CAST(label AS DOUBLE) AS s1")
    r = exact.exact_splits(df, ["x"], grower.GiniRule(), buckets=4).first()
    assert (r["l_n"], r["t_n"], r["gain"]) == (45, 90, 0.5)

"""Work that must stay in the tasks: draws, votes and splits leave them as sums, and equal the plain way of computing them."""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from treelab.functions.hashing import POISSON_CDF
from treelab.operators import boosting, explain, forest, full_tree as full, grower, nodes, resample
from treelab.operators.bins import fit_bins
from treelab.sources import tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 2)), 2)
    y = ((x[:, 0] > 0.1) ^ (rng.random(400) < 0.1)).astype(int)
    return spark.createDataFrame(pd.DataFrame({"row_id": np.arange(400), "a": x[:, 0], "b": x[:, 1], "label": y,
                                               "split": np.where(np.arange(400) % 4 == 0, "test", "train")}))


@pytest.mark.parametrize("first", [0, 3, 8])
def test_bags_are_drawn_from_the_digits_of_one_md5_for_four_trees(spark, first):
    ids = spark.createDataFrame([(i,) for i in [None, *range(40)]], "row_id int")
    wide = resample.packed_weights(resample.bootstrap_weights(ids, 6, first=first, out="list"), 6, first=first)
    for r in wide.collect():
        key = "42" if r["row_id"] is None else f"{r['row_id']}:42"
        units = [int(hashlib.md5(f"{key}:{t // 4}".encode()).hexdigest()[8 * (t % 4):8 * (t % 4) + 8], 16) / 2**32 for t in range(first, first + 6)]
        want = [sum(u >= step for step in POISSON_CDF) for u in units]
        assert list(r["list"]) == want and list(r["bag"]) == want


def test_forest_curve_adds_up_votes_where_the_rows_are(rows):
    found = forest.grow_forest(rows.where("split = 'train'"), ["a", "b"], 9, 3)
    curve = forest.forest_size_curve(rows, found, ["a", "b"])
    assert "array<double>" not in plan_of(curve) and "ArrowEvalPython" not in plan_of(curve)  # no list of votes per row
    plain = forest.prefix_accuracy(rows.select("split", "label", nodes.tree_values(found, ["a", "b"]).alias("p")))
    assert sorted(map(tuple, curve.collect())) == sorted(map(tuple, plain.collect()))


def test_walks_send_missing_values_where_the_node_says(spark):
    rows = [{"tree_id": 0, "node_id": 0, "depth": 0, "feature_idx": 0, "threshold": 1.0, "missing_left": False, "left_id": 1, "right_id": 2,
             "is_leaf": False, "value": 0.0, "tree_weight": 1.0},
            *[{"tree_id": 0, "node_id": i, "depth": 1, "feature_idx": None, "threshold": None, "missing_left": None, "left_id": None, "right_id": None,
               "is_leaf": True, "value": float(i), "tree_weight": 1.0} for i in (1, 2)]]
    tree = nodes.TreeArrays(rows)
    assert tree.value[tree.leaves(np.array([[1.0], [2.0], [np.nan], [np.inf], [-np.inf]]))[:, 0]].tolist() == [1.0, 2.0, 2.0, 2.0, 1.0]


def test_wide_nodes_are_split_by_looking_into_few_buckets(spark, monkeypatch):
    """The top of a full tree over ties, mass points and noise is the one a task finds, and most values are never sent."""
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.normal(size=3000), rng.integers(0, 5, 3000), np.round(rng.normal(size=3000), 1)])
    y = ((x[:, 0] > 1.0) ^ (rng.random(3000) < 0.05)).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "label": y}))
    monkeypatch.setattr(full, "BUCKETS", 64)
    sums = np.zeros((8, 2))
    sums[:, 0], sums[3:5, 1], sums[5, 0] = 50, 40, 0
    feature, bucket, before, following = full._open_buckets(sums, np.array([0, 8]))
    assert bucket.tolist() == [2, 3, 4] and following.tolist() == [3, 4, 6] and before[1].tolist() == [150, 0]
    want = full.grow_exact(x, y)
    got = {r["path"]: r for r in full.full_tree(df, ["a", "b", "c"], task_rows=100)[0].collect()}
    assert set(got) == set(want)
    for path, (s0, s1, j, threshold, gain) in want.items():
        r = got[path]
        assert (r["count_0"], r["count_1"], r["feature"], r["threshold"], r["gain"]) == (s0, s1, None if j is None else "abc"[j], threshold, gain)


def test_rounds_pass_rows_in_blocks(spark, rows, monkeypatch):
    """A pass over the rows of a round moves blocks, not records, and gives what one task gives."""
    config = boosting.BoostConfig(n_rounds=12, max_depth=2, subsample=0.7, base_score="prior")
    state = grower.packed(rows.select("label", "a", "b"), fit_bins(rows, ["a", "b"]), ["label"], in_blocks=True)
    held = state.collect()
    assert state.columns == ["block", "n"] and sum(r["n"] for r in held) == 400 and len(held) <= 8
    fits = []
    for cells in (10**9, 0):
        monkeypatch.setattr(boosting, "TASK_CELLS", cells)
        fits += boosting.boost(rows, ["a", "b"], [config], role="split")
    one, many = fits
    assert [(r["feature"], r["threshold"], r["n_samples"]) for r in one.nodes] == [(r["feature"], r["threshold"], r["n_samples"]) for r in many.nodes]
    assert all(a["logloss"] == pytest.approx(b["logloss"]) for a, b in zip(sorted(one.history, key=str), sorted(many.history, key=str), strict=True) if a["eval_set"] == b["eval_set"])


def test_bins_need_one_pass_and_know_few_values(spark):
    df = spark.createDataFrame([(float(i % 5), float(i), None if i % 2 else 1.0, float("nan")) for i in range(200)], "a double, b double, c double, d double")
    bins = fit_bins(df.repartition(4), ["a", "b", "c", "d"], 8, "width")
    assert bins.edges == [[0.5, 1.5, 2.5, 3.5], [199.0 * k / 8 for k in range(1, 8)], [], []] and bins.missing


def test_a_spread_scan_gets_more_tasks_as_it_grows(spark, tmp_path):
    """Two files stand for two partitions of a scan: with fewer than cores they were spread over the cores alone, however much they held."""
    cores = spark.sparkContext.defaultParallelism
    counts = []
    for parts in (1, cores - 1):
        path = str(tmp_path / f"t{parts}")
        spark.range(0, 1000, 1, parts).write.parquet(path)
        size = spark.conf.get("spark.sql.files.openCostInBytes")
        spark.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
        try:
            df = tables.read_table(spark, path)
            counts.append(df.rdd.getNumPartitions())
            assert df.count() == 1000
        finally:
            spark.conf.set("spark.sql.files.openCostInBytes", size)
    assert counts == [cores, tables.PIECES * (cores - 2)]


def test_a_forest_scores_shuffled_blocks_as_it_scores_rows(spark, rows, monkeypatch):
    """Blocks of small and deep trees, with missing values and labels and an unused feature, equal a row per row, feature and repeat."""
    monkeypatch.setattr(resample, "BLOCK_VALUES", 1 << 10)
    found = forest.grow_forest(rows.where("split = 'train'"), ["a", "b"], 5, 3)
    test = rows.where("split = 'test'").select("row_id", F.when(F.col("row_id") % 7 > 0, F.col("a")).alias("a"), "b", F.lit(1.0).alias("c"),
                                               F.when(F.col("row_id") % 11 > 0, F.col("label")).alias("label")).persist()
    plain = explain.permutation_scores(test, lambda df: nodes.predict_forest(df, found, ["a", "b"]), ["b", "c", "a"], 4)
    want = sorted(map(tuple, plain.collect()))
    for per_level in (nodes.NODES_PER_LEVEL, 0):
        monkeypatch.setattr(nodes, "NODES_PER_LEVEL", per_level)
        got = explain.permutation_scores(test, nodes.ForestPredictor(found, ["a", "b"]), ["b", "c", "a"], 4, used=["a", "b"])
        assert [(f, r, pytest.approx(s)) for f, r, s in want] == sorted(map(tuple, got.collect()))
    assert "ArrowEvalPython" not in plan_of(explain.permutation_scores(test, nodes.ForestPredictor(found, ["a", "b"]), ["a", "b"], 4))  # no row per repeat
    assert explain.permutation_scores(test.limit(0), nodes.ForestPredictor(found, ["a", "b"]), ["a", "b"], 2).collect() == []


def test_shuffled_blocks_carry_what_single_values_carry(spark, monkeypatch):
    base = spark.range(700).selectExpr("id AS pos", "CAST(id AS DOUBLE) AS v", "CAST(id + 1000 AS DOUBLE) AS w", "CAST(id % 2 AS INT) AS label")
    want = sorted((r.pos, r.slot, r.permuted) for r in resample.permuted_values(base, ["w", "v"], 2, 700).collect())
    monkeypatch.setattr(resample, "SEND_VALUES", 900)
    for limit in (resample.MAX_PRODUCT_ROWS, 0):
        monkeypatch.setattr(resample, "MAX_PRODUCT_ROWS", limit)
        blocks = {}
        for r in resample.permuted_blocks(base, ["v", "w"], ["w", "v"], 2, 700).collect():
            blocks.setdefault(r.block, []).append(r.asDict())
        size, got = resample.block_rows(700, 7), []
        for k, part in blocks.items():
            values = resample.received(pa.Table.from_pylist(part), 7, 700)
            assert values[4].tolist() == [k * size + i for i in range(values.shape[1])] and values[6].tolist() == [x % 2 for x in values[4].tolist()]
            got += [(k * size + i, slot, values[slot, i]) for slot in range(4) for i in range(values.shape[1])]
        assert sorted(got) == want and len(blocks) > 1

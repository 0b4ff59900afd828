"""Forests over counted cells: bags are drawn row by row and added up, and the trees are those of a job per level over the rows."""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from treelab.functions.hashing import md5_units
from treelab.operators import cells, forest, grower, resample
from treelab.operators.bins import fit_bins

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.integers(0, 6, 1200), rng.integers(0, 3, 1200), np.round(rng.normal(size=1200))]).astype(float)
    y = ((x[:, 0] > 2) & (x[:, 2] < 0.6)) ^ (rng.random(1200) < 0.1)
    x[::13, 2] = np.nan
    return spark.createDataFrame(pd.DataFrame({"row_id": np.arange(1200), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "label": y.astype(int),
                                               "split": np.where(np.arange(1200) % 5 == 0, "test", "train")})).repartition(5).persist()


def test_md5_side_by_side_is_md5():
    texts = [b"", *[str(i * 7919).encode() for i in range(300)], *[b"x" * k for k in range(40, 80)]]
    for end, units in zip(ends := [b":0", b":12", b":124"], md5_units(texts, ends), strict=True):
        assert units.tolist() == [[int(hashlib.md5(t + end).hexdigest()[k : k + 8], 16) for k in (0, 8, 16, 24)] for t in texts]


def test_summed_weights_are_sums_of_weights():
    texts = [f"{i}:42".encode() for i in range(200)]
    starts = np.array([0, 1, 26, 51, 60, 180])
    drawn = resample._poisson_weights(pa.array(texts), 10, 0)
    weight, seen = resample.summed_weights(texts, 10, starts)
    assert weight.tolist() == np.add.reduceat(drawn.astype(int), starts, axis=0).tolist()
    assert seen.tolist() == np.add.reduceat((drawn > 0).astype(int), starts, axis=0).tolist()


def test_trees_grown_apart_are_those_of_a_job_per_level(spark, rows, monkeypatch):
    monkeypatch.setattr(forest, "BAG_ROWS", 200)
    train = rows.where("split = 'train'")
    bins = fit_bins(train, COLS, 8)
    binned = grower.packed(resample.packed_weights(train, 11, "row_id", 42), bins, ["label", "bag"], in_blocks=True)
    want = grower.grow_gini(binned, bins, 11, "bag", 4, 1.0, "sqrt", 42)
    assert cells.task_holds(bins) and forest.grow_forest(train, COLS, 11, 4, 8) == want
    monkeypatch.setattr(grower.Growth, "_level", None)  # before, every level was a job
    for chunk in (64, 1 << 16):
        monkeypatch.setattr(grower, "CHUNK", chunk)
        assert forest.grow_forest(train, COLS, 11, 4, 8) == want


def test_forests_too_large_for_a_task_grow_by_level(spark, rows, monkeypatch):
    train = rows.where("split = 'train'")
    want = forest.grow_forest(train, COLS, 3, 3, 8)
    monkeypatch.setattr(cells, "HELD_ROWS", 10)
    assert forest.grow_forest(train, COLS, 3, 3, 8) == want


def test_the_curve_counts_rows_between_the_same_thresholds_once(rows, monkeypatch):
    found = forest.grow_forest(rows.where("split = 'train'"), COLS, 7, 3, 8)
    some = rows.withColumn("label", F.when(F.col("row_id") % 11 > 0, F.col("label"))).withColumn("split", F.when(F.col("row_id") % 7 > 0, F.col("split")))
    counted = []
    count = forest.count_cells
    monkeypatch.setattr(forest, "count_cells", lambda *a: counted.append(count(*a)) or counted[-1])
    got = sorted(map(tuple, forest.forest_size_curve(some, found, COLS).collect()))
    assert counted[0].agg(F.sum("n")).first()[0] < 1200 / 2
    monkeypatch.setattr(cells, "MAX_CELLS", 0)
    assert got == sorted(map(tuple, forest.forest_size_curve(some, found, COLS).collect())) and len(counted) == 1

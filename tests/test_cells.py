"""Boosting over counted cells, over shares of rows and by models side by side: the same models as a job per level over all rows gives."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from treelab.functions import gang
from treelab.operators import boosting, cells
from treelab.operators.bins import fit_bins
from treelab.plans import queries

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 12, 900), rng.integers(0, 4, 900), np.round(rng.normal(size=900), 1)]).astype(float)
    y = ((x[:, 0] > 5) & (x[:, 2] < 0.6)) ^ (rng.random(900) < 0.1)
    x[::17, 2] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"row_id": np.arange(900), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "label": y.astype(int),
                                             "split": np.where(np.arange(900) % 5 == 0, "test", "train"), "fold": np.arange(900) % 3}))
    return df.repartition(6).persist()


def test_cells_hold_every_row_once(spark, rows, monkeypatch):
    """Each task passes its cells on in parts, and all rows of a cell come to one partition."""
    monkeypatch.setattr(cells, "COUNT_ROWS", 50)
    monkeypatch.setattr(cells, "HELD_CELLS", 60)
    bins = fit_bins(rows, COLS, 16)
    given = rows.select(F.when(F.col("row_id") > 3, F.col("split")).alias("role"), F.lit(None).cast("int").alias("fold"), "label", *COLS)
    counted = cells.count_cells(given, bins, 3)
    assert counted.rdd.getNumPartitions() == 3
    got, where = {}, {}
    for r in counted.withColumn("at", F.spark_partition_id()).collect():
        number = np.frombuffer(r["cells"], np.int64)
        for cell, n, x in zip(number.tolist(), np.frombuffer(r["counts"], np.int64).tolist(), cells.bins_of(number, bins).tolist(), strict=True):
            got[r["role"], r["label"], *x] = n
            assert where.setdefault(cell, r["at"]) == r["at"]
    want = {}
    for r in given.collect():
        x = [-1 if r[c] is None or np.isnan(r[c]) else int(np.searchsorted(e, r[c])) for c, e in zip(COLS, bins.edges)]
        want[r["role"], r["label"], *x] = want.get((r["role"], r["label"], *x), 0) + 1
    assert got == want and sum(got.values()) == 900


CONFIGS = {
    "newton": [boosting.BoostConfig(name=str(i), n_rounds=n, learning_rate=0.4, max_depth=d, subsample=share, seed=seed, holdout_fold=fold, reg_lambda=lam)
               for i, (n, d, share, seed, fold, lam) in enumerate([(4, 2, 0.7, 1, None, 1.0), (2, 3, 0.5, 1, 0, 5.0), (3, 1, 1.0, 2, 1, 1.0), (5, 2, 1.0, 2, None, 0.5)])],
    "log_odds": [boosting.log_odds_config(3, 0.3, 3, subsample=0.8, max_features="sqrt"), boosting.log_odds_config(5, 0.3, 2)],
}


@pytest.mark.parametrize("kind", CONFIGS)
def test_models_do_not_depend_on_who_holds_the_rows(rows, monkeypatch, kind):
    configs, kw = CONFIGS[kind], {"role": "split", "fold": "fold", "max_bins": 16}

    def fits(n, *_):
        monkeypatch.setattr(boosting, "_shares", lambda *a: ways[n])
        return boosting.boost(rows, COLS, configs, **kw)

    everything = list(range(len(configs)))
    ways = {"table": ([], False), "task": ([everything], False), "models": ([[0], everything[1:]], False), "gang": ([everything], True)}
    want = fits("table")
    for rows_or_cells in (1 << 24, 0):
        monkeypatch.setattr(cells, "MAX_CELLS", rows_or_cells)
        for way in ("task", "models", "gang"):
            for a, b in zip(want, fits(way), strict=True):
                assert [(r["tree_id"], r["node_id"], r["feature"], r["threshold"], r["missing_left"], r["n_samples"]) for r in a.nodes] == [
                    (r["tree_id"], r["node_id"], r["feature"], r["threshold"], r["missing_left"], r["n_samples"]) for r in b.nodes]
                assert [r["value"] for r in a.nodes] == pytest.approx([r["value"] for r in b.nodes])
                key = lambda h: (h["iteration"], h["eval_set"])
                assert [(*key(h), pytest.approx(h["logloss"]), h["accuracy"]) for h in sorted(a.history, key=key)] == [
                    (*key(h), h["logloss"], h["accuracy"]) for h in sorted(b.history, key=key)]


def test_boosting_counts_cells_and_needs_no_job_per_level(spark, rows, monkeypatch):
    """Rows that share their bins are one cell, whatever their number; before, a round over more than TASK_CELLS was a job per level."""
    monkeypatch.setattr(boosting, "TASK_CELLS", 0)
    monkeypatch.setattr(boosting, "TableRounds", None)
    seen = []
    shares = boosting._shares
    monkeypatch.setattr(boosting, "_shares", lambda n, *a: seen.append(n) or shares(n, *a))
    model, = boosting.boost(rows.union(rows).union(rows), COLS, [boosting.BoostConfig(n_rounds=8, max_depth=2)], role="split", max_bins=8)
    assert len({r["tree_id"] for r in model.nodes}) == 8 and model.nodes[0]["n_samples"] == 3 * 720
    assert len(seen) == 1 and seen[0] < 900


def test_tasks_share_rows_only_where_that_pays(monkeypatch):
    configs = [boosting.BoostConfig(n_rounds=n) for n in (500, 200, 100, 50, 10)]
    assert boosting._shares(1000, 6, 100, configs, 6, 200) == ([[0, 1, 2, 3, 4]], False)
    groups, together = boosting._shares(900_000, 6, 100, configs, 4, 10**7)
    assert not together and sorted(sum(groups, [])) == [0, 1, 2, 3, 4] and [0] in groups
    assert boosting._shares(5_000_000, 6, 100, configs, 6, 200) == ([[0, 1, 2, 3, 4]], True)
    assert boosting._shares(10**9, 6, 100, configs, 6, 200) == ([], False)


def test_a_gang_is_as_large_as_the_session(spark):
    assert gang.gang_size(spark) == spark.sparkContext.defaultParallelism
    conf = spark.sparkContext._jsc.sc().conf()
    with gang.anywhere(spark):
        assert conf.get("spark.locality.wait") == "0s"
    assert not conf.contains("spark.locality.wait")


def test_regularised_models_take_all_rounds(spark, data):
    """The reference fits 200 rounds of depth four; three of depth three were left."""
    assert (queries.REG_BASE.n_rounds, queries.REG_BASE.max_depth, queries.REG_BASE.learning_rate) == (200, 4, 0.1)
    table = {r["label"]: r["leaves"] for r in queries.regularisation_table(spark, data).collect()}
    assert len(table) == 5 and table["default"] > 200 * 3

"""Single trees and forests: Spark's own estimators, and bagged growth with out-of-bag scores."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, functions as F, types as T

from treelab.operators.bins import Bins, fit_bins
from treelab.functions.hashing import text_key
from treelab.functions.storage import cut_lineage, local_table
from treelab.operators.cells import bins_of, can_count, cell_sizes, cells_of, count_cells, task_holds
from treelab.operators.grower import (BINS, MAX_DEPTH, WEIGHTS, GiniRule, GiniSource, Growth, HeldBins, TaskGrowth, block_of, blocks, chunks, feature_choice,
                                      gini_leaf, grow_gini, matrix_of, node_rows, pack, packed, trees_per_pass)
from treelab.operators.nodes import TreeArrays, broadcast_trees, rows_of, tree_values
from treelab.operators.resample import RUN_ROWS, bootstrap_weights, packed_weights, summed_weights

#: Deepest tree Spark's estimators accept.
SPARK_MAX_DEPTH = 30
#: Cells that are walked down the trees together.
SCORED_ROWS = 1 << 14


def decision_tree(max_depth: int | None = None, max_bins: int = 32, seed: int = 42, **params) -> DecisionTreeClassifier:
    """Gini tree; without ``max_depth`` it grows as deep as Spark allows."""
    return DecisionTreeClassifier(maxDepth=SPARK_MAX_DEPTH if max_depth is None else max_depth, maxBins=max_bins,
                                  minInstancesPerNode=1, impurity="gini", seed=seed, **params)


def random_forest(n_trees: int = 100, max_depth: int | None = None, max_bins: int = 32, seed: int = 42,
                  **params) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=n_trees, featureSubsetStrategy="sqrt", maxBins=max_bins, seed=seed,
                                  maxDepth=SPARK_MAX_DEPTH if max_depth is None else max_depth, bootstrap=True, **params)


def regression_tree(max_depth: int = 2, label: str = "label", features: str = "features", max_bins: int = 32,
                    seed: int = 42) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(maxDepth=max_depth, labelCol=label, featuresCol=features, maxBins=max_bins, seed=seed)


def grow_tree(train: DataFrame, cols: list[str], max_depth: int = 5, max_bins: int = 32, method: str = "quantile",
              min_leaf: float = 1.0) -> tuple[list[dict], Bins]:
    """One gini tree by the shared grower; its node rows carry exact counts and impurities."""
    bins = fit_bins(train, cols, max_bins, method)
    binned = packed(train, bins, ["label"], in_blocks=True).persist()
    nodes = grow_gini(binned, bins, 1, None, max_depth, min_leaf)
    binned.unpersist()
    return nodes, bins


def grow_forest(train: DataFrame, cols: list[str], n_trees: int = 100, max_depth: int = 8, max_bins: int = 32,
                method: str = "quantile", row_id: str = "row_id", seed: int = 42) -> list[dict]:
    """Bagged gini trees with square-root feature subsets, all bags growing at once.

    Rows with equal bins and labels are added up to cells, with the sum of their weights per bag. Where a task can hold all cells, it grows some of
    the trees by itself; otherwise all trees take a job per level over the rows.
    """
    bins = fit_bins(train, cols, max_bins, method)
    if task_holds(bins):
        return _grow_apart(train, bins, n_trees, max_depth, row_id, seed)
    binned = packed(packed_weights(train, n_trees, row_id, seed), bins, ["label", "bag"], in_blocks=True).persist()
    nodes = grow_gini(binned, bins, n_trees, "bag", max_depth, 1.0, "sqrt", seed)
    binned.unpersist()
    return nodes


#: Trees that a task grows, a multiple of the four that share an md5, and rows whose bags are drawn together.
TREES_PER_TASK, BAG_ROWS = 8, 50_000


def _grow_apart(train: DataFrame, bins: Bins, n_trees: int, max_depth: int, row_id: str, seed: int) -> list[dict]:
    """The trees of ``grow_forest``, each grown by one task over all cells."""
    if max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth is at most {MAX_DEPTH}")
    edges, sizes, feats = [np.array(e) for e in bins.edges], cell_sizes(bins), feature_choice(bins.cols, "sqrt", seed)
    groups = -(-n_trees // TREES_PER_TASK)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["key"], b["label"], pa.array(cells_of(b, edges, sizes))], names=["key", "label", "cell"])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in chunks(batches):
            cell, label = t["cell"].to_numpy(), t["label"].to_numpy()
            order = np.lexsort((label, cell))
            cell, label = cell[order], label[order]
            first = np.flatnonzero(np.concatenate(([True], (np.diff(cell) != 0) | (np.diff(label) != 0))))
            place = np.arange(len(cell)) - np.repeat(first, np.diff(np.append(first, len(cell))))
            starts = np.flatnonzero(place % RUN_ROWS == 0)
            weight, seen = summed_weights(t["key"].take(pa.array(order)).cast(pa.binary()).combine_chunks().to_pylist(), n_trees, starts)
            cell, label = pa.array(cell[starts].astype(np.int32)), pa.array(label[starts].astype(np.float32))
            for g in range(groups):
                mine = slice(g * TREES_PER_TASK, (g + 1) * TREES_PER_TASK)
                block = block_of(pa.table({"cell": cell, "label": label, "weight": pack(weight[:, mine]), "seen": pack(seen[:, mine])}))
                yield block.append_column("place", pa.array([g], pa.int32()))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, held = 0, []
        for b in batches:
            if b.num_rows:
                g = b["place"][0].as_py()
                held += [(bins_of(t["cell"].to_numpy().astype(np.int64), bins), t["label"].to_numpy(), matrix_of(t["weight"], "<u1"), matrix_of(t["seen"], "<u1"))
                         for t in blocks([b])]
        if not held:
            return
        x, label, weight, seen = (np.concatenate(parts) for parts in zip(*held))
        held.clear()
        rows, items = HeldBins(x, len(x), bins), []
        for i in range(weight.shape[1]):
            w, n, tree = weight[:, i].astype(np.float32), seen[:, i].astype(np.float32), g * TREES_PER_TASK + i
            stats = [np.where(w > 0, w * (1 - label), np.float32(0)), np.where(w > 0, w * label, np.float32(0))], n
            growth = TaskGrowth(rows, lambda _, stats=stats: stats, GiniRule(), {tree: max_depth}, feats, bins)
            growth.grow(None, None)
            items += growth.nodes.items()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(items)], pa.binary())], names=["grown"])

    given = train.select(text_key(F.col(row_id), seed).alias("key"), F.col("label").cast("double").alias("label"),
                         *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(bins.cols)])
    drawn = given.mapInArrow(number, "key string, label double, cell long").repartition(max(1, -(-bins.rows // BAG_ROWS)), "cell").mapInArrow(
        draw, "block binary, n long, place int")
    grown = drawn.repartitionById(groups, F.col("place")).mapInArrow(grow, "grown binary")
    return node_rows([x for r in grown.collect() for x in pickle.loads(r["grown"])], bins, gini_leaf)  # the nodes of all trees, as any growth holds them


def cross_validated_trees(folded: DataFrame, cols: list[str], k: int, max_depth: int = 5, max_bins: int = 32,
                          method: str = "quantile", fold: str = "fold") -> list[dict]:
    """The trees of all k folds in one growth: tree f is grown on the rows outside fold f."""
    bins = fit_bins(folded, cols, max_bins, method)
    outside = F.array(*[(F.col(fold) != f).cast("tinyint") for f in range(k)])
    binned = packed(folded.withColumn("bag", outside), bins, ["label"], {"bag": WEIGHTS}, in_blocks=True).persist()
    nodes = grow_gini(binned, bins, k, "bag", max_depth)
    binned.unpersist()
    return nodes


def fold_scores(folded: DataFrame, nodes: list[dict], cols: list[str], fold: str = "fold") -> DataFrame:
    """Accuracy of tree f on the rows of fold f."""
    scored = folded.select(fold, "label", F.element_at(tree_values(nodes, cols, "prediction"), F.col(fold) + 1).alias("pred"))
    return scored.groupBy(fold).agg(F.avg((F.col("pred") == F.col("label")).cast("int")).alias("accuracy"))


def oob_curve(train: DataFrame, nodes: DataFrame | list[dict], cols: list[str], row_id: str = "row_id", seed: int = 42,
              uncovered_as_zero: bool = False) -> DataFrame:
    """Out-of-bag accuracy of every forest prefix: ``(n_trees, n_rows, oob_score, oob_error)``.

    Each row is voted on by the trees whose bag left it out. Running sums over the trees are taken within
    the row, so the whole curve is one scan with a map-side combine. Rows without a vote are left out,
    or counted as class 0.
    """
    rows = rows_of(nodes)
    n_trees = len({r["tree_id"] for r in rows})
    voted = bootstrap_weights(train, n_trees, row_id, seed, "bag").withColumn("p", tree_values(rows, cols))
    parts = voted.select(F.col("label").cast("int").alias("label"), "bag", "p").mapInPandas(
        _prefix_hits, "n_trees int, votes long, hits long, hits_zero long, n long")
    total = parts.groupBy("n_trees").agg(*[F.sum(c).alias(c) for c in ("votes", "hits", "hits_zero", "n")])
    score = (F.col("hits") + F.col("hits_zero")) / F.col("n") if uncovered_as_zero else F.try_divide("hits", "votes")
    seen = F.col("n") if uncovered_as_zero else F.col("votes")
    return total.select("n_trees", seen.alias("n_rows"), score.alias("oob_score"),
                        (F.lit(1.0) - score).alias("oob_error"))


def _prefix_hits(batches):
    for b in batches:
        if not len(b):
            continue
        out_of_bag = np.stack(b["bag"].to_numpy()) == 0
        p = np.stack(b["p"].to_numpy())
        label = b["label"].to_numpy()[:, None]
        votes = out_of_bag.cumsum(axis=1)
        # mean > 0.5 as sum > votes / 2; rounding keeps an exact half apart from its float noise
        ones = np.round((p * out_of_bag).cumsum(axis=1) - votes / 2.0, 9) > 0
        covered = votes > 0
        yield pd.DataFrame({
            "n_trees": np.arange(1, p.shape[1] + 1, dtype=np.int32), "votes": covered.sum(axis=0),
            "hits": ((ones == (label == 1)) & covered).sum(axis=0), "hits_zero": ((label == 0) & ~covered).sum(axis=0),
            "n": len(b)})


def forest_size_curve(df: DataFrame, nodes: DataFrame | list[dict], cols: list[str], split: str = "split") -> DataFrame:
    """Train and test accuracy of every forest prefix, from one growth.

    Rows between the same thresholds get the same votes and are counted as one. The votes of a row are added up where it is walked down the trees;
    only counts per split and prefix leave a task.
    """
    rows = rows_of(nodes)
    groups = broadcast_trees(rows)
    given = df.select(F.col(split).cast("string").alias("role"), F.lit(None).cast("int").alias("fold"), F.col("label").cast("int").alias("label"),
                      *[F.col(c).cast("double").alias(c) for c in cols])
    # no split stands between two values with the same thresholds around them
    bins = Bins(cols, [sorted({r["threshold"] for r in rows if r["feature"] == c and not r["is_leaf"] and math.isfinite(r["threshold"])}) for c in cols])

    def votes(names: list, code: np.ndarray, positive: np.ndarray, x: np.ndarray, n: np.ndarray, models: list[TreeArrays], total: dict) -> None:
        hits, ones = [], np.zeros(len(x))
        for model in models:
            for leaf in model.each_leaf(x):
                ones += model.value[leaf]
                fine = _majority(ones, len(hits) + 1) == positive
                hits.append(np.bincount(code[fine], n[fine], minlength=len(names)))
        seen = np.bincount(code, n, minlength=len(names))
        for i, name in enumerate(names):
            if seen[i]:
                total[name] = total.get(name, 0) + np.column_stack(([h[i] for h in hits], np.full(len(hits), seen[i])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = [TreeArrays.of(g.value) for g in groups]
        total: dict[str, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            if "cells" in b.schema.names:
                for r in b.to_pylist():
                    cells, n = np.frombuffer(r["cells"], np.int64), np.frombuffer(r["counts"], np.int64).astype(float)
                    for lo in range(0, len(cells), SCORED_ROWS):
                        at = bins_of(cells[lo : lo + SCORED_ROWS], bins)
                        # the greatest value of the bin; missing ones come last
                        x = np.column_stack([np.array([*e, np.inf, np.nan])[at[:, i]] for i, e in enumerate(bins.edges)])
                        votes([r["role"]], np.zeros(len(x), np.int64), np.full(len(x), r["label"] == 1), x, n[lo : lo + SCORED_ROWS], models, total)
                continue
            part = b["role"].dictionary_encode()
            names, code = part.dictionary.to_pylist(), part.indices.fill_null(len(part.dictionary)).to_numpy()
            x = np.column_stack([b[c].to_numpy(zero_copy_only=False) for c in cols])
            votes([*names, None], code, b["label"].fill_null(-1).to_numpy() == 1, x, np.ones(len(x)), models, total)
        for name, sums in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(sums), pa.string()), pa.array(np.arange(1, len(sums) + 1, dtype=np.int32)),
                                              pa.array(sums[:, 0].astype(np.int64)), pa.array(sums[:, 1].astype(np.int64))], names=["split", "n_trees", "hits", "n"])

    if can_count(bins):
        given = count_cells(given, bins, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return _prefix_table(given.mapInArrow(run, "split string, n_trees int, hits long, n long"))


def _majority(ones: np.ndarray, votes) -> np.ndarray:
    """Whether the sum of so many votes is above their half; within 5e-10 it is an exact half with float noise."""
    return (ones - votes / 2.0) * 1e9 > 0.5


def prefix_accuracy(voted: DataFrame) -> DataFrame:
    """Accuracy of the mean of the first n votes ``p`` (an array per row), for every n, per split."""
    parts = voted.select("split", F.col("label").cast("int").alias("label"), "p").mapInPandas(
        _prefix_accuracy, "split string, n_trees int, hits long, n long")
    return _prefix_table(parts)


def _prefix_table(parts: DataFrame) -> DataFrame:
    by = parts.groupBy("split", "n_trees").agg((F.sum("hits") / F.sum("n")).alias("acc"))
    return by.groupBy("n_trees").agg(F.max(F.when(F.col("split") == "train", F.col("acc"))).alias("train_acc"),
                                     F.max(F.when(F.col("split") == "test", F.col("acc"))).alias("test_acc"))


def _prefix_accuracy(batches):
    for b in batches:
        for name, part in b.groupby("split"):
            p = np.stack(part["p"].to_numpy())
            n = np.arange(1, p.shape[1] + 1, dtype=np.int32)
            ones = np.round(p.cumsum(axis=1) - n / 2.0, 9) > 0
            yield pd.DataFrame({"split": name, "n_trees": n, "n": len(part),
                                "hits": (ones == (part["label"].to_numpy()[:, None] == 1)).sum(axis=0)})


# --- forests that grow on ------------------------------------------------------------------------------------------------


@dataclass
class WarmForest:
    """A forest to which trees are added without growing the others again.

    ``state`` holds a packed record per training row with what its out-of-bag trees have voted so far; ``curve`` has a line per tree.
    Trees and votes depend on the number of a tree alone, so stopping and going on changes nothing.
    """

    bins: Bins
    state: DataFrame            # row_id, label, votes, ones, bins
    max_depth: int
    seed: int
    n_trees: int = 0
    nodes: list[dict] = field(default_factory=list)
    curve: list[dict] = field(default_factory=list)


def warm_forest(train: DataFrame, cols: list[str], max_depth: int = 8, max_bins: int = 32, method: str = "quantile", row_id: str = "row_id",
                seed: int = 42) -> WarmForest:
    """A forest without trees."""
    bins = fit_bins(train, cols, max_bins, method)
    rows = train.select(F.col(row_id).alias("row_id"), F.col("label").cast("int").alias("label"), F.lit(0).alias("votes"), F.lit(0.0).alias("ones"),
                        *[F.col(c).cast("double").alias(c) for c in cols])
    return WarmForest(bins, cut_lineage(packed(rows, bins, ["row_id", "label", "votes", "ones"])), max_depth, seed)


def add_trees(forest: WarmForest, n: int) -> WarmForest:
    """The forest with ``n`` more trees, its votes and its out-of-bag curve carried on."""
    spark = forest.state.sparkSession
    feats = feature_choice(forest.bins.cols, "sqrt", forest.seed)
    state, nodes, curve, first = forest.state, list(forest.nodes), list(forest.curve), forest.n_trees
    last = first + n
    while first < last:
        ids = range(first, min(first + trees_per_pass(forest.max_depth, n), last))
        rows = _with_bag(state, ids, forest.seed).persist()
        growth = Growth(spark, GiniRule(), dict.fromkeys(ids, forest.max_depth), feats, forest.bins)
        growth.grow(rows, GiniSource("bag", first))
        nodes += node_rows(list(growth.nodes.items()), forest.bins, gini_leaf)
        trees = spark.sparkContext.broadcast(growth.states(value=lambda _, rec: gini_leaf(rec)["value"]))
        curve += _oob_steps(rows, trees, first)
        state = cut_lineage(_voted(rows, trees, first))
        rows.unpersist()
        trees.unpersist()
        first = ids[-1] + 1
    return WarmForest(forest.bins, state, forest.max_depth, forest.seed, last, nodes, curve)


def warm_curve(forest: WarmForest) -> DataFrame:
    """``(n_trees, n_rows, oob_score, oob_error)`` after every tree."""
    schema = T.StructType([T.StructField("n_trees", T.IntegerType()), T.StructField("n_rows", T.LongType()), T.StructField("oob_score", T.DoubleType()),
                           T.StructField("oob_error", T.DoubleType())])
    return local_table(forest.state.sparkSession, forest.curve, schema)


def _with_bag(state: DataFrame, ids: range, seed: int) -> DataFrame:
    return packed_weights(state, len(ids), "row_id", seed, "bag", ids[0])


def _running_votes(b: pa.RecordBatch, trees: dict, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Votes and their sum of a batch's rows after each tree, by the trees whose bags left the row out."""
    x, bag = matrix_of(b["bins"], BINS), np.ascontiguousarray(matrix_of(b["bag"], WEIGHTS).T)
    votes, ones = b["votes"].to_numpy().copy(), b["ones"].to_numpy().copy()
    for t in sorted(trees):
        out = np.flatnonzero(bag[t - first] == 0)
        votes[out] += 1
        if len(out) and len(trees[t].value):
            ones[out] += trees[t].value[trees[t].walk(x[out])]
        yield votes, ones


def _voted(rows: DataFrame, trees, first: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                for votes, ones in _running_votes(b, trees.value, first):
                    pass
                b = b.set_column(names.index("votes"), "votes", pa.array(votes)).set_column(names.index("ones"), "ones", pa.array(ones))
            yield b.select(names[:-1])

    names = rows.columns
    return rows.mapInArrow(run, T.StructType(rows.schema.fields[:-1]))


def _oob_steps(rows: DataFrame, trees, first: int) -> list[dict]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(trees.value), 2), np.int64)
        for b in (x for x in batches if x.num_rows):
            label = b["label"].to_numpy() == 1
            for i, (votes, ones) in enumerate(_running_votes(b, trees.value, first)):
                covered = votes > 0
                total[i] += covered.sum(), ((np.round(ones - votes / 2.0, 9) > 0) == label)[covered].sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total[:, 0]), pa.array(total[:, 1])], names=["i", "votes", "hits"])

    sums = rows.mapInArrow(run, "i int, votes long, hits long").groupBy("i").agg(F.sum("votes").alias("votes"), F.sum("hits").alias("hits")).collect()
    out = []
    for r in sorted(sums, key=lambda r: r["i"]):  # a line per tree
        score = r["hits"] / r["votes"] if r["votes"] else None
        out.append({"n_trees": first + r["i"] + 1, "n_rows": r["votes"], "oob_score": score, "oob_error": None if score is None else 1.0 - score})
    return out

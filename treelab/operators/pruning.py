"""Cost-complexity pruning and the depth and alpha sweeps that need one grown tree only."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from treelab.operators.nodes import NODE_SCHEMA, TreeArrays, broadcast_trees, rows_of

PRUNED_SCHEMA = T.StructType([*NODE_SCHEMA.fields, T.StructField("prune_alpha", T.DoubleType())])


def prune_alphas(nodes: DataFrame) -> DataFrame:
    """Add ``prune_alpha``: the alpha from which a node is a leaf (0 for a leaf of the full tree).

    Each tree is handled by itself, many trees in parallel; a group is one tree's node rows.
    """
    return nodes.groupBy("tree_id").applyInPandas(_weakest_links, PRUNED_SCHEMA)


def _weakest_links(tree: pd.DataFrame) -> pd.DataFrame:
    """Weakest-link order of one tree: repeatedly turn the inner node with the least
    (own risk - risk of its leaves) / (leaves - 1) into a leaf."""
    tree = tree.sort_values("node_id").reset_index(drop=True)
    at = {n: i for i, n in enumerate(tree["node_id"])}
    total = float(tree.loc[at[0], "cover"])
    own = (tree["cover"] / total * tree["impurity"]).to_numpy(float)
    parent = [at[int(p)] if pd.notna(p) else -1 for p in tree["parent_id"]]
    kids: dict[int, list[int]] = {}
    for i, p in enumerate(parent):
        if p >= 0:
            kids.setdefault(p, []).append(i)
    deepest_first = sorted(range(len(tree)), key=lambda i: -tree["depth"][i])
    risk, leaves = own.copy(), np.ones(len(tree))
    for i in deepest_first:
        if i in kids:
            risk[i] = sum(risk[k] for k in kids[i])
            leaves[i] = sum(leaves[k] for k in kids[i])
    inner = np.array([i in kids for i in range(len(tree))])
    alpha = np.where(inner, np.inf, 0.0)
    link = np.full(len(tree), np.inf)
    link[inner] = (own[inner] - risk[inner]) / (leaves[inner] - 1)
    reached = 0.0
    heap = [(link[i], i) for i in range(len(tree)) if inner[i]]  # rows are in node order, so ties go to the lower node
    heapq.heapify(heap)
    while heap:
        value, weakest = heapq.heappop(heap)
        if value != link[weakest]:  # the node has collapsed, or its link has changed and stands further on
            continue
        reached = max(reached, value)
        gained, lost = own[weakest] - risk[weakest], leaves[weakest] - 1
        below = [weakest]
        for i in below:  # grows while walking: the whole subtree collapses
            if link[i] < np.inf:
                alpha[i], link[i] = reached, np.inf
            below.extend(kids.pop(i, []))
        i = parent[weakest]
        while i >= 0:
            risk[i] += gained
            leaves[i] -= lost
            link[i] = (own[i] - risk[i]) / (leaves[i] - 1)
            heapq.heappush(heap, (link[i], i))
            i = parent[i]
    return tree.assign(prune_alpha=alpha)


def pruning_path(pruned: DataFrame) -> DataFrame:
    """All effective alphas with the total leaf impurity at each, ascending, from 0."""
    alphas = pruned.select("tree_id", F.col("prune_alpha").alias("alpha")).where("alpha < double('infinity')")
    alphas = alphas.unionByName(pruned.select("tree_id", F.lit(0.0).alias("alpha"))).distinct()
    root = pruned.where("node_id = 0").select("tree_id", F.col("cover").alias("total"))
    leaf = _leaves_at(pruned, alphas).join(root, "tree_id")
    return leaf.groupBy("tree_id", "alpha").agg(
        F.sum(F.col("cover") / F.col("total") * F.col("impurity")).alias("total_impurity"))


def _leaves_at(pruned: DataFrame, alphas: DataFrame) -> DataFrame:
    """The leaves of every pruned tree: collapsed at alpha, while the parent is not."""
    parent = pruned.select("tree_id", F.col("node_id").alias("parent_id"), F.col("prune_alpha").alias("parent_alpha"))
    spans = pruned.join(parent, ["tree_id", "parent_id"], "left")
    return spans.join(alphas, "tree_id").where(
        (F.col("prune_alpha") <= F.col("alpha")) & (F.col("parent_alpha").isNull() | (F.col("parent_alpha") > F.col("alpha"))))


def tree_sizes(pruned: DataFrame) -> DataFrame:
    """Depth and leaves of the pruned tree at every effective alpha."""
    alphas = pruned.select("tree_id", F.col("prune_alpha").alias("alpha")).unionByName(
        pruned.select("tree_id", F.lit(0.0).alias("alpha"))).distinct()
    return _leaves_at(pruned, alphas).groupBy("tree_id", "alpha").agg(
        F.max("depth").alias("depth"), F.count("*").alias("leaves"))


def truncate(nodes: DataFrame | list[dict], max_depth: int) -> list[dict]:
    """The tree cut at ``max_depth``; greedy growth makes it the tree grown with that limit."""
    return _collapse(rows_of(nodes), lambda r: r["depth"] >= max_depth)


def prune(pruned: DataFrame | list[dict], alpha: float) -> list[dict]:
    """The tree pruned at ``alpha``. A depth limit comes first: truncate, then ``prune_alphas``, then this."""
    return _collapse(rows_of(pruned), lambda r: r["prune_alpha"] <= alpha)


def _collapse(rows: list[dict], stops) -> list[dict]:
    out, gone = [], set()
    for r in sorted(rows, key=lambda r: (r["tree_id"], r["depth"], r["node_id"])):
        key = (r["tree_id"], r["node_id"])
        if key in gone:
            gone.update((r["tree_id"], c) for c in (r["left_id"], r["right_id"]) if c is not None)
            continue
        if not r["is_leaf"] and stops(r):
            gone.update({(r["tree_id"], r["left_id"]), (r["tree_id"], r["right_id"])})
            r = {**r, "is_leaf": True, "feature_idx": None, "feature": None, "threshold": None, "missing_left": None,
                 "left_id": None, "right_id": None, "gain": None}
        out.append(r)
    return out


def one_tree(nodes: DataFrame | list[dict]) -> list[dict]:
    """The node rows, if they are of one tree."""
    rows = rows_of(nodes)
    if len({r["tree_id"] for r in rows}) > 1:
        raise ValueError("a sweep takes the nodes of one tree; call it once per tree")
    return rows


def depth_sweep(df: DataFrame, nodes: DataFrame | list[dict], cols: list[str], depths: list[int],
                split: str = "split") -> DataFrame:
    """Train and test accuracy of one deep tree cut at each depth: ``(depth, train_acc, test_acc)``."""
    model, = broadcast_trees(one_tree(nodes), "prediction")

    def at_depth(x: np.ndarray, label: np.ndarray) -> np.ndarray:
        arrays = TreeArrays.of(model.value)
        path = arrays.path(x, arrays.roots[0])
        return (arrays.value[path[:, [min(d, arrays.depth) for d in depths]]] == label[:, None]).sum(axis=0)

    return _accuracy_curve(df, cols, at_depth, "depth", depths, split)


def alpha_sweep(df: DataFrame, pruned: DataFrame | list[dict], cols: list[str], split: str = "split") -> DataFrame:
    """Train and test accuracy of one grown tree at every effective alpha."""
    rows = one_tree(pruned)
    alphas = sorted({0.0, *(r["prune_alpha"] for r in rows)})
    model, = broadcast_trees(rows, "prediction")
    start, = broadcast_trees(rows, "prune_alpha")

    def at_alpha(x: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Each node of a row's path decides from its own alpha up to that of the node above: count its hit in and out."""
        arrays = TreeArrays.of(model.value)
        path = arrays.path(x, arrays.roots[0])
        since = np.searchsorted(alphas, TreeArrays.of(start.value).value[path])  # not increasing on the way down
        until = np.concatenate((np.full((len(path), 1), len(alphas)), since[:, :-1]), axis=1)
        hit = arrays.value[path] == label[:, None]
        change = np.zeros(len(alphas) + 1, np.int64)
        np.add.at(change, since[hit], 1)
        np.add.at(change, until[hit], -1)
        return np.cumsum(change)[:-1]

    return _accuracy_curve(df, cols, at_alpha, "alpha", alphas, split)


def _accuracy_curve(df: DataFrame, cols: list[str], hits_of, param: str, values: list, split: str) -> DataFrame:
    """Accuracy per parameter value and split, for ``hits_of(features, labels)`` giving the number of hits per value.

    Hits are counted within each batch, so only (split, value) sums leave a task.
    """
    def count(batches):
        for b in batches:
            for name, part in b.groupby("split"):
                hits = hits_of(part[cols].to_numpy(float), part["label"].to_numpy())
                yield pd.DataFrame({"split": name, "i": np.arange(len(values)), "hits": hits, "n": len(part)})

    rows = df.select(F.col(split).alias("split"), F.col("label").cast("int").alias("label"),
                     *[F.col(c).cast("double").alias(c) for c in cols])
    parts = rows.mapInPandas(count, "split string, i int, hits long, n long")

    def share(name: str):
        mine = F.col("split") == name
        return (F.sum(F.when(mine, F.col("hits"))) / F.sum(F.when(mine, F.col("n")))).alias(f"{name}_acc")

    out = parts.groupBy("i").agg(share("train"), share("test"))
    return out.select(F.element_at(F.array(*[F.lit(v) for v in values]), F.col("i") + 1).alias(param),
                      "train_acc", "test_acc")

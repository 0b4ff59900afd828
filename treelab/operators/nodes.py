"""The node table: its schema, where it comes from, and routing rows through it.

A model is a table with one row per node. The grower writes it directly; a fitted Spark model is read
from its saved form. Rows are routed by a vectorised helper over the broadcast node arrays.
"""

from __future__ import annotations

import operator
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from treelab.functions.storage import local_table, shared_dir

NODE_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType()), T.StructField("node_id", T.IntegerType()),
    T.StructField("parent_id", T.IntegerType()), T.StructField("depth", T.IntegerType()),
    T.StructField("feature_idx", T.IntegerType()), T.StructField("feature", T.StringType()),
    T.StructField("threshold", T.DoubleType()), T.StructField("missing_left", T.BooleanType()),
    T.StructField("left_id", T.IntegerType()), T.StructField("right_id", T.IntegerType()),
    T.StructField("is_leaf", T.BooleanType()), T.StructField("impurity", T.DoubleType()),
    T.StructField("n_samples", T.LongType()), T.StructField("class_counts", T.ArrayType(T.DoubleType())),
    T.StructField("prediction", T.DoubleType()), T.StructField("value", T.DoubleType()),
    T.StructField("gain", T.DoubleType()), T.StructField("cover", T.DoubleType()),
    T.StructField("tree_weight", T.DoubleType())])

#: Nodes broadcast together; a larger ensemble is scored in several groups of trees.
NODES_PER_BROADCAST = 2_000_000


def node_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return local_table(spark, [{f.name: r.get(f.name) for f in NODE_SCHEMA} for r in rows], NODE_SCHEMA)


def rows_of(nodes: DataFrame | list[dict]) -> list[dict]:
    """Node rows on the driver (model-sized)."""
    if isinstance(nodes, list):
        return nodes
    return [r.asDict() for r in nodes.orderBy("tree_id", "node_id").collect()]


def model_nodes(model, cols: list[str]) -> list[dict]:
    """Node rows of a fitted Spark tree, forest or boosted-tree model, read from its saved form.

    ``value`` is the class-1 share for a classification tree and the prediction for a regression tree.
    """
    spark = SparkSession.active()
    path = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    weights = {0: 1.0}
    if "nodeData" in data.columns:
        meta = spark.read.parquet(f"{path}/treesMetadata")
        weights = {r[0]: r[1] for r in meta.select(meta.columns[0], meta.columns[-1]).collect()}
        data = data.select(F.col("treeID").alias("tree_id"), "nodeData.*")
    else:
        data = data.select(F.lit(0).alias("tree_id"), "*")
    classifier = "Classification" in type(model).__name__ and "GBT" not in type(model).__name__
    out, by_key = [], {}
    for r in data.orderBy("tree_id", "id").collect():
        leaf = r["leftChild"] < 0
        stats, idx = list(r["impurityStats"]), r["split"]["featureIndex"]
        node = {
            "tree_id": r["tree_id"], "node_id": r["id"], "parent_id": None, "depth": 0,
            "feature_idx": None if leaf else idx, "feature": None if leaf else cols[idx],
            "threshold": None if leaf else r["split"]["leftCategoriesOrThreshold"][0], "missing_left": None if leaf else False,
            "left_id": None if leaf else r["leftChild"], "right_id": None if leaf else r["rightChild"], "is_leaf": leaf,
            "impurity": r["impurity"], "n_samples": r["rawCount"], "class_counts": stats if classifier else None,
            "prediction": r["prediction"], "value": stats[1] / sum(stats) if classifier else r["prediction"],
            "gain": None if leaf else r["gain"], "cover": sum(stats) if classifier else stats[0],
            "tree_weight": weights.get(r["tree_id"], 1.0)}
        by_key[(r["tree_id"], r["id"])] = node
        out.append(node)
    for node in out:  # children have larger ids than their parent, so one pass sets the depth
        for child in (node["left_id"], node["right_id"]):
            if child is not None:
                by_key[(node["tree_id"], child)].update(parent_id=node["node_id"], depth=node["depth"] + 1)
    return out


class TreeArrays:
    """Node arrays of a group of trees; a leaf points at itself."""

    def __init__(self, rows: list[dict], value: str = "value"):
        rows = sorted(rows, key=lambda r: (r["tree_id"], r["node_id"]))
        at = {(r["tree_id"], r["node_id"]): i for i, r in enumerate(rows)}
        n = len(rows)
        self.tree_ids = sorted({r["tree_id"] for r in rows})
        self.roots = np.array([at[(t, 0)] for t in self.tree_ids], dtype=np.int64)
        inner = np.array([not r["is_leaf"] for r in rows])
        self.feature = np.array([r["feature_idx"] if i else 0 for r, i in zip(rows, inner)], dtype=np.int64)
        self.threshold = np.array([r["threshold"] if i else np.inf for r, i in zip(rows, inner)], dtype=float)
        self.missing_left = np.array([bool(r["missing_left"]) if i else True for r, i in zip(rows, inner)])
        self.left = np.array([at[(r["tree_id"], r["left_id"])] if i else k for k, (r, i) in enumerate(zip(rows, inner))],
                             dtype=np.int64)
        self.right = np.array([at[(r["tree_id"], r["right_id"])] if i else k for k, (r, i) in enumerate(zip(rows, inner))],
                              dtype=np.int64)
        self.value = np.array([r[value] for r in rows], dtype=float)
        self.weight = np.array([r["tree_weight"] for r in rows], dtype=float)
        self.node_id = np.array([r["node_id"] for r in rows], dtype=np.int64)
        self.depth = max((r["depth"] for r in rows), default=0)
        self.rows = n

    @classmethod
    def of(cls, fields: dict) -> "TreeArrays":
        out = cls.__new__(cls)
        out.__dict__.update(fields)
        return out

    def walk(self, x: np.ndarray, root: int):
        """Yield the current node of every row, from the root downwards."""
        pos = np.arange(len(x))
        at = np.full(len(x), root)
        yield at
        for _ in range(self.depth):
            v = x[pos, self.feature[at]]
            go_left = np.where(np.isnan(v), self.missing_left[at], v <= self.threshold[at])
            nxt = np.where(go_left, self.left[at], self.right[at])
            if (nxt == at).all():
                return
            at = nxt
            yield at

    def each_leaf(self, x: np.ndarray, roots: np.ndarray | None = None) -> Iterator[np.ndarray]:
        """Per tree (all, or those with the given roots), the position of the leaf each row ends in."""
        flat, first = np.ascontiguousarray(x).reshape(-1), np.arange(len(x)) * x.shape[1]
        holes = bool(np.isnan(flat).any())
        child = np.stack((self.left, self.right), axis=1).reshape(-1)
        for root in self.roots if roots is None else roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                v = flat.take(first + self.feature.take(at))
                right = v > self.threshold.take(at)
                if holes:
                    right |= np.isnan(v) & ~self.missing_left.take(at)
                nxt = child.take(2 * at + right)
                if (nxt == at).all():
                    break
                at = nxt
            yield at

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees) position of the leaf each row ends in."""
        out = np.empty((len(x), len(self.roots)), dtype=np.int64)
        for t, at in enumerate(self.each_leaf(x)):
            out[:, t] = at
        return out

    def asking(self, feature: int) -> np.ndarray:
        """Per tree, whether a split of it asks for the feature; the nodes of a tree begin with its root."""
        return np.logical_or.reduceat((self.feature == feature) & (self.left != np.arange(self.rows)), self.roots)

    def asks_below(self, node: int, feature: int) -> bool:
        """Whether the node or one below it asks for the feature."""
        return bool(self.left[node] != node and (self.feature[node] == feature or self.asks_below(self.left[node], feature)
                                                 or self.asks_below(self.right[node], feature)))

    def settled(self, node: int, feature: int, columns: np.ndarray, out: dict) -> dict:
        """The values below the topmost nodes with nothing below that asks for the feature, by node."""
        if not self.asks_below(node, feature):
            out[node] = self.chosen(node, columns, {})
        else:
            for side in (self.left[node], self.right[node]):
                self.settled(side, feature, columns, out)
        return out

    def chosen(self, node: int, columns: np.ndarray, known: dict) -> np.ndarray:
        """The value of the leaf below the node that each row ends in, by one choice for all rows at every node that is not known."""
        if node in known or self.left[node] == node:
            return known.get(node, self.value[node])
        v, threshold = columns[self.feature[node]], self.threshold[node]
        left = ~(v > threshold) if self.missing_left[node] else v <= threshold
        return np.where(left, self.chosen(self.left[node], columns, known), self.chosen(self.right[node], columns, known))

    def path(self, x: np.ndarray, root: int) -> np.ndarray:
        """(rows, depth + 1) nodes on the way down; the leaf repeats."""
        steps = list(self.walk(x, root))
        steps += [steps[-1]] * (self.depth + 1 - len(steps))
        return np.stack(steps, axis=1)


def tree_groups(rows: list[dict]) -> list[list[dict]]:
    """Trees in groups of at most ``NODES_PER_BROADCAST`` nodes (a group has at least one tree)."""
    groups, size = [[]], 0
    by_tree: dict = {}
    for r in rows:
        by_tree.setdefault(r["tree_id"], []).append(r)
    for _, tree in sorted(by_tree.items()):
        if groups[-1] and size + len(tree) > NODES_PER_BROADCAST:
            groups.append([])
            size = 0
        groups[-1].extend(tree)
        size += len(tree)
    return groups


def matrix(cols: tuple) -> np.ndarray:
    return np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in cols])


def tree_values(nodes: DataFrame | list[dict], cols: list[str], value: str = "value") -> Column:
    """Array with the leaf value of every tree (in tree order) for a row of raw features."""
    def each(arrays: TreeArrays, x: np.ndarray) -> pd.Series:
        return pd.Series(list(arrays.value[arrays.leaves(x)]))

    parts = [vector_column(model, cols, each, T.ArrayType(T.DoubleType())) for model in broadcast_trees(nodes, value)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def tree_sum(nodes: DataFrame | list[dict], cols: list[str], value: str = "value") -> Column:
    """Weighted sum of the leaf values over all trees: the margin of a boosted model."""
    def added(arrays: TreeArrays, x: np.ndarray) -> pd.Series:
        leaf = arrays.leaves(x)
        return pd.Series((arrays.value[leaf] * arrays.weight[leaf]).sum(axis=1))

    return reduce(operator.add, [vector_column(model, cols, added, T.DoubleType())
                                 for model in broadcast_trees(nodes, value)])


def broadcast_trees(nodes: DataFrame | list[dict], value: str = "value") -> list:
    """The node arrays, broadcast in groups of bounded size; a thread of its own has no active session, so the default one counts too."""
    context = SparkSession.active().sparkContext
    return [context.broadcast(vars(TreeArrays(group, value))) for group in tree_groups(rows_of(nodes))]


def vector_column(model, cols: list[str], fn, kind: T.DataType) -> Column:
    """``fn(arrays, feature matrix)`` as a vectorised column over the raw features."""
    @F.pandas_udf(kind)
    def apply(*x: pd.Series) -> pd.Series:
        return fn(TreeArrays.of(model.value), matrix(x))

    return apply(*[F.col(c).cast("double") for c in cols])


def predict_forest(df: DataFrame, nodes: DataFrame | list[dict], cols: list[str]) -> DataFrame:
    """Average the trees' class-1 shares: ``p1`` and ``prediction``."""
    rows = rows_of(nodes)
    n_trees = len({r["tree_id"] for r in rows})
    scored = df.withColumn("p1", tree_sum([{**r, "tree_weight": 1.0} for r in rows], cols) / F.lit(float(n_trees)))
    return scored.withColumn("prediction", (F.round(F.col("p1") - 0.5, 9) > 0).cast("int"))


class ForestPredictor:
    """``predict_forest`` with one model, as a function of a table; it also scores shuffled columns of arrays inside a task."""

    def __init__(self, nodes: DataFrame | list[dict], cols: list[str]):
        self.rows, self.cols = rows_of(nodes), cols

    def __call__(self, df: DataFrame) -> DataFrame:
        return predict_forest(df, self.rows, self.cols)

    def broadcast(self) -> list:
        return broadcast_trees(self.rows)


#: Nodes per tree and level up to which trees are evaluated node by node for all rows, and the deepest such tree; others are walked row by row.
NODES_PER_LEVEL, MAX_CHOICES_DEEP = 16, 64


def shuffled_predictions(models: list[TreeArrays], x: np.ndarray, feature: int, shuffled: np.ndarray) -> Iterator[np.ndarray]:
    """Predictions of ``predict_forest`` for the rows of ``x`` with one column replaced by each row of ``shuffled``.

    Trees that do not ask for the column are evaluated once, and so are the parts of small trees that do not.
    """
    x, columns, n_trees = x.copy(), np.ascontiguousarray(x.T), sum(len(m.roots) for m in models)
    rest, again = np.zeros(len(x)), []
    for m in models:
        asks = m.asking(feature)
        for leaf in m.each_leaf(x, m.roots[~asks]):
            rest += m.value.take(leaf)
        small = m.depth <= MAX_CHOICES_DEEP and m.rows <= NODES_PER_LEVEL * m.depth * len(m.roots)
        again.append((m, m.roots[asks], [m.settled(root, feature, columns, {}) for root in m.roots[asks]] if small else None))
    for values in shuffled:
        x[:, feature] = columns[feature] = values
        total = rest.copy()
        for m, roots, known in again:
            for part in (m.value.take(leaf) for leaf in m.each_leaf(x, roots)) if known is None else (m.chosen(r, columns, k) for r, k in zip(roots, known)):
                total += part
        yield total / n_trees - 0.5 >= 5e-10  # above 0 once rounded to nine places


def tree_summary(nodes: DataFrame) -> DataFrame:
    """Depth, leaves and root split per tree."""
    return nodes.groupBy("tree_id").agg(
        F.max("depth").alias("depth"), F.sum(F.col("is_leaf").cast("long")).alias("leaves"),
        F.max(F.when(F.col("node_id") == 0, F.col("feature"))).alias("root_feature"))


def node_report(nodes: DataFrame, max_depth: int | None = None, names: dict | None = None) -> DataFrame:
    """What a drawn tree shows per node: split, impurity, samples, class counts, class and purity."""
    if max_depth is not None:
        nodes = nodes.where(F.col("depth") <= max_depth)
    cls = F.col("prediction").cast("int")
    name = cls.cast("string")
    for code, text in (names or {}).items():
        name = F.when(cls == code, text).otherwise(name)
    counts = F.col("class_counts")
    return nodes.select(
        "tree_id", "node_id", "depth",
        F.when(~F.col("is_leaf"), F.concat_ws(" <= ", "feature", F.col("threshold").cast("string"))).alias("split"),
        "impurity", "n_samples", counts[0].alias("count_0"), counts[1].alias("count_1"), name.alias("class_name"),
        (F.greatest(counts[0], counts[1]) / (counts[0] + counts[1])).alias("purity"))


def leaf_rules(nodes: DataFrame) -> DataFrame:
    """One row per leaf: the conditions from the root joined by AND, in depth-first order.

    Walks up the parents with one join per level over the node table.
    """
    steps = nodes.where(~F.col("is_leaf")).select("tree_id", F.col("node_id").alias("up"), "feature", "threshold",
                                                  "left_id", F.col("parent_id").alias("up_parent"))
    current = nodes.where("is_leaf").select(
        "tree_id", "node_id", "prediction", "n_samples", "depth", F.col("node_id").alias("child"),
        F.col("parent_id").alias("up"), F.array().cast("array<string>").alias("conds"), F.lit("").alias("turns"))
    depth = nodes.agg(F.max("depth")).first()[0]
    for _ in range(depth):
        j = current.join(steps, ["tree_id", "up"], "left")
        went_left = F.col("child") == F.col("left_id")
        cond = F.concat(F.col("feature"), F.when(went_left, " <= ").otherwise(" > "),
                        F.format_string("%.6f", F.col("threshold")))
        has = F.col("feature").isNotNull()
        current = j.select(
            "tree_id", "node_id", "prediction", "n_samples", "depth",
            F.when(has, F.col("up")).otherwise(F.col("child")).alias("child"), F.col("up_parent").alias("up"),
            F.when(has, F.array_prepend("conds", cond)).otherwise(F.col("conds")).alias("conds"),
            F.when(has, F.concat(F.when(went_left, "0").otherwise("1"), F.col("turns"))).otherwise(F.col("turns")).alias("turns"))
    order = Window.partitionBy("tree_id").orderBy("turns")
    return current.select("tree_id", F.row_number().over(order).alias("leaf_no"), "node_id", "depth",
                          F.concat_ws(" AND ", "conds").alias("rule"), "prediction", "n_samples")


def rules_text(nodes: DataFrame) -> DataFrame:
    """Indented rule lines of one tree per ``tree_id``, in depth-first order."""
    turn = _turns(nodes)
    inner = nodes.where(~F.col("is_leaf")).join(turn, ["tree_id", "node_id"])
    bars = F.repeat(F.lit("|   "), F.col("depth"))
    number = F.format_string("%.2f", F.col("threshold"))
    branch = inner.select("tree_id", F.explode(F.array(
        F.struct(F.concat("turns", F.lit("0")).alias("pos"), F.concat(bars, F.lit("|--- "), F.col("feature"), F.lit(" <= "), number).alias("line")),
        F.struct(F.concat("turns", F.lit("1")).alias("pos"), F.concat(bars, F.lit("|--- "), F.col("feature"), F.lit(" >  "), number).alias("line")),
    )).alias("s")).select("tree_id", "s.*")
    leaf = nodes.where("is_leaf").join(turn, ["tree_id", "node_id"]).select(
        "tree_id", F.concat("turns", F.lit("-")).alias("pos"),
        F.concat(bars, F.lit("|--- class: "), F.col("prediction").cast("int").cast("string")).alias("line"))
    lines = branch.unionByName(leaf)
    # a branch line comes before everything below it: "0" < "0-" and "0" < "00"
    order = Window.partitionBy("tree_id").orderBy("pos")
    return lines.select("tree_id", F.row_number().over(order).alias("line_no"), "line")


def _turns(nodes: DataFrame) -> DataFrame:
    """Left/right turns from the root to every node, as text."""
    current = nodes.where("node_id = 0").select("tree_id", "node_id", F.lit("").alias("turns"), "left_id", "right_id")
    done = current.select("tree_id", "node_id", "turns")
    kids = nodes.select("tree_id", "node_id", F.col("left_id").alias("l"), F.col("right_id").alias("r"))
    for _ in range(nodes.agg(F.max("depth")).first()[0]):
        step = current.select("tree_id", F.explode(F.array(
            F.struct(F.col("left_id").alias("node_id"), F.concat("turns", F.lit("0")).alias("turns")),
            F.struct(F.col("right_id").alias("node_id"), F.concat("turns", F.lit("1")).alias("turns")))).alias("s"))
        current = step.select("tree_id", "s.*").join(kids, ["tree_id", "node_id"]).select(
            "tree_id", "node_id", "turns", F.col("l").alias("left_id"), F.col("r").alias("right_id"))
        done = done.unionByName(current.select("tree_id", "node_id", "turns"))
    return done

"""Level-wise tree growth for many trees at once, by partial histograms in arrays.

One Spark job per level, however many trees grow. A task walks its rows down the splits found so far, adds their statistics to one dense
array per tree (node, feature, bin, statistic) and emits an array per open node; the arrays are shuffled once, added up, and the best split of
a node is found where its sum is. Rows themselves do not move and nothing is kept between levels: a walk costs a few array look-ups a level,
which is less than writing a position per row and tree, and a lost executor only repeats its tasks. The arrays of one job stay within
``HIST_BYTES``; a wider level takes several jobs. Rows that fit one task grow all levels there.

What a row adds to a tree comes from a source: an object with ``columns``, ``prepare(batch)`` and ``stats(prepared, tree)``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from treelab.functions.hashing import ranked_subset
from treelab.functions.storage import LOCAL_ROWS
from treelab.operators.bins import Bins

#: Deepest level whose node numbers (children of n are 2n+1 and 2n+2) fit an int.
MAX_DEPTH = 29
#: Bytes of histograms that one task holds.
HIST_BYTES = 64 << 20
#: Rows that a task adds up in one go.
CHUNK = 1 << 16
#: Rows of a block, about.
BLOCK = 1 << 14
#: Cells of the joint histogram of some features.
JOINT_CELLS = 1 << 13


class GiniRule:
    """Weighted binary class counts ``s0, s1``: gain is the fall of gini impurity."""

    stats = ("s0", "s1")

    def __init__(self, min_leaf: float = 1.0):
        self.min_leaf = min_leaf

    def gain(self, l: str = "l_", r: str = "r_", t: str = "t_") -> str:
        """Expression text over the left, right and total sums with the given prefixes."""
        def purity(x: str) -> str:
            return f"({x}s0 * {x}s0 + {x}s1 * {x}s1) / ({x}s0 + {x}s1)"

        return (f"CASE WHEN {l}s0 + {l}s1 >= {self.min_leaf}D AND {r}s0 + {r}s1 >= {self.min_leaf}D THEN "
                f"({purity(l)} + {purity(r)} - {purity(t)}) / ({t}s0 + {t}s1) END")

    def gains(self, left: np.ndarray, right: np.ndarray, total: np.ndarray, tree) -> np.ndarray:
        """The same over arrays whose last axis holds the statistics; NaN where no split is allowed."""
        def weight(x: np.ndarray) -> np.ndarray:
            return x[..., 0] + x[..., 1]

        def purity(x: np.ndarray) -> np.ndarray:
            return (x[..., 0] * x[..., 0] + x[..., 1] * x[..., 1]) / weight(x)

        fine = (weight(left) >= self.min_leaf) & (weight(right) >= self.min_leaf)
        return np.where(fine, (purity(left) + purity(right) - purity(total)) / weight(total), np.nan)

    def open(self, node: dict) -> bool:
        """Whether a node may be split at all."""
        return node["s0"] > 0 and node["s1"] > 0 and node["s0"] + node["s1"] >= 2 * self.min_leaf


class NewtonRule:
    """First and second derivatives ``g, h`` with L1, L2 and a split penalty per model.

    gain = scale * (S(GL)^2/(HL+lambda) + S(GR)^2/(HR+lambda) - S(G)^2/(H+lambda)) - gamma with the soft
    threshold S(., alpha); both children need a hessian sum of at least ``min_child``. Settings are
    given per tree, so differently regularised models grow side by side.
    """

    stats = ("g", "h")

    def __init__(self, lam: list[float], alpha: list[float], gamma: list[float], min_child: list[float],
                 scale: float = 0.5, tree: str = "tree"):
        def pick(values: list[float]) -> str:
            if len(set(values)) == 1:
                return f"{float(values[0])!r}D"
            return f"element_at(array({', '.join(f'{float(v)!r}D' for v in values)}), {tree} + 1)"

        self.scale = scale
        self.values = tuple(np.array(v, float) for v in (lam, alpha, gamma, min_child))
        self.lam, self.alpha, self.gamma, self.min_child = (pick(v) for v in (lam, alpha, gamma, min_child))

    def gain(self, l: str = "l_", r: str = "r_", t: str = "t_") -> str:
        def score(x: str) -> str:
            return f"power(greatest(abs({x}g) - {self.alpha}, 0D), 2D) / ({x}h + {self.lam})"

        return (f"CASE WHEN {l}h >= {self.min_child} AND {r}h >= {self.min_child} THEN "
                f"{self.scale}D * ({score(l)} + {score(r)} - {score(t)}) - {self.gamma} END")

    def gains(self, left: np.ndarray, right: np.ndarray, total: np.ndarray, tree) -> np.ndarray:
        shape = (-1,) + (1,) * (left.ndim - 2)
        lam, alpha, gamma, min_child = (v[np.atleast_1d(tree)].reshape(shape) for v in self.values)

        def score(x: np.ndarray) -> np.ndarray:
            return np.maximum(np.abs(x[..., 0]) - alpha, 0.0) ** 2 / (x[..., 1] + lam)

        fine = (left[..., 1] >= min_child) & (right[..., 1] >= min_child)
        return np.where(fine, self.scale * (score(left) + score(right) - score(total)) - gamma, np.nan)

    def open(self, node: dict) -> bool:
        return node["n"] >= 2


class VarianceRule:
    """Sums ``s`` of a target and ``q``, a second sum that is carried along: gain is the fall of the squared error a row.

    For a regression ``q`` is the sum of squares; for a residual tree it is the hessian sum of the Newton step in its leaves.
    """

    stats = ("s", "q")

    def __init__(self, min_leaf: int = 1):
        self.min_leaf = min_leaf

    def gain(self, l: str = "l_", r: str = "r_", t: str = "t_") -> str:
        return (f"CASE WHEN {l}n >= {self.min_leaf} AND {r}n >= {self.min_leaf} THEN "
                f"({l}s * {l}s / {l}n + {r}s * {r}s / {r}n - {t}s * {t}s / {t}n) / {t}n END")

    def gains(self, left: np.ndarray, right: np.ndarray, total: np.ndarray, tree) -> np.ndarray:
        def score(x: np.ndarray) -> np.ndarray:
            return x[..., 0] * x[..., 0] / x[..., -1]

        fine = (left[..., -1] >= self.min_leaf) & (right[..., -1] >= self.min_leaf)
        return np.where(fine, (score(left) + score(right) - score(total)) / total[..., -1], np.nan)

    def open(self, node: dict) -> bool:
        return node["n"] >= 2 * self.min_leaf


# --- arrays --------------------------------------------------------------------------------------------------------------


@dataclass
class TreeState:
    """Splits of a growing tree as arrays by node position, and its open nodes by slot."""

    feature: np.ndarray       # -1: no split yet
    bin: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    slot: np.ndarray          # -1: not open
    feats: np.ndarray         # (slots, features) that may split an open node
    value: np.ndarray

    def walk(self, x: np.ndarray) -> np.ndarray:
        """Position that each row of bins ends at; a node's right child stands behind its left one."""
        flat, first = np.ascontiguousarray(x).reshape(-1), np.arange(len(x)) * x.shape[1]
        holes = bool(flat.size) and int(flat.min()) < 0
        inner = self.feature >= 0
        feature, bin_ = np.where(inner, self.feature, 0), np.where(inner, self.bin, np.iinfo(flat.dtype).max).astype(flat.dtype)
        left = np.where(inner, self.left, np.arange(len(inner)))
        away = inner & ~self.missing_left
        at = np.zeros(len(x), np.int64)
        while x.shape[1]:
            v = flat.take(first + feature.take(at))
            right = v > bin_.take(at)
            if holes:
                right |= (v < 0) & away.take(at)
            nxt = left.take(at) + right
            if (nxt == at).all():
                break
            at = nxt
        return at

    def step(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Positions one level below ``at``; rows of a node without a split stay there."""
        inner = self.feature >= 0
        if not x.shape[1] or not inner.any():
            return at
        flat = np.ascontiguousarray(x).reshape(-1)
        feature, bin_ = np.where(inner, self.feature, 0), np.where(inner, self.bin, np.iinfo(flat.dtype).max).astype(flat.dtype)
        left, away = np.where(inner, self.left, np.arange(len(inner))), inner & ~self.missing_left
        out = np.empty_like(at)
        for lo in range(0, len(at), CHUNK):
            here = at[lo : lo + CHUNK]
            v = flat.take(feature.take(here) + np.arange(lo, lo + len(here)) * x.shape[1])
            right = v > bin_.take(here)
            if away.any():
                right |= (v < 0) & away.take(here)
            out[lo : lo + CHUNK] = left.take(here) + right
        return out


def slot_sums(x: np.ndarray, slot: np.ndarray, stats: list[np.ndarray], feats: np.ndarray, width: int, weight: np.ndarray | None = None) -> np.ndarray:
    """Sums by (slot, feature, bin + 1, statistic and row count); bin -1 is a missing value. ``weight`` says how many rows each one stands for."""
    slots, k = feats.shape
    out = np.empty((slots, k, width, len(stats) + 1))
    same = bool((feats == feats[:1]).all())
    rows = None if same else np.arange(len(x))
    base = slot * width + 1
    for j in range(k):
        cell = base + (x[:, feats[0, j]] if same else x[rows, feats[slot, j]])
        for s, values in enumerate(stats):
            out[:, j, :, s] = np.bincount(cell, values, slots * width).reshape(slots, width)
        out[:, j, :, -1] = np.bincount(cell, weight, slots * width).reshape(slots, width)
    return out


class HeldBins:
    """Bins of rows that a task holds; trees grow on the first ``fit`` of them.

    Features whose bins make few cells together are counted in one go, by the joint cell, and added up apart from each other afterwards.
    """

    def __init__(self, x: np.ndarray, fit: int, bins: Bins):
        self.x, self.fit, self.codes = np.ascontiguousarray(x), fit, {}
        self.sizes = [len(e) + 2 for e in bins.edges]
        self.groups: list[list[int]] = []
        for j in sorted(range(len(self.sizes)), key=lambda j: -self.sizes[j]):
            fits = [g for g in self.groups if math.prod(self.sizes[i] for i in g) * self.sizes[j] <= JOINT_CELLS]
            fits[0].append(j) if fits else self.groups.append([j])

    @staticmethod
    def node_sums(bins: Bins) -> int:
        """Sums that a task sends per node and statistic."""
        return len(bins.edges) * max([len(e) + 2 for e in bins.edges], default=0)

    def _code(self, group: list[int]) -> np.ndarray:
        key = group[0]
        if key not in self.codes:
            code = np.zeros(self.fit, np.int32)
            for j in group:
                code *= self.sizes[j]
                code += self.x[: self.fit, j] + 1
            self.codes[key] = code
        return self.codes[key]

    def sums(self, slot: np.ndarray, stats: list[np.ndarray], weight: np.ndarray | None, feats: np.ndarray, width: int) -> np.ndarray:
        """``slot_sums`` of the rows trees grow on; a row in slot -1 counts nowhere."""
        asked = {int(j) for j in feats.reshape(-1)}
        groups = [g for g in self.groups if asked.intersection(g)]
        joint = max((math.prod(self.sizes[j] for j in g) for g in groups), default=1)
        if len(groups) > feats.shape[1] or (feats.shape[1] < len(self.sizes) and len(feats) * joint > CHUNK):  # each node asks for few features
            total = np.zeros((*feats.shape, width, len(stats) + 1))
            for lo in range(0, self.fit, CHUNK):
                here = lo + np.flatnonzero(slot[lo : lo + CHUNK] >= 0)
                total += slot_sums(self.x[here], slot[here], [s[here] for s in stats], feats, width, None if weight is None else weight[here])
            return total
        out = np.zeros((len(feats), len(self.sizes), width, len(stats) + 1))
        columns, everywhere = [*stats, weight], len(feats) == 1 and bool((slot >= 0).all())
        for group in groups:
            code, sizes = self._code(group), [self.sizes[j] for j in group]
            cells = math.prod(sizes)
            total = np.zeros((len(columns), (len(feats) + 1) * cells))
            for lo in range(0, self.fit, CHUNK << 2):
                cell = code[lo : lo + (CHUNK << 2)].astype(np.intp)
                cell += cells if everywhere else (slot[lo : lo + (CHUNK << 2)] + 1) * cells
                for sums, values in zip(total, columns, strict=True):
                    sums += np.bincount(cell, None if values is None else values[lo : lo + (CHUNK << 2)], len(sums))
            cube = total.reshape(len(columns), len(feats) + 1, *sizes)[:, 1:]
            for axis, j in enumerate(group):
                out[:, j, : sizes[axis]] = np.moveaxis(cube.sum(axis=tuple(i + 2 for i in range(len(group)) if i != axis)), 0, -1)
        return out[np.arange(len(feats))[:, None], feats]


def best_splits(sums: np.ndarray, feats: np.ndarray, rule, tree, missing: bool) -> dict[str, np.ndarray]:
    """The best split of every slot: gain (NaN: none), feature, bin, missing_left, and the sums on the left and in total.

    Equal gains go to the lower feature, then the lower bin, then to missing values on the right. A candidate ends at a bin with rows.
    """
    total = sums[:, 0].sum(axis=1)
    present = sums[:, :, 1:]
    left = np.cumsum(present, axis=2)
    sides = [left]
    if missing and sums[:, :, 0, -1].any():
        sides.append(left + sums[:, :, :1])
    best: dict[str, np.ndarray] = {}
    with np.errstate(divide="ignore", invalid="ignore"):
        for side, l in enumerate(sides):
            whole = total[:, None, None, :]
            r = whole - l
            gain = np.round(rule.gains(l, r, whole, tree), 10)
            fine = (present[..., -1] > 0) & (l[..., -1] > 0) & (r[..., -1] > 0)
            if side:
                fine &= sums[:, :, :1, -1] > 0
            gain = np.where(fine & ~np.isnan(gain), gain, -np.inf).reshape(len(sums), -1)
            at = gain.argmax(axis=1)
            top = gain[np.arange(len(sums)), at]
            j, b = np.divmod(at, present.shape[2])
            found = {"gain": top, "feature": feats[np.arange(len(sums)), j], "bin": b, "missing_left": np.full(len(sums), bool(side)),
                     "left": l[np.arange(len(sums)), j, b]}
            if not best:
                best = found
            else:
                better = (found["gain"] > best["gain"]) | ((found["gain"] == best["gain"]) & (
                    (found["feature"] < best["feature"]) | ((found["feature"] == best["feature"]) & (found["bin"] < best["bin"]))))
                best = {c: np.where(better.reshape((-1,) + (1,) * (v.ndim - 1)), found[c], v) for c, v in best.items()}
    best["gain"] = np.where(np.isneginf(best["gain"]), np.nan, best["gain"])
    return {**best, "total": total}


#: How the lists of a packed table are stored.
BINS, WEIGHTS, MARGINS = "<i2", "<i1", "<f8"


def packed(df: DataFrame, bins: Bins, keep: list[str], lists: dict[str, str] | None = None, in_blocks: bool = False) -> DataFrame:
    """``keep`` and the ``bins`` of every row, and its columns ``lists`` of equally long lists, as bytes, which pass between Spark and its
    tasks as they are. A bin is the number of cut points below the value, -1 if it is missing.

    ``in_blocks`` gives (block, n) instead: some thousand rows written as one Arrow batch, so that a pass over them copies bytes and converts no row.
    """
    lists = lists or {}
    given = df.select(*keep, *lists, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(bins.cols)])
    schema = T.StructType([*[given.schema[c] for c in keep], *[T.StructField(c, T.BinaryType()) for c in [*lists, "bins"]]])
    edges = [np.array(e) for e in bins.edges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.empty((b.num_rows, len(edges)), BINS)
            for i, cuts in enumerate(edges):
                x = b[f"x{i}"].to_numpy(zero_copy_only=False)
                out[:, i] = np.where(np.isnan(x), -1, np.searchsorted(cuts, x, "left"))
            yield pa.RecordBatch.from_arrays([*[b[c] for c in keep], *[pack(_lists(b[c]).astype(kind)) for c, kind in lists.items()], pack(out)],
                                             names=[*keep, *lists, "bins"])

    def run_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in chunks(run(batches), BLOCK):
            yield block_of(t)

    return given.mapInArrow(run_blocks, "block binary, n long") if in_blocks else given.mapInArrow(run, schema)


def pack(matrix: np.ndarray) -> pa.Array:
    """A binary value per row of a matrix."""
    size = matrix.itemsize * matrix.shape[1] if len(matrix) else 0
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(matrix))])


def _lists(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def matrix_of(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """A packed column as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0), kind)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind).reshape(len(column), -1)


def block_of(rows: pa.Table) -> pa.RecordBatch:
    """The row of a table of blocks that holds ``rows``."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([rows.num_rows], pa.int64())], names=["block", "n"])


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block after the other."""
    for b in batches:
        for data in b["block"]:
            yield pa.ipc.open_stream(data.as_buffer()).read_all().combine_chunks()


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[pa.Table]:
    """Batches, of rows or of blocks of rows, put together to about ``size`` rows."""
    held: list[pa.RecordBatch] = []
    for given in batches:
        for b in (x for t in blocks([given]) for x in t.to_batches()) if "block" in given.schema.names else [given]:
            if b.num_rows:
                held.append(b)
            if sum(x.num_rows for x in held) >= size:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


@dataclass
class GiniSource:
    """Class counts of packed rows (label, bins[, bag]); ``bag`` holds a weight per tree from ``first`` on, 0 for a row outside it."""

    bag: str | None = None
    first: int = 0

    @property
    def columns(self) -> list[str]:
        return ["label", "bins", *([self.bag] if self.bag else [])]

    def prepare(self, rows: pa.Table):
        # a line per tree: its weights are read one after the other
        bag = np.ascontiguousarray(matrix_of(rows[self.bag], WEIGHTS).T) if self.bag else None
        return matrix_of(rows["bins"], BINS), np.asarray(rows["label"]).astype(float), bag

    def stats(self, prepared, tree: int):
        """Rows in the tree (None: all), and their statistics."""
        _, label, bag = prepared
        if bag is None:
            return None, [1.0 - label, label]
        mine = bag[tree - self.first]
        rows = np.flatnonzero(mine)
        w, y = mine[rows].astype(float), label[rows]
        return rows, [w * (1.0 - y), w * y]


# --- growth --------------------------------------------------------------------------------------------------------------


class Growth:
    """The growing node lists of a set of trees; holds one record per node, never data rows."""

    def __init__(self, spark: SparkSession | None, rule, depth_of: dict[int, int], feats_of, bins: Bins | None):
        self.spark, self.rule = spark, rule
        self.depth_of = depth_of                     # tree -> maximum depth
        self.feats_of = feats_of                     # (tree, node) -> allowed feature indices
        self.missing = bins is not None and bins.missing
        self.width = max([len(e) for e in bins.edges], default=0) + 2 if bins else 0  # bins and the missing one
        self.nodes: dict[tuple[int, int], dict] = {}
        self.order = {t: [0] for t in sorted(depth_of)}  # position -> node number
        self.frontier = [(t, 0) for t in sorted(depth_of)]

    def states(self, open_nodes: list[tuple[int, int]] = (), value=None) -> dict[int, TreeState]:
        """Arrays of the trees of ``open_nodes``, or of all trees with ``value(tree, record)`` in them."""
        slots: dict[int, list[int]] = {}
        for t, n in open_nodes:
            slots.setdefault(t, []).append(n)
        out = {}
        for t in slots or self.order:
            numbers = self.order[t]
            at = {n: i for i, n in enumerate(numbers)}
            recs = [self.nodes.get((t, n), {}) for n in numbers]
            slot = np.full(len(numbers), -1, np.int64)
            for i, n in enumerate(slots.get(t, [])):
                slot[at[n]] = i
            inner = ["feature" in r for r in recs]
            out[t] = TreeState(
                np.array([r.get("feature", -1) for r in recs]), np.array([r.get("bin", -1) for r in recs]),
                np.array([r.get("missing_left", False) for r in recs]),
                np.array([at[2 * n + 1] if i else 0 for i, n in zip(inner, numbers)]), np.array([at[2 * n + 2] if i else 0 for i, n in zip(inner, numbers)]),
                slot, np.array([self.feats_of(t, n) for n in slots.get(t, [])], np.int64),
                np.array([value(t, r) if value and r else 0.0 for r in recs]))
        return out

    def _parts(self) -> Iterator[list[tuple[int, int]]]:
        """The open nodes in parts whose histograms fit a task."""
        part, size = [], 0
        for t, n in self.frontier:
            cells = len(self.feats_of(t, n)) * self.width * (len(self.rule.stats) + 1) * 8
            if part and size + cells > HIST_BYTES:
                yield part
                part, size = [], 0
            part.append((t, n))
            size += cells
        if part:
            yield part

    def step(self, rows: DataFrame, source, min_gain: float = 0.0) -> None:
        """Grow one level of all trees."""
        found: dict[tuple[int, int], dict] = {}
        for part in self._parts():
            found.update(self._level(rows, source, part))
        stats = [*self.rule.stats, "n"]
        nxt = []
        for key in self.frontier:
            r = found.get(key)
            if r is None:
                continue
            tree, number = key
            node = self.nodes.setdefault(key, {"depth": 0, **dict(zip(stats, r["total"]))})
            depth_left = self.depth_of[tree] - node["depth"]
            if depth_left <= 0 or r["gain"] is None or r["gain"] <= min_gain or not self.rule.open(node):
                continue
            node.update(gain=r["gain"], feature=r["feature"], bin=r["bin"], missing_left=r["missing_left"])
            left = dict(zip(stats, r["left"]))
            right = {s: node[s] - left[s] for s in stats}
            for child, side in ((2 * number + 1, left), (2 * number + 2, right)):
                self.nodes[(tree, child)] = {"depth": node["depth"] + 1, **side}
                self.order[tree].append(child)
                if depth_left > 1 and self.rule.open(side):
                    nxt.append((tree, child))
        self.frontier = nxt

    def _level(self, rows: DataFrame, source, part: list[tuple[int, int]]) -> dict[tuple[int, int], dict]:
        """The best splits of some open nodes, from one scan."""
        sent = self.spark.sparkContext.broadcast(self.states(part))
        rule, width, missing, n_stats = self.rule, self.width, self.missing, len(self.rule.stats) + 1

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = sent.value
            sums = {t: np.zeros((*a.feats.shape, width, n_stats)) for t, a in trees.items()}
            for chunk in chunks(batches):
                prepared = source.prepare(chunk)
                for t, a in trees.items():
                    inside, stats = source.stats(prepared, t)
                    x = prepared[0] if inside is None else prepared[0][inside]
                    slot = a.slot[a.walk(x)]
                    here = slot >= 0
                    if not here.all():
                        x, slot, stats = x[here], slot[here], [s[here] for s in stats]
                    if len(x):
                        sums[t] += slot_sums(x, slot, stats, a.feats, width)
            for t, total in sums.items():
                seen = np.flatnonzero(total[:, 0, :, -1].any(axis=1))
                if len(seen):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), t, np.int32)), pa.array(seen.astype(np.int32)),
                                                      pa.array([total[i].tobytes() for i in seen], pa.binary())], names=["tree", "slot", "sums"])

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, total = sent.value, {}
            for b in batches:
                for t, i, data in zip(*(b[c].to_pylist() for c in ("tree", "slot", "sums")), strict=True):
                    data = np.frombuffer(data)
                    total[t, i] = total[t, i] + data if (t, i) in total else data
            by_shape: dict[int, list] = {}
            for key in sorted(total):
                by_shape.setdefault(trees[key[0]].feats.shape[1], []).append(key)
            for k, keys in by_shape.items():
                sums = np.stack([total[key] for key in keys]).reshape(len(keys), k, width, n_stats)
                feats = np.stack([trees[t].feats[i] for t, i in keys])
                best = best_splits(sums, feats, rule, np.array([t for t, _ in keys]), missing)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in keys], pa.int32()), pa.array([i for _, i in keys], pa.int32()), pa.array(best["gain"], from_pandas=True),
                     pa.array(best["feature"], pa.int32()), pa.array(best["bin"], pa.int32()), pa.array(best["missing_left"]),
                     pa.array(list(best["left"]), pa.list_(pa.float64())), pa.array(list(best["total"]), pa.list_(pa.float64()))],
                    names=["tree", "slot", "gain", "feature", "bin", "missing_left", "left", "total"])

        given = rows.select("block") if "block" in rows.columns else rows.select(*source.columns)
        partial = given.mapInArrow(add_up, "tree int, slot int, sums binary").repartition("tree", "slot")
        best = partial.mapInArrow(choose, "tree int, slot int, gain double, feature int, bin int, missing_left boolean, left array<double>, total array<double>")
        of_slot: dict[int, list[int]] = {}
        for t, n in part:
            of_slot.setdefault(t, []).append(n)
        out = {(r["tree"], of_slot[r["tree"]][r["slot"]]): r.asDict() for r in best.collect()}  # one row per open node
        sent.unpersist()
        return out

    def grow(self, rows: DataFrame | None, source, min_gain: float = 0.0) -> None:
        """Grow all levels."""
        while self.frontier:
            self.step(rows, source, min_gain)


class TaskGrowth(Growth):
    """The same growth over rows that tasks hold, each its share.

    ``stats_of`` gives the statistics of the rows a tree grows on, and how many rows each stands for (None: one). ``gather`` sends bytes to all
    tasks and returns those of each task, in the same order everywhere; all tasks add up the same sums and so find the same splits. None: a single task.
    """

    def __init__(self, held: HeldBins, stats_of, rule, depth_of: dict[int, int], feats_of, bins: Bins, gather=None):
        super().__init__(None, rule, depth_of, feats_of, bins)
        self.held, self.stats_of, self.gather, self.stats = held, stats_of, gather, {}
        self.at = {t: np.zeros(len(held.x), np.int32) for t in self.order}

    def advance(self) -> None:
        """Moves every row below the splits found last."""
        for t, a in self.states().items():
            self.at[t] = a.step(self.held.x, self.at[t])

    def step(self, rows: DataFrame | None, source, min_gain: float = 0.0) -> None:
        if self.nodes:
            self.advance()
        super().step(rows, source, min_gain)

    def _level(self, rows, source, part: list[tuple[int, int]]) -> dict[tuple[int, int], dict]:
        out = {}
        states = self.states(part)
        for t in states:
            if t not in self.stats:
                self.stats[t] = self.stats_of(t)  # the same at every level
        sums = [self.held.sums(a.slot.take(self.at[t][: self.held.fit]), *self.stats[t], a.feats, self.width) for t, a in states.items()]
        if self.gather:
            ends = np.cumsum([0, *[x.size for x in sums]])
            total = sum(map(np.frombuffer, self.gather(b"".join([x.tobytes() for x in sums]))))
            sums = [total[lo:hi].reshape(x.shape) for lo, hi, x in zip(ends, ends[1:], sums)]
        for (t, a), total in zip(states.items(), sums, strict=True):
            seen = np.flatnonzero(total[:, 0, :, -1].any(axis=1))
            if not len(seen):
                continue
            best = best_splits(total[seen], a.feats[seen], self.rule, np.full(len(seen), t), self.missing)
            numbers = [n for tree, n in part if tree == t]
            gains = [None if math.isnan(g) else g for g in best["gain"].tolist()]
            for i, k in enumerate(seen):
                out[t, numbers[k]] = {"gain": gains[i], "feature": int(best["feature"][i]), "bin": int(best["bin"][i]),
                                      "missing_left": bool(best["missing_left"][i]), "left": best["left"][i].tolist(), "total": best["total"][i].tolist()}
        return out


def trees_per_pass(max_depth: int, n_trees: int) -> int:
    """How many trees grow side by side so that their nodes stay a small table."""
    return max(1, min(n_trees, LOCAL_ROWS >> min(max_depth + 1, 17)))


def grow_gini(binned: DataFrame, bins: Bins, n_trees: int = 1, weights: str | None = None, max_depth: int = 5,
              min_leaf: float = 1.0, max_features: int | str | None = None, seed: int = 42) -> list[dict]:
    """Grow gini trees over packed ``(label, bins[, weights])``, or blocks of them, and return their node rows.

    ``weights`` names an array column with one weight per tree (0 = the row is not in that tree's sample).
    ``max_features`` ('sqrt' or a number) restricts every node to a hashed subset of features. What a tree becomes
    does not depend on which others grow with it.
    """
    if max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth is at most {MAX_DEPTH}")
    feats = feature_choice(bins.cols, max_features, seed)
    items: list = []
    batch = trees_per_pass(max_depth, n_trees)
    for start in range(0, n_trees, batch):
        ids = range(start, min(start + batch, n_trees))
        growth = Growth(binned.sparkSession, GiniRule(min_leaf), {t: max_depth for t in ids}, feats, bins)
        growth.grow(binned, GiniSource(weights))
        items.extend(growth.nodes.items())
    return node_rows(items, bins, gini_leaf)


def feature_choice(cols: list[str], max_features: int | str | None, seed: int):
    """(tree, node) -> features that may split it: all, or a hashed subset."""
    p = len(cols)
    k = p if max_features is None else (max(1, math.isqrt(p)) if max_features == "sqrt" else int(max_features))
    every = list(range(p))
    return lambda tree, node: every if k >= p else ranked_subset(cols, k, seed, "split", tree, node)


def gini_leaf(node: dict) -> dict:
    n = node["s0"] + node["s1"]
    p0, p1 = node["s0"] / n, node["s1"] / n
    return {"impurity": 1.0 - p0 * p0 - p1 * p1, "class_counts": [node["s0"], node["s1"]], "value": p1,
            "prediction": 1.0 if node["s1"] > node["s0"] else 0.0, "cover": n}


def node_rows(items: list, bins: Bins, describe, tree_of=lambda t: t, weight: float = 1.0) -> list[dict]:
    """Node records in the common node-table layout; thresholds are on the raw feature scale."""
    rows = []
    for (tree, node), rec in sorted(items, key=lambda kv: kv[0]):
        split = rec.get("feature")
        rows.append({
            "tree_id": tree_of(tree), "node_id": node, "parent_id": None if node == 0 else (node - 1) // 2,
            "depth": rec["depth"], "feature_idx": split, "feature": None if split is None else bins.cols[split],
            "threshold": None if split is None else _threshold(bins.edges[split], rec["bin"]),
            "missing_left": rec.get("missing_left"), "left_id": None if split is None else 2 * node + 1,
            "right_id": None if split is None else 2 * node + 2, "is_leaf": split is None,
            "n_samples": int(rec["n"]), "gain": rec.get("gain"), "tree_weight": weight, **describe(rec)})
    return rows


def _threshold(edges: list[float], bin_: int) -> float:
    # the last bin as a left side holds every present value: only missing rows go right
    return edges[bin_] if bin_ < len(edges) else math.inf

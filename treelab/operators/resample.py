"""Splits, folds, bootstrap weights, feature subsets and column shuffles, all repeatable by hash."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from treelab.functions.hashing import POISSON_CDF, hash_key, md5_units, text_key, unit_below
from treelab.functions.ranks import hash_cuts, hash_positions
from treelab.operators.grower import pack

#: Rows up to which the product of a position and a factor below it fits 64 bits.
MAX_PRODUCT_ROWS = 3_000_000_000
#: Values that a block of rows receives in all, and values that a task sorts by block at a time.
BLOCK_VALUES, SEND_VALUES = 1 << 22, 1 << 21
#: Rows whose weights, of ten at most, add up to a byte.
RUN_ROWS = 25
#: Column that holds a row's hash while its place among the cuts is found.
KEY = "__key"


def split_quota(sizes: dict, fraction: float) -> dict:
    """Rows per class for the smaller part: ceil(fraction * n), shared out by largest remainder."""
    total = sum(sizes.values())
    wanted = math.ceil(fraction * total)
    exact = {k: wanted * n / total for k, n in sizes.items()}
    quota = {k: math.floor(v) for k, v in exact.items()}
    left = wanted - sum(quota.values())
    for k in sorted(sizes, key=lambda k: (-(exact[k] - quota[k]), str(k)))[:left]:
        quota[k] += 1
    return quota


def _cut_case(label: str, cuts: dict, pick) -> Column:
    chain = None
    for lab, found in cuts.items():
        cond = F.col(label) == F.lit(lab) if lab is not None else F.col(label).isNull()
        chain = F.when(cond, pick(found)) if chain is None else chain.when(cond, pick(found))
    return F.lit(None) if chain is None else chain


def _content_key(df: DataFrame) -> Column:
    """Hash of a whole row, which orders rows with equal ids."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))


def _at_or_before(df: DataFrame, label: str, key: Column, cuts: dict) -> dict:
    """Per label one predicate per cut: whether a row stands at or before it.

    The predicates read the key from the column ``KEY``.
    Rows that share an id share their hash; where a cut runs through them they are ordered by their whole content. Rows that are
    equal in all columns cannot be told apart, so a cut through them is refused.
    """
    out: dict = {}
    for lab, found in cuts.items():
        out[lab] = []
        for cut in found:
            if cut is None:
                out[lab].append(F.lit(False))
            elif cut.taken == cut.rows:
                out[lab].append(F.col(KEY) <= F.lit(cut.key))
            else:
                tied = df.where(F.col(label).eqNullSafe(F.lit(lab)) & (key == F.lit(cut.key)))
                (inner,), = hash_cuts(tied, label, _content_key(df), lambda sizes, n=cut.taken: {k: [n] for k in sizes}).values()
                if inner.taken < inner.rows:
                    raise ValueError(f"{inner.rows} equal rows stand where class {lab!r} is cut; give the rows distinct ids")
                out[lab].append((F.col(KEY) < F.lit(cut.key)) | ((F.col(KEY) == F.lit(cut.key)) & (_content_key(df) <= F.lit(inner.key))))
    return out


def _with_key(df: DataFrame, key: Column, out: str, value: Column) -> DataFrame:
    """``df`` with ``value``, which looks at the row's key in ``KEY``: the key is hashed once a row, however many cuts it meets."""
    return df.withColumn(KEY, key).withColumn(out, value).drop(KEY)


def stratified_split(df: DataFrame, label: str = "label", row_id: str = "row_id", test_fraction: float = 0.2,
                     seed: int = 42, out: str = "split", names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Exact stratified hold-out: in each class the quota of rows with the smallest md5(row_id:seed).

    Only the hash value at the quota is searched for, so the rows themselves are never shuffled: the
    result is a projection that compares each row's hash with its class's cut.
    """
    key = hash_key(F.col(row_id), seed)
    cuts = hash_cuts(df, label, key, lambda sizes: {k: [q] for k, q in split_quota(sizes, test_fraction).items()})
    is_test = _cut_case(label, _at_or_before(df, label, key, cuts), lambda found: found[0])
    return _with_key(df, key, out, F.when(is_test, names[1]).otherwise(names[0]))


def stratified_folds(df: DataFrame, k: int, label: str = "label", row_id: str = "row_id", seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Fold 0..k-1 per row: each class's hash order cut into k runs whose sizes differ by at most one."""
    key = hash_key(F.col(row_id), seed)

    def ends(n: int) -> list[int]:
        sizes = [n // k + (1 if f < n % k else 0) for f in range(k)]
        return [sum(sizes[:f + 1]) for f in range(k - 1)]

    cuts = hash_cuts(df, label, key, lambda sizes: {lab: ends(n) for lab, n in sizes.items()})

    def fold(found: list) -> Column:
        out_col = F.lit(0)
        for before in found:
            out_col = out_col + (~before).cast("int")
        return out_col

    return _with_key(df, key, out, _cut_case(label, _at_or_before(df, label, key, cuts), fold).cast("int"))


def bootstrap_weights(df: DataFrame, n_trees: int, row_id: str = "row_id", seed: int = 42,
                      out: str = "bag", first: int = 0) -> DataFrame:
    """``array<tinyint>`` of Poisson(1) weights, one per tree from ``first`` on; weight 0 means out of bag.

    One md5 serves four trees: tree t reads hex digits 8*(t%4).. of md5(row_id:seed:t div 4).
    """
    @F.arrow_udf(T.ArrayType(T.ByteType()))
    def lists(keys: pa.Array) -> pa.Array:
        drawn = _poisson_weights(keys, n_trees, first)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(drawn) + 1, dtype=np.int32) * n_trees), pa.array(drawn.reshape(-1)))

    return df.withColumn(out, lists(text_key(F.col(row_id), seed)))


def packed_weights(df: DataFrame, n_trees: int, row_id: str = "row_id", seed: int = 42, out: str = "bag", first: int = 0) -> DataFrame:
    """The weights of ``bootstrap_weights`` as a byte per tree, which the growers read as they are."""
    @F.arrow_udf(T.BinaryType())
    def texts(keys: pa.Array) -> pa.Array:
        return pack(_poisson_weights(keys, n_trees, first))

    return df.withColumn(out, texts(text_key(F.col(row_id), seed)))


def _poisson_weights(keys: pa.Array, n_trees: int, first: int) -> np.ndarray:
    """(rows, trees) Poisson(1) draws; a draw counts the steps of the distribution at or below its 32 bits."""
    groups = range(first // 4, (first + n_trees - 1) // 4 + 1)
    drawn = np.empty((len(keys), 4 * len(groups)), np.int8)
    for i, units in enumerate(md5_units(keys.cast(pa.binary()).to_pylist(), [b":%d" % g for g in groups])):
        drawn[:, 4 * i : 4 * i + 4] = _poisson(units)
    return np.ascontiguousarray(drawn[:, first % 4 : first % 4 + n_trees])


_STEPS = np.array([math.ceil(step * 2**32) for step in POISSON_CDF], np.uint32)


def _poisson(units: np.ndarray) -> np.ndarray:
    """Poisson(1) draws of 32-bit numbers: the steps of the distribution at or below them."""
    out = np.zeros(units.shape, np.int8)
    for step in _STEPS:
        out += units >= step
    return out


def summed_weights(texts: list[bytes], n_trees: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(runs, trees) sums of the weights of ``packed_weights`` over runs of texts (the keys of rows) that begin at ``starts``, and how many
    rows of a run each tree's bag holds. A run has up to ``RUN_ROWS`` rows, so a byte holds its sums."""
    weight, seen = (np.empty((len(starts), -(-n_trees // 4) * 4), np.uint8) for _ in range(2))
    for i, units in enumerate(md5_units(texts, [b":%d" % g for g in range(-(-n_trees // 4))])):
        drawn = _poisson(units).view(np.uint8)
        if len(starts):
            weight[:, 4 * i : 4 * i + 4] = np.add.reduceat(drawn, starts, axis=0, dtype=np.uint8)
            seen[:, 4 * i : 4 * i + 4] = np.add.reduceat((drawn > 0).view(np.uint8), starts, axis=0, dtype=np.uint8)
    return np.ascontiguousarray(weight[:, :n_trees]), np.ascontiguousarray(seen[:, :n_trees])


def row_subsample(row_id: Column, fraction: float, iteration, seed: int = 42) -> Column:
    """Predicate for a subsample without replacement in one boosting round."""
    if fraction >= 1.0:
        return F.lit(True)
    return unit_below(fraction, row_id, seed, "row", iteration)


def colsample_table(rounds: DataFrame, features: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """Which features each round may use: the smallest hashes of (seed, round, feature)."""
    keep = max(1, math.floor(fraction * len(features)))
    pairs = rounds.select("iteration", F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    order = Window.partitionBy("iteration").orderBy(hash_key(seed, F.col("iteration"), F.col("feature")))
    return pairs.withColumn("rk", F.row_number().over(order)).where(F.col("rk") <= keep).drop("rk")


def row_positions(df: DataFrame, row_id: str = "row_id", seed: int = 42) -> DataFrame:
    """Adds ``pos``, the place of a row (from 0) in hash order; made once for all features and repeats."""
    return hash_positions(df, [], hash_key(F.col(row_id), seed, "pos"), "pos").withColumn("pos", F.col("pos") - 1)


def shuffle_key(n: int, feature: str, rep: int, seed: int = 42) -> tuple[int, int]:
    """(a, b) of the bijection pos -> (a * pos + b) mod n: a is coprime to n, both come from the md5 of seed, feature and repeat."""
    digest = hashlib.md5(f"{seed}:{feature}:{rep}".encode()).hexdigest()
    a, b = 1 + int(digest[:8], 16) % n, int(digest[8:16], 16) % n
    while math.gcd(a, n) > 1:
        a += 1
    return a, b


def permuted_values(base: DataFrame, cols: list[str], repeats: int, n: int, seed: int = 42) -> DataFrame:
    """Every column shuffled ``repeats`` times: ``(pos, slot, permuted)``; ``slot`` is column number times ``repeats`` plus repeat.

    ``base`` has the columns and ``pos``. In each shuffle the row at ``pos`` receives the value of the row at (a * pos + b) mod n: each
    value is sent by the inverse of that bijection, so nothing is sorted and only (pos, slot, value) moves.
    """
    wide = "decimal(38,0)" if n > MAX_PRODUCT_ROWS else "long"
    sends = []
    for i, c in enumerate(cols):
        for rep in range(repeats):
            a, b = shuffle_key(max(n, 1), c, rep, seed)
            back = pow(a, -1, n) if n > 1 else 0
            shift = -back * b % n if n else 0
            sends.append((i * repeats + rep, i, back, shift))
    table = F.array(*[F.struct(F.lit(s).alias("slot"), F.lit(i).alias("i"), F.lit(back).cast(wide).alias("back"), F.lit(shift).cast(wide).alias("shift"))
                      for s, i, back, shift in sends])
    values = F.array(*[F.col(c).cast("double") for c in cols])
    sent = base.select("pos", values.alias("v"), F.explode(table).alias("k"))
    return sent.select(((F.col("k.back") * F.col("pos") + F.col("k.shift")) % F.lit(max(n, 1)).cast(wide)).cast("long").alias("pos"), "k.slot",
                       F.get("v", F.col("k.i")).alias("permuted"))


def _times_mod(x: np.ndarray, a: int, n: int) -> np.ndarray:
    """x * a mod n in 64 bits, for x and a below n and up to 2^40 rows."""
    if n <= MAX_PRODUCT_ROWS:
        return x * a % n
    return ((x >> 20) * a % n * (1 << 20) + (x & 0xFFFFF) * a) % n


def block_rows(n: int, slots: int) -> int:
    """Rows of a block: few enough for the memory of a task and for some dozen tasks, at most as many as 16 bits count."""
    return max(1, min(BLOCK_VALUES // slots, n // 64 + 1, 1 << 16))


def permuted_blocks(base: DataFrame, cols: list[str], shuffle: list[str], repeats: int, n: int, seed: int = 42) -> DataFrame:
    """The shuffles of ``permuted_values`` for tasks that take arrays: ``(block, slot, place, value)``, the last three as packed lists.

    The rows at block * ``block_rows`` + place receive a value in every slot: first the shuffled features (column number times ``repeats`` plus
    repeat), then ``cols`` as they are and the label. Each task sorts its values by block, so a row moves as a few bytes per value; null becomes NaN.
    """
    n, names = max(n, 1), [*cols, "label"]
    sends = []
    for c in shuffle:
        for rep in range(repeats):
            a, b = shuffle_key(n, c, rep, seed)
            back = pow(a, -1, n)
            sends.append((cols.index(c), back, -back * b % n))
    sends += [(i, 1, 0) for i in range(len(names))]
    size = block_rows(n, len(sends))
    kind = np.uint16 if n <= size << 16 else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            pos = b["pos"].to_numpy()
            wide = np.stack([b[c].to_numpy(zero_copy_only=False).astype(float, copy=False) for c in names])
            step = max(1, SEND_VALUES // len(pos))
            for first in range(0, len(sends), step):
                part = sends[first : first + step]
                block, place = np.divmod(np.concatenate([(_times_mod(pos, back, n) + shift) % n for _, back, shift in part]), size)
                order = np.argsort(block.astype(kind), kind="stable")
                slot = np.repeat(np.arange(first, first + len(part), dtype=np.uint32), len(pos))
                sent, count = np.unique(block[order], return_counts=True)
                ends = np.append(0, np.cumsum(count))
                yield pa.RecordBatch.from_arrays([pa.array(sent), *[_packed_lists(x[order], ends) for x in (
                    slot, place.astype(np.uint16), wide[[i for i, _, _ in part]].reshape(-1))]], names=["block", "slot", "place", "value"])

    return base.select("pos", *[F.col(c).cast("double").alias(c) for c in names]).mapInArrow(
        run, "block long, slot binary, place binary, value binary")


def _packed_lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of values[ends[k] : ends[k + 1]] for every k."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def received(block: pa.Table, slots: int, n: int) -> np.ndarray:
    """(slots, rows) values of one block, from all its rows of ``permuted_blocks``."""
    size = block_rows(n, slots)
    slot, place, value = (np.frombuffer(b"".join(block[c].to_pylist()), kind) for c, kind in (("slot", np.uint32), ("place", np.uint16), ("value", float)))
    out = np.empty((slots, min(size, n - block["block"][0].as_py() * size)))
    out[slot, place] = value
    return out


def permute_column(df: DataFrame, col: str, repeats: int, row_id: str = "row_id", seed: int = 42) -> DataFrame:
    """``(row_id, rep, value, permuted)`` for one column, shuffled anew in every repeat.

    The row at a position of the row-hash order receives the value that stands there in the order of md5(row_id:seed:col:rep).
    """
    rows = df.select(row_id, F.col(col).cast("double").alias("value"))
    again = rows.withColumn("rep", F.explode(F.array(*[F.lit(r) for r in range(repeats)])))
    shuffled = hash_positions(again, ["rep"], hash_key(F.col(row_id), seed, col, F.col("rep")), "pos").withColumn("pos", F.col("pos") - 1)
    return row_positions(rows, row_id, seed).join(shuffled.select("rep", "pos", F.col("value").alias("permuted")), "pos").select(
        row_id, "rep", "value", "permuted")

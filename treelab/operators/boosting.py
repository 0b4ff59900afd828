"""Boosting on DataFrames: second-order regularised, log-odds, and residual boosting of a number; staged losses, early stops.

All models of a call grow side by side on one record per row, which holds a margin per model and, per subsample, whether the next round draws it.
Rows are added up by their bins first, where these make few cells (``cells``): what a round asks of a row depends on nothing else, and the rows
that a round draws are counted by cell too. All rounds are one job: the tasks hold their shares of the cells, or rows, and pass sums of a level to
each other (``gang``); small tables are one task. Rows that do not fit the tasks so take a job per level; margins and draws are persisted then, the
frame before them is released, and every ten rounds they are checkpointed.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from contextlib import nullcontext
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from treelab.functions.gang import anywhere, first_of_gang, gang_size, gather
from treelab.functions.hashing import md5_units, ranked_subset, text_key
from treelab.functions.storage import cut_lineage, local_table
from treelab.operators.bins import Bins, fit_bins
from treelab.operators.cells import bins_of, can_count, count_cells
from treelab.operators.grower import (BINS, MARGINS, Growth, HeldBins, NewtonRule, TaskGrowth, VarianceRule, block_of, blocks, chunks, feature_choice,
                                      matrix_of, node_rows, pack, packed)
from treelab.operators.metrics import window_stop
from treelab.operators.nodes import rows_of, tree_sum, tree_values


@dataclass(frozen=True)
class BoostConfig:
    """Settings of one boosted model.

    ``kind`` "newton" splits by first and second derivatives with penalties. "log_odds" fits a residual tree by squared error and gives each
    leaf one Newton step, without penalties; "squared" fits ``label`` itself, a number, and its leaves are mean residuals.
    ``base_score`` is the starting probability, or ``"prior"`` for the training class rate (the mean, where the label is a number).
    ``max_features`` ('sqrt' or a number) restricts every split to a hashed subset of features, ``colsample_bytree`` every tree.
    ``holdout_fold`` leaves the rows of that fold out of the fit (they become its eval set).
    ``gain_scale`` 0.5 is the published gain formula; 1.0 compares gamma with the unhalved sum.
    """

    name: str = "boost"
    n_rounds: int = 100
    learning_rate: float = 0.1
    max_depth: int = 3
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    gamma: float = 0.0
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    min_child_weight: float = 1.0
    base_score: float | str = 0.5
    holdout_fold: int | None = None
    gain_scale: float = 0.5
    seed: int = 42
    kind: str = "newton"
    max_features: int | str | None = None


def log_odds_config(n_rounds: int = 100, learning_rate: float = 0.1, max_depth: int = 3, **settings) -> BoostConfig:
    """Gradient boosting of the log-odds, starting at the training class rate."""
    return BoostConfig(n_rounds=n_rounds, learning_rate=learning_rate, max_depth=max_depth, base_score="prior", kind="log_odds", **settings)


@dataclass
class BoostModel:
    """Node rows and learning curve of one model; ``nodes[i]["tree_id"]`` is the round."""

    config: BoostConfig
    cols: list[str]
    base_margin: float
    nodes: list[dict]
    history: list[dict]  # eval_set, iteration, logloss, accuracy
    watch: str = "train"  # the eval set that decides when to stop

    def prefix(self, n_rounds: int) -> "BoostModel":
        """The model after ``n_rounds`` rounds: boosting is additive, so no refit is needed."""
        return replace(self, config=replace(self.config, n_rounds=n_rounds),
                       nodes=[r for r in self.nodes if r["tree_id"] < n_rounds],
                       history=[h for h in self.history if h["iteration"] < n_rounds])


#: Least distance of a starting probability from 0 and 1.
PRIOR_EDGE = 1e-6
#: Rounds between two reliable checkpoints of the margins.
CHECKPOINT_EVERY = 10
#: Bins and margins up to which all rows are one partition and all rounds take place in one task.
TASK_CELLS = 4_000_000
#: Bytes of rows that each of several tasks may hold.
TASK_BYTES = 400 << 20
#: Seconds, about, that a level takes per row and model, an exchange of sums between tasks, and one byte of them.
ROW_S, GATHER_S, SENT_S = 3e-8, 0.02, 3e-8
#: Draws (rounds and samples) up to which the rows of a cell are counted for each.
MAX_DRAWS = 16
#: Probabilities are kept this far from 0 and 1 in a loss.
LOSS_EDGE = 1e-15


@dataclass
class BoostSource:
    """Derivatives of packed records (role, fold, label, margins, bins, k0, k1, ...) for the models of a call in one round."""

    kind: str
    draws: list[int | None]     # place of each model's draw among the k columns, None: all rows
    holdouts: list[int | None]
    columns: tuple[str, ...] = ("role", "fold", "label", "margins", "bins")

    def prepare(self, rows: pa.Table):
        train = pc.equal(rows["role"], "train").combine_chunks().fill_null(False).to_numpy(zero_copy_only=False)
        fold = rows["fold"].combine_chunks().fill_null(-1).to_numpy()
        drawn = [rows[c].to_numpy() for c in self.columns if c[0] == "k"]
        return matrix_of(rows["bins"], BINS), train, fold, rows["label"].to_numpy().astype(float), drawn, matrix_of(rows["margins"], MARGINS)

    def stats(self, prepared, model: int):
        _, train, fold, label, drawn, margins = prepared
        inside = train if self.holdouts[model] is None else train & (fold != self.holdouts[model])
        if self.draws[model] is not None:
            inside = inside & drawn[self.draws[model]]
        rows = np.flatnonzero(inside)
        margin, y = margins[rows, model], label[rows]
        if self.kind == "squared":
            return rows, [y - margin, np.ones(len(rows))]
        p = 1.0 / (1.0 + np.exp(-margin))
        return rows, [p - y, p * (1.0 - p)] if self.kind == "newton" else [y - p, p * (1.0 - p)]


class TableRounds:
    """The rounds of a call over a table: a job per level, and one for the losses."""

    def __init__(self, state: DataFrame, source: BoostSource, rule, bins: Bins, samples: list[tuple[int, float]]):
        self.spark, self.state, self.source, self.rule, self.bins, self.samples = state.sparkSession, state, source, rule, bins, samples
        self.before = None

    def grow(self, t: int, depth_of: dict[int, int], feats_of) -> Growth:
        growth = Growth(self.spark, self.rule, depth_of, feats_of, self.bins)
        growth.grow(self.state, self.source)
        if self.before is not None:
            self.before.unpersist()  # the growth has read the frame after it
        return growth

    def move(self, trees: dict, t: int) -> None:
        self.before, self.state = self.state, _moved(self.state, trees, self.samples, t + 1).persist(StorageLevel.MEMORY_AND_DISK)
        if (t + 1) % CHECKPOINT_EVERY == 0:
            kept, self.state = self.state, cut_lineage(self.state)
            self.before.unpersist()
            kept.unpersist()
            self.before = None

    def losses(self, holdouts: dict[int, int | None], squared: bool) -> Iterator[tuple]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, str], np.ndarray] = {}
            for b in chunks(batches):
                fold, label = b["fold"].combine_chunks().fill_null(-1).to_numpy(), b["label"].to_numpy()
                _add_losses(total, *_coded(b["role"]), fold, label, matrix_of(b["margins"], MARGINS).T.__getitem__, holdouts, squared)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.string()),
                                              *[pa.array([v[i] for v in total.values()], pa.float64()) for i in range(3)]], names=["m", "role", "loss", "hits", "n"])

        parts = self.state.select("block").mapInArrow(run, "m int, role string, loss double, hits double, n double")
        for r in parts.groupBy("m", "role").agg(*[F.sum(c).alias(c) for c in ("loss", "hits", "n")]).collect():  # models x eval sets
            yield r["m"], r["role"], r["loss"], r["hits"], r["n"]

    def close(self) -> None:
        for frame in (self.before, self.state):
            if frame is not None:
                frame.unpersist()


class TaskRounds:
    """The same rounds over rows or cells that tasks hold, each its share; ``gather`` as in ``TaskGrowth``."""

    def __init__(self, rows: HeldRows, base: list[float], source: BoostSource, rule, bins: Bins, samples: list[tuple[int, float]], gather=None):
        self.rows, self.source, self.rule, self.bins, self.samples, self.gather = rows, source, rule, bins, samples, gather
        self.held = HeldBins(rows.x, rows.fit, bins)
        self.base, self.margins = base, {}  # by model

    def grow(self, t: int, depth_of: dict[int, int], feats_of) -> Growth:
        drawn = self.rows.drawn(self.samples, t)
        for m in depth_of:
            self.margins.setdefault(m, np.full(len(self.rows.x), self.base[m]))
        self.growth = TaskGrowth(self.held, lambda m: self._stats(m, drawn), self.rule, depth_of, feats_of, self.bins, self.gather)
        self.growth.grow(None, self.source)
        return self.growth

    def _stats(self, model: int, drawn: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray | None]:
        """First and second sums of the rows that may be fitted, and their weights; rows outside the model's sample weigh nothing."""
        rows, draw, held_out = self.rows, self.source.draws[model], self.source.holdouts[model]
        weight = rows.weight if draw is None else drawn[draw]
        if held_out is not None:
            inside = rows.fold[: rows.fit] != held_out
            weight = inside.astype(float) if weight is None else weight * inside
        margin, y = self.margins[model][: rows.fit], rows.label[: rows.fit]
        if self.source.kind == "squared":
            stats = [y - margin, np.ones(rows.fit)]
        else:
            p = 1.0 / (1.0 + np.exp(-margin))
            stats = [p - y if self.source.kind == "newton" else y - p, p * (1.0 - p)]
        if weight is None:
            return stats, None
        if rows.holes:  # a missing label counts where its row is drawn
            return [np.where(weight > 0, s * weight, 0.0) for s in stats], weight
        return [s * weight for s in stats], weight

    def move(self, trees: dict, t: int) -> None:
        self.growth.advance()
        for m, a in trees.items():
            if len(a.value):
                self.margins[m] += a.value.take(self.growth.at[m])
        self.growth = None

    def losses(self, holdouts: dict[int, int | None], squared: bool) -> Iterator[tuple]:
        total: dict[tuple[int, str], np.ndarray] = {}
        _add_losses(total, self.rows.roles, self.rows.role, self.rows.fold, self.rows.label, self.margins.get, holdouts, squared, self.rows.weights)
        if self.gather:
            parts, total = self.gather(pickle.dumps(total)), {}
            for part in map(pickle.loads, parts):
                for key, sums in part.items():
                    total[key] = total.get(key, 0.0) + sums
        return ((m, role, *map(float, sums)) for (m, role), sums in total.items())


@dataclass
class HeldRows:
    """Rows or cells that a task holds, training rows first."""

    x: np.ndarray
    fit: int                        # how many are training rows
    roles: list[str]
    role: np.ndarray                # number of the role
    fold: np.ndarray
    label: np.ndarray
    texts: list[bytes] | None       # of the training rows: what a draw is made of
    counts: np.ndarray | None       # of cells: all rows, then those that each sample draws round by round
    rounds: int = 0

    def __post_init__(self):
        self.holes = bool(np.isnan(self.label).any())
        self.weights = None if self.counts is None else self.counts[0]
        self.weight = None if self.counts is None else self.weights[: self.fit]

    def drawn(self, samples: list[tuple[int, float]], t: int) -> list[np.ndarray]:
        """Per sample, how many of each training row (cell) round ``t`` draws."""
        if self.counts is not None:
            return [self.counts[1 + i * self.rounds + t, : self.fit] for i in range(len(samples))]
        return [d.astype(float) for d in _draws(self.texts or [], samples, t)]

    @classmethod
    def of(cls, batches: Iterator[pa.RecordBatch], bins: Bins, rounds: int) -> tuple["HeldRows", int]:
        """From blocks of packed rows or from counted cells; also the number of their group."""
        x, role, fold, label, keys, counts, names, place = [], [], [], [], [], [], {}, 0
        for b in batches:
            if "place" in b.schema.names and b.num_rows:
                place = b["place"][0].as_py()
            if "cells" in b.schema.names:
                for r in b.to_pylist():
                    cells = np.frombuffer(r["cells"], np.int64)
                    x.append(bins_of(cells, bins))
                    role.append(np.full(len(cells), names.setdefault(str(r["role"]), len(names))))
                    fold.append(np.full(len(cells), -1 if r["fold"] is None else r["fold"]))
                    label.append(np.full(len(cells), np.nan if r["label"] is None else float(r["label"])))
                    counts.append(np.frombuffer(r["counts"], np.int64).reshape(len(cells), -1).T.astype(float))
                continue
            for t in blocks([b]):
                found, code = _coded(t["role"])
                x.append(matrix_of(t["bins"], BINS))
                role.append(np.array([names.setdefault(r, len(names)) for r in found], np.int64)[code])
                fold.append(t["fold"].combine_chunks().fill_null(-1).to_numpy())
                label.append(t["label"].to_numpy().astype(float))
                keys.append(t["key"].combine_chunks())
        if not x:
            return cls(np.empty((0, len(bins.cols)), BINS), 0, [], *[np.empty(0, k) for k in (np.int64, np.int64, float)], None, None), place
        role = np.concatenate(role).astype(np.int8 if len(names) < 128 else np.int64)
        train = role == names.get("train", -1)
        order = np.argsort(~train, kind="stable")
        fit = int(train.sum())
        texts = pa.chunked_array(keys).take(pa.array(order[:fit])).cast(pa.binary()).to_pylist() if keys else None
        put = lambda parts: np.concatenate(parts)[order]
        return cls(put(x), fit, [*names], role[order], put(fold), put(label), texts, np.concatenate(counts, axis=1)[:, order] if counts else None, rounds), place


def boost(df: DataFrame, cols: list[str], configs: list[BoostConfig], role: str | None = None, fold: str | None = None,
          patience: int | None = None, max_bins: int = 32, method: str = "quantile", row_id: str = "row_id",
          bins: Bins | None = None, track: bool | set[int] = True, eval_sets: list[str] | None = None,
          no_change: tuple[int, float] | None = None) -> list[BoostModel]:
    """Fit all ``configs`` side by side: the number of jobs depends on rounds and depth, not on models.

    ``role`` names a column with ``train`` for rows to fit on; other values are eval sets. ``fold`` names the
    fold column for configs with a ``holdout_fold``. ``eval_sets`` names the sets in order; with ``patience`` a model stops once the
    loss of the last one has not improved for that many rounds. Without names that is the held-out fold, else the only other role,
    else the training rows; several other roles must be named. ``no_change`` (rounds, tolerance) stops a model at the first round whose
    watched loss is not at least the tolerance below any of that many losses before. ``track`` records
    loss and accuracy of every set after every round, or after the given rounds only.
    """
    if not configs:
        return []
    spark = df.sparkSession
    role_col = F.col(role) if role else F.lit("train")
    fit_rows = df.where(role_col == "train")
    bins = bins or fit_bins(fit_rows, cols, max_bins, method)
    base = _base_margins(fit_rows, configs, fold)
    for name in ("gain_scale", "kind"):
        if len({getattr(c, name) for c in configs}) > 1:
            raise ValueError(f"models fitted together share one {name}")
    kind = configs[0].kind
    rule = VarianceRule() if kind != "newton" else NewtonRule(
        [c.reg_lambda for c in configs], [c.reg_alpha for c in configs], [c.gamma for c in configs], [c.min_child_weight for c in configs],
        configs[0].gain_scale)
    label = F.col("label").cast("double" if kind == "squared" else "int")
    samples = list(dict.fromkeys((c.seed, c.subsample) for c in configs if c.subsample < 1.0))
    rid = F.col(row_id).cast("string")
    # text_key leaves out what is null, as in a draw's key
    key = F.concat(text_key(rid), F.when(rid.isNull(), "").otherwise(":")) if samples else F.lit("")
    rows = df.select(key.alias("key"), role_col.alias("role"), (F.col(fold) if fold else F.lit(None)).cast("int").alias("fold"),
                     label.alias("label"), *[F.col(c).cast("double").alias(f"{c}") for c in cols])
    source = BoostSource(kind, [samples.index((c.seed, c.subsample)) if c.subsample < 1.0 else None for c in configs], [c.holdout_fold for c in configs])
    watch = _watched_sets(df, role, configs, eval_sets, bool(patience or no_change))
    models = [BoostModel(c, list(cols), base[m], [], [], watch[m]) for m, c in enumerate(configs)]
    stops, rounds, gang = (track, patience, no_change), max(c.n_rounds for c in configs), gang_size(spark)

    def held(state: DataFrame, row_bytes: int) -> list[BoostModel] | None:
        n = state.agg(F.sum("n")).first()[0] or 0
        groups, together = _shares(n, len(cols), row_bytes, configs, gang, HeldBins.node_sums(bins))
        return _in_tasks(state, groups, gang if together else 0, models, source, rule, bins, samples, stops) if groups else None

    row_bytes = 64 + 6 * len(cols)
    if kind != "squared" and can_count(bins) and len(samples) * rounds <= MAX_DRAWS:
        state = _counted(rows, bins, gang, samples, rounds).persist(StorageLevel.DISK_ONLY)
        found = held(state, row_bytes + 8 * len(samples) * rounds)
        state.unpersist()
        if found:
            return found
    state = packed(rows, bins, ["key", "role", "fold", "label"], in_blocks=True).persist(StorageLevel.DISK_ONLY)
    found = held(state, row_bytes + 100 * bool(samples))
    if not found:
        source.columns += tuple(f"k{i}" for i in range(len(samples)))
        table = TableRounds(_moved(state, {}, samples, 0, base).persist(StorageLevel.MEMORY_AND_DISK), source, rule, bins, samples)
        _run_rounds(table, models, bins, *stops)
        table.close()
    state.unpersist()
    return found or models


def _run_rounds(rounds: TableRounds | TaskRounds, models: list[BoostModel], bins: Bins, track: bool | set[int], patience: int | None,
                no_change: tuple[int, float] | None, only: list[int] | None = None) -> None:
    """Grows all models (or some) round by round until each has its rounds or stops."""
    configs = [m.config for m in models]
    active = {m for m in (range(len(models)) if only is None else only) if configs[m].n_rounds > 0}
    for t in range(max((configs[m].n_rounds for m in active), default=0)):
        if not active:
            break
        growth = rounds.grow(t, {m: configs[m].max_depth for m in sorted(active)}, _features_of(configs, bins, t))
        by_model: dict[int, list] = {m: [] for m in active}
        for kv in growth.nodes.items():
            by_model[kv[0][0]].append(kv)
        for m, items in by_model.items():
            models[m].nodes.extend(node_rows(items, bins, lambda rec, c=configs[m]: _describe(rec, c), lambda _, t=t: t))
        rounds.move(growth.states(value=lambda m, rec: _leaf_value(rec, configs[m])), t)
        if patience or no_change or (t in track if isinstance(track, set) else track):
            for m, role, loss, hits, n in rounds.losses({m: configs[m].holdout_fold for m in sorted(active)}, configs[0].kind == "squared"):
                models[m].history.append({"eval_set": role, "iteration": t, "logloss": loss / n, "accuracy": hits / n})
        active = {m for m in active if t + 1 < configs[m].n_rounds and not (patience and _exhausted(models[m], patience))
                  and not (no_change and _stalled(models[m], *no_change))}


def _shares(n: int, features: int, row_bytes: int, configs: list[BoostConfig], gang: int, node_sums: int) -> tuple[list[list[int]], bool]:
    """The models of each task, and whether the tasks share the rows, and all models, between them; no group where the rows fit no task.

    Models grow apart from each other, so the tasks may each hold all rows and grow some of the models. They share the rows where these do not
    fit, or where that should take less time, the sums that they exchange at every level included.
    """
    everything = list(range(len(configs)))
    if n * (features + len(configs)) <= TASK_CELLS:
        return [everything], False
    groups: list[list[int]] = [[] for _ in range(min(gang, len(configs)))]
    work = lambda models: sum(configs[m].n_rounds * (configs[m].max_depth + 1) for m in models)
    for m in sorted(everything, key=lambda m: -work([m])):
        min(groups, key=work).append(m)
    sent = 8 * 3 * sum(c.n_rounds * 2**c.max_depth for c in configs) * node_sums * gang
    alone = max(map(work, groups)) * n * ROW_S
    shared = work(everything) * n * ROW_S / gang + max(c.n_rounds * c.max_depth for c in configs) * GATHER_S + sent * SENT_S
    fits = n * (row_bytes + 40 * max(map(len, groups))) <= TASK_BYTES
    if gang > 1 and n / gang * (row_bytes + 40 * len(configs)) <= TASK_BYTES and (shared < alone or not fits):
        return [everything], True
    return (groups, False) if fits else ([], False)


def _counted(rows: DataFrame, bins: Bins, tasks: int, samples: list[tuple[int, float]], rounds: int) -> DataFrame:
    """The cells of the rows, with how many rows each round of each sample draws."""
    def draws(keys: pa.Array) -> np.ndarray:
        texts = keys.cast(pa.binary()).to_pylist()
        return np.stack([d for t in range(rounds) for d in _draws(texts, samples, t)], axis=1).reshape(len(texts), rounds, -1).swapaxes(1, 2).reshape(len(texts), -1)

    return count_cells(rows, bins, tasks, draws if samples and rounds else None, 1 + len(samples) * rounds)


def _in_tasks(state: DataFrame, groups: list[list[int]], gang: int, models: list[BoostModel], source: BoostSource, rule, bins: Bins,
              samples: list[tuple[int, float]], stops: tuple) -> list[BoostModel]:
    """All rounds in one job. Each task holds all rows and grows a group of the models, or the tasks of a ``gang`` hold a share of the rows each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = HeldRows.of(batches, bins, rounds)
        if gang or len(held.x):
            grown = pickle.loads(empty)
            _run_rounds(TaskRounds(held, [m.base_margin for m in grown], source, rule, bins, samples, gather if gang else None), grown, bins, *stops, only=groups[place])
            if not gang or first_of_gang():
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps({m: grown[m] for m in groups[place]})], pa.binary())], names=["grown"])

    empty, rounds = pickle.dumps(models), max(m.config.n_rounds for m in models)
    given = state.select("block") if "block" in state.columns else state
    if gang:
        given = given if "cells" in state.columns else given.repartition(gang)
    elif len(groups) > 1:
        given = given.withColumn("place", F.explode(F.array(*[F.lit(i) for i in range(len(groups))]))).repartitionById(len(groups), F.col("place"))
    else:
        given = given.coalesce(1)
    with anywhere(state.sparkSession) if gang else nullcontext():
        found = given.mapInArrow(run, "grown binary", barrier=bool(gang)).collect()  # a row per group
    grown = {m: model for r in found for m, model in pickle.loads(r["grown"]).items()}
    return [grown.get(m, model) for m, model in enumerate(models)]


def _draws(texts: list[bytes], samples: list[tuple[int, float]], t: int) -> list[np.ndarray]:
    """Per subsample (seed, share): whether round ``t`` draws the row, by the first 32 bits of the md5 of its key."""
    units: dict[int, np.ndarray] = {}
    for seed, _ in samples:
        if seed not in units:
            units[seed] = next(md5_units(texts, [f"{seed}:row:{t}".encode()]))[:, 0] / 2.0**32
    return [units[seed] < share for seed, share in samples]


def _base_margins(fit_rows: DataFrame, configs: list[BoostConfig], fold: str | None) -> list[float]:
    """Where each model starts; the rates of all folds come from one scan."""
    if any(c.base_score == "prior" for c in configs):
        by = F.col(fold) if fold else F.lit(None).cast("int")
        sums = fit_rows.groupBy(by.alias("f")).agg(F.sum(F.col("label").cast("double")).alias("s"), F.count("label").alias("n")).collect()
    out = []
    for c in configs:
        p = c.base_score
        if p == "prior":
            mine = [r for r in sums if c.holdout_fold is None or r["f"] != c.holdout_fold]
            n = sum(r["n"] for r in mine)
            p = sum(r["s"] or 0.0 for r in mine) / n if n else (0.0 if c.kind == "squared" else 0.5)
        if c.kind == "squared":
            out.append(float(p))
            continue
        p = min(max(float(p), PRIOR_EDGE), 1.0 - PRIOR_EDGE)  # a fit on one class only still has a finite start
        out.append(math.log(p / (1.0 - p)) if p != 0.5 else 0.0)
    return out


def _features_of(configs: list[BoostConfig], bins: Bins, t: int):
    """(model, node) -> features of a round's tree, of which ``max_features`` leaves each split a subset."""
    p = len(bins.cols)
    chosen, split = {}, {}
    for m, c in enumerate(configs):
        keep = max(1, math.floor(c.colsample_bytree * p))
        chosen[m] = list(range(p)) if keep >= p else ranked_subset(bins.cols, keep, c.seed, t)
        split[m] = None if c.max_features is None else feature_choice([bins.cols[i] for i in chosen[m]], c.max_features, c.seed)
    return lambda m, node: chosen[m] if split[m] is None else [chosen[m][i] for i in split[m](t, node)]


def _moved(state: DataFrame, trees: dict, samples: list[tuple[int, float]], t: int, base: list[float] | None = None) -> DataFrame:
    """``state`` with the leaf values of ``trees`` added to the margins of their models (at first ``base``), and with the draws of round ``t``."""
    sent = state.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches):
            if base is not None:
                rows = rows.append_column("margins", pack(np.tile(np.array(base, MARGINS), (rows.num_rows, 1))))
            if sent.value:
                x, margins = matrix_of(rows["bins"], BINS), matrix_of(rows["margins"], MARGINS).copy()
                for m, a in sent.value.items():
                    if len(a.value):
                        margins[:, m] += a.value[a.walk(x)]
                rows = rows.set_column(rows.schema.get_field_index("margins"), "margins", pack(margins))
            rows = rows.drop_columns([c for c in rows.column_names if c in names])
            texts = rows["key"].cast(pa.binary()).to_pylist() if samples else []
            for name, drawn in zip(names, _draws(texts, samples, t), strict=True):
                rows = rows.append_column(name, pa.array(drawn))
            yield block_of(rows)

    names = [f"k{i}" for i in range(len(samples))]
    return state.mapInArrow(run, "block binary, n long")


def _leaf_value(rec: dict, c: BoostConfig) -> float:
    if c.kind != "newton":
        return c.learning_rate * rec["s"] / rec["q"] if rec["q"] > 1e-150 else 0.0
    g = math.copysign(max(abs(rec["g"]) - c.reg_alpha, 0.0), rec["g"])
    return c.learning_rate * -g / (rec["h"] + c.reg_lambda)


def _describe(rec: dict, c: BoostConfig) -> dict:
    value = _leaf_value(rec, c)
    return {"impurity": None, "class_counts": None, "prediction": value, "value": value, "cover": rec["h"] if c.kind == "newton" else rec["n"]}


def _coded(role: pa.ChunkedArray) -> tuple[list[str], np.ndarray]:
    """The distinct roles and the number of each row's among them; null is the text None."""
    coded = role.combine_chunks().fill_null("None").dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)


def _add_losses(total: dict, roles: list[str], code: np.ndarray, fold: np.ndarray, label: np.ndarray, margin_of, holdouts: dict[int, int | None],
                squared: bool, weights: np.ndarray | None = None) -> None:
    """Adds (loss, hits, rows) of every model on every set to ``total``; ``weights`` says how many rows each one stands for."""
    weights = np.ones(len(label)) if weights is None else weights
    for m, held in holdouts.items():
        margin = margin_of(m)
        if squared:
            loss, hit = (label - margin) ** 2, np.zeros(len(label))
        else:
            p = np.clip(1.0 / (1.0 + np.exp(-margin)), LOSS_EDGE, 1.0 - LOSS_EDGE)
            loss, hit = -np.log(np.where(label == 1, p, 1.0 - p)), (margin > 0) == (label == 1)
        where = code if held is None else np.where(fold == held, len(roles), code)
        sums = np.stack([np.bincount(where, v, len(roles) + 1) for v in (loss * weights, hit * weights, weights)], axis=1)
        for name, row in zip([*roles, "holdout"], sums, strict=True):
            if row[2]:
                total[m, name] = total.get((m, name), 0.0) + row


def _stalled(model: BoostModel, rounds: int, tol: float) -> bool:
    curve = _watched(model)
    return len(curve) > rounds and curve[-1] + tol >= max(curve[-1 - rounds:-1])


def _exhausted(model: BoostModel, patience: int) -> bool:
    curve = _watched(model)
    best = min(range(len(curve)), key=lambda i: (curve[i], i))
    return len(curve) - 1 - best >= patience


def _watched_sets(df: DataFrame, role: str | None, configs: list[BoostConfig], eval_sets: list[str] | None, needed: bool) -> list[str]:
    if eval_sets:
        return [eval_sets[-1]] * len(configs)
    others: list[str] = []
    if role and needed and any(c.holdout_fold is None for c in configs):
        others = sorted(r[0] for r in df.select(role).where(F.col(role) != "train").distinct().limit(3).collect())
        if len(others) > 1:
            raise ValueError(f"name the eval sets in order, the one to watch last: {others}")
    return ["holdout" if c.holdout_fold is not None else others[0] if others else "train" for c in configs]


def _watched(model: BoostModel) -> list[float]:
    return [h["logloss"] for h in sorted(model.history, key=lambda h: h["iteration"]) if h["eval_set"] == model.watch]


def best_iteration(model: BoostModel) -> tuple[int, float]:
    """0-based round of the first minimum of the watched loss, and that loss."""
    curve = _watched(model)
    best = min(range(len(curve)), key=lambda i: (curve[i], i))
    return best, curve[best]


def boost_early_stop(df: DataFrame, cols: list[str], config: BoostConfig, role: str, patience: int = 30, **kw) -> BoostModel:
    """Fit until the eval loss has not improved for ``patience`` rounds and keep the best prefix.

    The history keeps every round that was run.
    """
    model, = boost(df, cols, [config], role=role, patience=patience, **kw)
    best, _ = best_iteration(model)
    return replace(model.prefix(best + 1), history=model.history)


def score_boost(df: DataFrame, model: BoostModel) -> DataFrame:
    """Add ``margin``, ``p1`` and ``prediction``; stateless, one scan."""
    margin = F.lit(model.base_margin) + (tree_sum(model.nodes, model.cols) if model.nodes else F.lit(0.0))
    df = df.withColumn("margin", margin)
    return df.withColumn("p1", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))).withColumn(
        "prediction", (F.col("p1") > 0.5).cast("int"))


def history_table(spark: SparkSession, models: list[BoostModel]) -> DataFrame:
    """Learning curves as ``(model, eval_set, iteration, logloss, accuracy)``."""
    schema = T.StructType([T.StructField("model", T.StringType()), T.StructField("eval_set", T.StringType()),
                           T.StructField("iteration", T.IntegerType()), T.StructField("logloss", T.DoubleType()),
                           T.StructField("accuracy", T.DoubleType())])
    return local_table(spark, [{"model": m.config.name, **h} for m in models for h in m.history], schema)


def gbt(n_rounds: int = 100, learning_rate: float = 0.1, max_depth: int = 3, subsample: float = 1.0,
        max_features: str = "all", max_bins: int = 32, seed: int = 42, **params) -> GBTClassifier:
    """Spark's gradient-boosted trees (the first tree has weight 1, p = sigmoid(2F))."""
    return GBTClassifier(maxIter=n_rounds, stepSize=learning_rate, maxDepth=max_depth, subsamplingRate=subsample,
                         featureSubsetStrategy=max_features, maxBins=max_bins, seed=seed, **params)


def staged_loss(df: DataFrame, nodes: DataFrame | list[dict], cols: list[str], by: str = "split",
                base_margin: float = 0.0, scale: float = 1.0) -> DataFrame:
    """Log loss and accuracy of every prefix of a boosted model: ``(by, iteration, log_loss, accuracy)``.

    ``scale`` 2 turns a Spark margin into a log-odds. Running sums are taken within the row, so no
    (row, tree) pair is shuffled.
    """
    rows = rows_of(nodes)
    weights = [w for _, w in sorted({(r["tree_id"], r["tree_weight"]) for r in rows})]
    values = F.zip_with(tree_values(rows, cols), F.array(*[F.lit(float(w)) for w in weights]), lambda v, w: v * w)
    parts = df.select(F.col(by).alias("by"), F.col("label").cast("int").alias("label"), values.alias("v")).mapInPandas(
        _stages(base_margin, scale), "by string, iteration int, loss double, hits long, n long")
    return parts.groupBy(F.col("by").alias(by), "iteration").agg(
        (F.sum("loss") / F.sum("n")).alias("log_loss"), (F.sum("hits") / F.sum("n")).alias("accuracy"))


def _stages(base_margin: float, scale: float):
    def run(batches):
        for b in batches:
            for name, part in b.groupby("by"):
                margin = base_margin + scale * np.stack(part["v"].to_numpy()).cumsum(axis=1)
                one = part["label"].to_numpy()[:, None] == 1
                loss = np.logaddexp(0.0, np.where(one, -margin, margin))
                yield pd.DataFrame({"by": name, "iteration": np.arange(margin.shape[1], dtype=np.int32),
                                    "loss": loss.sum(axis=0), "hits": ((margin > 0) == one).sum(axis=0), "n": len(part)})
    return run


def gbt_early_stop(df: DataFrame, nodes: list[dict], cols: list[str], n_no_change: int = 20, by: str = "split",
                   eval_set: str = "valid", scale: float = 2.0, tol: float = 1e-4) -> tuple[list[dict], DataFrame]:
    """Keep the prefix of a boosted model at which its loss on the inner hold-out stops falling.

    Returns the kept node rows and the one-row stop report.
    """
    losses = staged_loss(df.where(F.col(by) == eval_set), nodes, cols, by, scale=scale)
    stop = window_stop(losses, n_no_change, tol, loss="log_loss")
    kept = stop.first()["n_estimators"]
    return [r for r in nodes if r["tree_id"] < kept], stop


def residual_boosting(df: DataFrame, x_cols: list[str], y: str = "y", rounds: int = 5, learning_rate: float = 0.5,
                      max_depth: int = 2, max_bins: int = 32, method: str = "quantile") -> DataFrame:
    """Boosting by hand on residuals: start at the mean, fit a small tree to the residual, add a share of it.

    Returns ``(round, mse)``; round 0 is the mean alone.
    """
    n, spread = df.agg(F.count(y), F.var_pop(y)).first()
    config = BoostConfig(n_rounds=rounds, learning_rate=learning_rate, max_depth=max_depth, base_score="prior", kind="squared")
    rows = df.select(F.col(y).cast("double").alias("label"), F.lit("").alias("row_id"), *[F.col(c) for c in x_cols])
    curve = [{"round": 0, "mse": spread}]
    if n and rounds:
        model, = boost(rows, x_cols, [config], max_bins=max_bins, method=method)
        curve += [{"round": h["iteration"] + 1, "mse": h["logloss"]} for h in model.history]
    schema = T.StructType([T.StructField("round", T.IntegerType()), T.StructField("mse", T.DoubleType())])
    return local_table(df.sparkSession, curve, schema)

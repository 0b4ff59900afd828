"""Rows added up by their bins: what a grower asks of a row depends on nothing else, so equal ones are counted together.

There are at most as many cells as the bins of all features multiply to, however many rows there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treelab.operators.bins import Bins
from treelab.operators.grower import BINS

#: Cells of all features up to which rows are added up.
MAX_CELLS = 1 << 24
#: Cells with their labels, or rows, up to which a task holds all of them for some trees.
HELD_ROWS = 4_000_000
#: Rows that a task adds up in one go, and cells that it holds before it passes them on.
COUNT_ROWS, HELD_CELLS = 1 << 19, 1 << 20

FIELDS = "role string, fold int, label int, cells binary, counts binary, n long"


def cell_sizes(bins: Bins) -> list[int]:
    """Bins per feature, with one for missing values."""
    return [len(e) + 2 for e in bins.edges]


def binned_rows(b: pa.RecordBatch, edges: list[np.ndarray]) -> np.ndarray:
    """(rows, features) bins of the columns x0, x1, ...; -1 is a missing value."""
    out = np.empty((b.num_rows, len(edges)), BINS)
    for i, cuts in enumerate(edges):
        x = b[f"x{i}"].to_numpy(zero_copy_only=False)
        out[:, i] = np.where(np.isnan(x), -1, np.searchsorted(cuts, x, "left"))
    return out


def cells_of(b: pa.RecordBatch, edges: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    """The cell number of every row."""
    cell = np.zeros(b.num_rows, np.int64)
    for size, digit in zip(sizes, binned_rows(b, edges).T, strict=True):
        cell = cell * size + digit + 1
    return cell


def bins_of(cells: np.ndarray, bins: Bins) -> np.ndarray:
    """The bins of cell numbers."""
    out = np.empty((len(cells), len(bins.edges)), BINS)
    for i, size in reversed([*enumerate(cell_sizes(bins))]):
        cells, digit = np.divmod(cells, size)
        out[:, i] = digit - 1
    return out


def count_cells(rows: DataFrame, bins: Bins, tasks: int, draws=None, columns: int = 1) -> DataFrame:
    """``FIELDS``: a row per role, fold, label and task with the numbers of its cells and the counts of their rows, in ``tasks`` partitions.

    ``rows`` has role, fold, label, [key,] and the features; ``draws`` turns the keys into flags, of which every column is counted too.
    All rows of a cell come to the same partition.
    """
    edges, sizes = [np.array(e) for e in bins.edges], cell_sizes(bins)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        waiting: dict[tuple, list] = {}
        n = 0
        for b in batches:
            if not b.num_rows:
                continue
            cell = cells_of(b, edges, sizes)
            flags = draws(b["key"]) if draws else np.zeros((b.num_rows, 0), bool)
            for key, mine in _parts(b):
                waiting.setdefault(key, []).append((cell[mine], flags[mine]))
            n += b.num_rows
            if n >= COUNT_ROWS:
                _add(held, waiting)
                n = 0
                if sum(len(c) for c, _ in held.values()) > HELD_CELLS:
                    yield from _sent(held, tasks)
                    held = {}
        _add(held, waiting)
        yield from _sent(held, tasks)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for b in batches:
            for r in b.to_pylist():
                cells = np.frombuffer(r["cells"], np.int64)
                held.setdefault((r["role"], r["fold"], r["label"]), []).append((cells, np.frombuffer(r["counts"], np.int64).reshape(len(cells), columns)))
        for key in sorted(held, key=str):
            cells, counts = _summed(*map(np.concatenate, zip(*held.pop(key))))
            yield _row(*key, cells, counts)

    given = rows.select("role", "fold", "label", *(["key"] if draws else []), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(bins.cols)])
    sent = given.mapInArrow(count, FIELDS + ", place int").repartitionById(tasks, F.col("place")).drop("place")
    return sent.mapInArrow(merge, FIELDS)


def _parts(b: pa.RecordBatch) -> list[tuple[tuple, np.ndarray]]:
    """The rows of a batch by (role, fold, label)."""
    found = {}
    for i, name in enumerate(("role", "fold", "label")):
        coded = b[name].dictionary_encode()
        found[name] = [*coded.dictionary.to_pylist(), None], coded.indices.fill_null(len(coded.dictionary)).to_numpy().astype(np.int64)
    (roles, role), (folds, fold), (labels, label) = found.values()
    code, at = np.unique((role * len(folds) + fold) * len(labels) + label, return_inverse=True)
    order, ends = np.argsort(at, kind="stable"), np.append(0, np.cumsum(np.bincount(at)))
    return [((roles[c // len(labels) // len(folds)], folds[c // len(labels) % len(folds)], labels[c % len(labels)]), order[lo:hi])
            for c, lo, hi in zip(code.tolist(), ends, ends[1:])]


def _summed(cells: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts added up by cell, in order."""
    order = np.argsort(cells, kind="stable")
    cells = cells[order]
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    return cells[first], np.add.reduceat(counts[order], first, axis=0) if len(first) else counts


def _add(held: dict, waiting: dict) -> None:
    for key, parts in waiting.items():
        cells = np.concatenate([c for c, _ in parts])
        counts = np.concatenate([f for _, f in parts])
        cells, counts = _summed(cells, np.column_stack((np.ones(len(cells), np.int64), counts)).astype(np.int64))
        if key in held:
            cells, counts = _summed(*(np.concatenate(x) for x in zip(held[key], (cells, counts))))
        held[key] = cells, counts
    waiting.clear()


def _sent(held: dict, tasks: int) -> Iterator[pa.RecordBatch]:
    for key, (cells, counts) in held.items():
        place = ((cells * 0x9E3779B1 & 0xFFFFFFFF) >> 8) % tasks
        for i in range(tasks):
            mine = place == i
            if mine.any():
                yield _row(*key, cells[mine], counts[mine], i)


def _row(role, fold, label, cells: np.ndarray, counts: np.ndarray, place: int | None = None) -> pa.RecordBatch:
    columns = {"role": pa.array([role], pa.string()), "fold": pa.array([fold], pa.int32()), "label": pa.array([label], pa.int32()),
               "cells": pa.array([cells.tobytes()], pa.binary()), "counts": pa.array([np.ascontiguousarray(counts).tobytes()], pa.binary()), "n": pa.array([len(cells)], pa.int64())}
    if place is not None:
        columns["place"] = pa.array([place], pa.int32())
    return pa.RecordBatch.from_pydict(columns)


def can_count(bins: Bins) -> bool:
    return math.prod(cell_sizes(bins)) <= MAX_CELLS


def task_holds(bins: Bins) -> bool:
    """Whether one task can hold the rows the bins were fitted on, or the cells with two labels that these make."""
    return can_count(bins) and min(bins.rows, 2 * math.prod(len(e) + 1 + bins.missing for e in bins.edges)) <= HELD_ROWS

"""Feature binning: cut points per feature and the ``bins`` array column the growers read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treelab.functions.ranks import bucketize, splitters


@dataclass
class Bins:
    """Cut points: ``value <= edges[f][b]`` holds exactly for rows with bin <= b."""

    cols: list[str]
    edges: list[list[float]] = field(default_factory=list)
    missing: bool = False  # whether a row it was fitted on lacks a value
    rows: int = 0          # rows it was fitted on


def fit_bins(df: DataFrame, cols: list[str], max_bins: int = 32, method: str = "quantile") -> Bins:
    """Find cut points.

    A feature with at most ``max_bins`` distinct values gets the midpoints between them, so no split is
    lost. Others get ``max_bins`` bins of equal frequency (``quantile``, by a bounded sketch) or of equal
    width (``width``). Null and NaN are missing: they count for no feature's values.
    """
    clean = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"x{i}") for i, c in enumerate(cols)])
    row: dict = {"n": 0, **{f"{k}{i}": None if k in ("lo", "hi") else 0 for k in ("c", "lo", "hi") for i in range(len(cols))}}
    few: dict[int, set] = {i: set() for i in range(len(cols))}  # features that have at most max_bins values in every task, with these values
    for r in clean.mapInArrow(_summaries(len(cols), max_bins), "i int, n long, c long, lo double, hi double, v array<double>").collect():  # a row per feature and task
        i = r["i"]
        row["n"] += r["n"] if i == 0 else 0
        row[f"c{i}"] += r["c"]
        if r["lo"] is not None:
            row[f"lo{i}"] = r["lo"] if row[f"lo{i}"] is None else min(row[f"lo{i}"], r["lo"])
            row[f"hi{i}"] = r["hi"] if row[f"hi{i}"] is None else max(row[f"hi{i}"], r["hi"])
        if i in few:
            few[i].update(r["v"] or [])
            if r["v"] is None or len(few[i]) > max_bins:
                del few[i]
    edges: list = [None] * len(cols)
    for i, values in few.items():
        v = sorted(values)
        edges[i] = [(a + b) / 2.0 for a, b in zip(v, v[1:])]
    for i in range(len(cols)):
        if row[f"lo{i}"] is None:  # no value at all: one bin
            edges[i] = []
    rest = [i for i in range(len(cols)) if edges[i] is None]
    if rest and method == "width":
        for i in rest:
            lo, hi = row[f"lo{i}"], row[f"hi{i}"]
            edges[i] = [lo + (hi - lo) * k / max_bins for k in range(1, max_bins)]
    elif rest:
        for i, cuts in zip(rest, splitters(clean, [f"x{i}" for i in rest], max_bins, accuracy=100 * max_bins)):
            edges[i] = [c for c in cuts if c < row[f"hi{i}"]]
    return Bins(list(cols), edges, any(row[f"c{i}"] < row["n"] for i in range(len(cols))), row["n"])


def _summaries(n_cols: int, max_bins: int):
    """Rows, values, least, greatest and, if they are at most ``max_bins``, the distinct values of every feature in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, count, lo, hi = 0, [0] * n_cols, [None] * n_cols, [None] * n_cols
        seen: list[np.ndarray | None] = [np.empty(0)] * n_cols
        for b in batches:
            n += b.num_rows
            for i in range(n_cols):
                x = b[f"x{i}"].drop_null().to_numpy()
                if not len(x):
                    continue
                x = x + 0.0  # -0.0 is 0.0
                count[i] += len(x)
                low, high = float(x.min()), float(x.max())
                lo[i], hi[i] = low if lo[i] is None else min(lo[i], low), high if hi[i] is None else max(hi[i], high)
                if seen[i] is not None:
                    fresh = x[~np.isin(x, seen[i])]
                    if len(fresh):
                        seen[i] = np.union1d(seen[i], fresh)
                        if len(seen[i]) > max_bins:
                            seen[i] = None
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(n_cols), pa.int32()), pa.array([n] * n_cols, pa.int64()), pa.array(count, pa.int64()), pa.array(lo, pa.float64()),
             pa.array(hi, pa.float64()), pa.array([None if v is None else v.tolist() for v in seen], pa.list_(pa.float64()))], names=["i", "n", "c", "lo", "hi", "v"])

    return run


def with_bins(df: DataFrame, bins: Bins, out: str = "bins") -> DataFrame:
    """Add ``array<smallint>`` of bin indices; a missing value is -1."""
    outs = [f"__bin{i}" for i in range(len(bins.cols))]
    wide = bucketize(df, bins.cols, bins.edges, outs)
    return wide.select(*[F.col(f"`{c}`") for c in df.columns],
                       F.array(*[F.col(o).cast("smallint") for o in outs]).alias(out))

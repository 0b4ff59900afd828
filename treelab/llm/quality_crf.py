"""Document quality from a linear-chain conditional random field over lines.

Each line with a word is good or bad. Its score is linear in features of the line and of the lines before and after; neighbouring
states interact. Forward-backward gives each line's probability of being good; their mean, weighted by the lines' lengths, goes
through a fitted logistic curve and is the document's score. The field is trained on labelled documents (each line carries its
document's label) from a bounded sample: ``max_rows`` rows with the smallest hash of doc_id; of these, texts of more than ``MAX_LINES`` lines are left out.
Every document is scored over all its lines.

Scores use the text alone. Null and empty texts, and texts without words, have no lines and get the share of label 1 in the sample.
Null labels train nothing; without both labels the score is that share (1/2 if there is none). Repeated rows are scored one by
one. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from treelab.llm import text as X
from treelab.llm.linear import fit_logistic, sigmoid
from treelab.llm.shared import settle

MAX_ROWS = 8_000
MAX_LINES = 2_000
ROUNDS = 150
L2 = 1e-3
#: Fixed character classes of the features.
CLASSES = {"upper": bytes(range(65, 91)), "digit": b"0123456789", "bang": b"!?", "pipe": b"|", "mark": b"#*$%&", "other": b"<>{}[]\\/=_~^@+"}
N_BASE = len(CLASSES) + 7
N_FEATURES = 3 * N_BASE + 2


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line of each text (n + 1 entries), code points per line, and one row of ``N_BASE`` features per line with a word."""
    data, offsets, w = X.words(texts)
    start, end, doc, _ = X.spans(data != 10, offsets)
    line_hash = X.span_hashes(data, data != 10, start, end)
    first, last = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    full = last > first
    start, end, doc, line_hash, first, last = (x[full] for x in (start, end, doc, line_hash, first, last))
    n = len(start)
    words = (last - first).astype(np.float64)
    total = lambda values: np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    between = lambda t, a, b: (t[b] - t[a]).astype(np.float64)
    chars = between(total((data & 0xC0) != 0x80), start, end)
    size = np.maximum(chars, 1)
    columns = []
    for members in CLASSES.values():
        table = np.zeros(256, bool)
        table[list(members)] = True
        columns.append(between(total(table[data]), start, end) / size)
    line_of = np.repeat(np.arange(n), last - first)
    inside = np.repeat(first, last - first) + np.arange(len(line_of)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
    h = w.hash[inside]
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (line_of[1:] == line_of[:-1])
    _, seen = X.repeated(line_of, h)
    _, again = X.repeated(doc, line_hash)
    tail = data[np.maximum(end - 1, 0)] if n else np.zeros(0, np.uint8)
    columns += [np.bincount(line_of, weights=same, minlength=n) / words, np.bincount(line_of, weights=seen, minlength=n) / words, again.astype(float),
                np.log1p(words) / 5, np.minimum(chars / words / 20, 3), np.isin(tail, np.frombuffer(b".!?:;", np.uint8)).astype(float), np.ones(n)]
    return np.searchsorted(doc, np.arange(len(offsets))), chars, np.stack(columns, axis=1).astype(np.float32) if n else np.zeros((0, N_BASE), np.float32)


def with_neighbours(base: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Features of a line, of the line before and of the line after, and whether it is the first or the last."""
    n = len(base)
    head, foot = np.zeros(n, bool), np.zeros(n, bool)
    head[first[:-1][np.diff(first) > 0]] = True
    foot[first[1:][np.diff(first) > 0] - 1] = True
    before, after = np.zeros_like(base), np.zeros_like(base)
    before[1:], after[:-1] = base[:-1], base[1:]
    before[head], after[foot] = 0, 0
    return np.concatenate((base, before, after, head[:, None], foot[:, None]), axis=1).astype(np.float64)


class Chains:
    """The order in which lines are visited: step t holds line t of every text that has one, longest texts first."""

    def __init__(self, first: np.ndarray):
        size = np.diff(first)
        self.order = np.argsort(-size, kind="stable")
        ordered = size[self.order]
        self.begin = first[:-1][self.order]
        self.active = np.searchsorted(-ordered, -np.arange(1, (int(ordered[0]) if len(ordered) else 0) + 1), "right")

    def step(self, t: int) -> np.ndarray:
        return self.begin[: self.active[t]] + t


def forward_backward(score: np.ndarray, link: np.ndarray, chains: Chains, pairs: np.ndarray | None = None):
    """Probability that each line is good and the log normaliser of all texts together. ``score``: log odds of good by line;
    ``link[i, j]``: score of state i before state j. With ``pairs`` (weights by line) also the expected weighted pairs of states."""
    emit = np.exp(np.clip(score, -30, 30))
    move = np.exp(link)
    n, steps = len(score), len(chains.active)
    alpha, beta, scale = np.zeros((n, 2)), np.ones((n, 2)), np.ones(n)
    for t in range(steps):
        at = chains.step(t)
        a = np.ones((len(at), 2)) if t == 0 else alpha[at - 1] @ move
        a[:, 1] *= emit[at]
        scale[at] = a.sum(axis=1)
        alpha[at] = a / scale[at, None]
    expected = np.zeros((2, 2))
    for t in range(steps - 1, 0, -1):
        at = chains.step(t)
        b = beta[at].copy()
        b[:, 1] *= emit[at]
        if pairs is not None:
            joint = alpha[at - 1][:, :, None] * move[None] * b[:, None, :] / scale[at, None, None]
            expected += (joint * pairs[at, None, None]).sum(axis=0)
        beta[at - 1] = (b @ move.T) / scale[at, None]
    good = alpha[:, 1] * beta[:, 1]
    return good / np.maximum(good + alpha[:, 0] * beta[:, 0], 1e-300), float(np.log(scale).sum()), expected


@dataclass
class Field:
    weights: np.ndarray
    link: np.ndarray
    slope: float
    shift: float
    base_rate: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        first, chars, base = line_features(texts)
        mean = document_means(first, chars, self.line_probabilities(first, base))
        out = sigmoid(self.slope * _logit(np.nan_to_num(mean, nan=0.5)) + self.shift)
        return np.where(np.isnan(mean), self.base_rate, out)

    def line_probabilities(self, first: np.ndarray, base: np.ndarray) -> np.ndarray:
        return forward_backward(with_neighbours(base, first) @ self.weights, self.link, Chains(first))[0]


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def document_means(first: np.ndarray, chars: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Mean of line probabilities weighted by code points; NaN for texts without lines."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    total = np.bincount(doc, weights=chars, minlength=len(first) - 1)
    return np.divide(np.bincount(doc, weights=chars * good, minlength=len(first) - 1), total, out=np.full(len(total), np.nan), where=total > 0)


def fit_field(first: np.ndarray, chars: np.ndarray, base: np.ndarray, label: np.ndarray, rounds: int = ROUNDS, l2: float = L2) -> Field:
    """Maximum likelihood by adaptive gradient steps; texts count alike, whatever their number of lines."""
    rate = float(label.mean()) if len(label) else 0.5
    field = Field(np.zeros(N_FEATURES), np.zeros((2, 2)), 0.0, float(_logit(np.array([rate]))[0]), rate)
    size = np.diff(first)
    if not len(base) or rate in (0.0, 1.0):
        return field
    x, chains = with_neighbours(base, first), Chains(first)
    doc = np.repeat(np.arange(len(size)), size)
    y, weight = label[doc].astype(float), (1.0 / size[doc]) / (size > 0).sum()
    later = np.ones(len(doc), bool)
    later[first[:-1][size > 0]] = False
    seen = np.zeros((2, 2))
    for state in (0, 1):
        seen[state, state] = (weight * later * (y == state)).sum()
    theta = np.zeros(N_FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        w, link = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
        good, _, expected = forward_backward(x @ w, link, chains, weight)
        grad = np.concatenate((x.T @ (weight * (good - y)), (expected - seen).ravel())) + l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta - 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    field.weights, field.link = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
    mean = document_means(first, chars, field.line_probabilities(first, base))
    has = ~np.isnan(mean)
    slope, field.shift = fit_logistic(_logit(mean[has])[:, None], label[has].astype(float), 0.01)
    field.slope = float(slope[0])
    return field


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the doc_id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Field:
    """Fits the field; line features of the bounded sample reach the driver."""
    chosen = labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", F.col("text").alias("body")).join(settle(chosen, "quality-labels"), "doc_id").select("quality", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in X.steps(batches, "body"):
            first, chars, base = line_features(b["body"])
            ok = [i for i in range(b.num_rows) if first[i + 1] - first[i] <= MAX_LINES]
            yield pa.RecordBatch.from_arrays([
                pa.array([b["quality"][i].as_py() for i in ok], pa.int32()), pa.array([chars[first[i] : first[i + 1]].tobytes() for i in ok], pa.binary()),
                pa.array([base[first[i] : first[i + 1]].tobytes() for i in ok], pa.binary())], names=["quality", "chars", "base"])

    got = rows.mapInArrow(run, "quality int, chars binary, base binary").toArrow().sort_by([("chars", "ascending"), ("quality", "ascending")])
    chars = [np.frombuffer(c, np.float64) for c in got["chars"].to_pylist()]
    base = [np.frombuffer(c, np.float32).reshape(-1, N_BASE) for c in got["base"].to_pylist()]
    first = np.concatenate(([0], np.cumsum([len(c) for c in chars], dtype=np.int64))).astype(np.int64)
    flat = np.concatenate(base) if base else np.zeros((0, N_BASE), np.float32)
    return fit_field(first, np.concatenate(chars) if chars else np.zeros(0), flat, np.asarray(got["quality"], dtype=np.int64))


def score(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted; no shuffle."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in X.steps(batches, "body"):
            p = field.scores(b["body"])
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return rows.mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double, predicted int")

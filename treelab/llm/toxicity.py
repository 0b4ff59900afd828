"""Toxicity by classifier chains: linear models predict categories one after another, each with the probabilities of those before.

Features of a text are the presence and the repetition of terms: lower-cased words of letters, and heads of 5 and 7 bytes of longer
words. The terms that tell toxic from clean labelled rows apart (by a z-score over the counts of the training sample) are kept, by
score; a model sees those and the probabilities of earlier categories. While training, each later model gets out-of-fold probabilities, so it learns
from what the earlier models say about rows they did not see.

Categories are a parameter: each has seed words, and a labelled toxic row with one of them belongs to it; a toxic row without any
belongs to ``other``; the last link of the chain is ``toxic`` itself. The training sample is bounded (``max_rows`` rows with the
smallest hash of doc_id); every document is scored, over its whole text.

Null or empty texts have no terms and get the chain's base probabilities. Labels null, or of rows that are not in the documents,
train nothing; without both kinds of labels everything is clean. Repeated rows are scored one by one. Empty tables give
empty results. Other columns stay untouched in ``without_toxic``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treelab.llm import text as X
from treelab.llm.linear import fit_logistic, sigmoid
from treelab.llm.shared import settle

#: Fixed seed words of the categories, in the chain's order.
CATEGORIES = {
    "insult": ["idiot", "moron", "clown", "loser", "stupid"],
    "contempt": ["trash", "scum", "disgusting", "worthless", "pathetic"],
}
MAX_ROWS = 10_000
MAX_TERMS = 600
MIN_Z = 3.0
MIN_ROWS_WITH_TERM = 4
FOLDS = 3
L2 = 0.3
HEADS = (5, 7)


def feature_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 64-bit key of every term of every text (with repeats)."""
    data, _, keep, w = X.terms(texts)
    docs, keys = [w.doc], [w.hash]
    size = w.end - w.start
    for head in HEADS:
        long = size > head
        docs.append(w.doc[long])
        keys.append(X.mix(X.span_hashes(data, keep, w.start, w.end, head)[long] + np.uint64(head)))
    return np.concatenate(docs), np.concatenate(keys)


def word_keys(words: list[str]) -> np.ndarray:
    """Keys of single words."""
    return X.terms(pa.array(words))[3].hash


@dataclass
class Chain:
    """``keys`` sorted; per link a name, weights over present keys, then over repeated ones, over earlier links, and an intercept."""

    names: list[str]
    keys: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercepts: np.ndarray

    def probabilities(self, n: int, doc: np.ndarray, key: np.ndarray) -> np.ndarray:
        """n rows, one column per link, from the terms (doc, key) of n texts."""
        out = np.zeros((n, len(self.names)))
        size = max(len(self.keys), 1)
        place = np.minimum(np.searchsorted(self.keys, key), size - 1)
        hit = self.keys[place] == key if len(self.keys) else np.zeros(len(key), bool)
        pairs, times = np.unique(doc[hit] * size + place[hit], return_counts=True)
        row, column = np.divmod(np.concatenate((pairs, pairs[times > 1])), size)
        column[len(pairs) :] += size
        for k in range(len(self.names)):
            z = np.bincount(row, weights=self.weights[k][column], minlength=n) if len(row) else np.zeros(n)
            out[:, k] = sigmoid(z + out[:, :k] @ self.earlier[k, :k] + self.intercepts[k])
        return out


def training_sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """doc_id, toxic, keys (as longs, a repeated one twice) of at most ``max_rows`` labelled documents."""
    chosen = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", F.col("text").alias("body")).join(settle(chosen, "toxic-labels"), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in X.steps(batches, "body"):
            doc, key = feature_keys(b["body"])
            order = np.lexsort((key, doc))
            doc, key = doc[order], key[order]
            same = np.zeros(len(key), bool)
            same[1:] = (key[1:] == key[:-1]) & (doc[1:] == doc[:-1])
            kept = ~same
            kept[1:] |= same[1:] & ~same[:-1]  # the second of its kind, but no third
            doc, key = doc[kept], key[kept]
            ends = np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["toxic"], pa.ListArray.from_arrays(pa.array(ends), pa.array(key.view(np.int64)))],
                                             names=["doc_id", "toxic", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "toxic", "body").mapInArrow(run, f"doc_id {kind}, toxic int, keys array<bigint>")


def informative(sample: DataFrame, max_terms: int) -> np.ndarray:
    """Sorted keys of the terms whose counts in toxic and clean rows differ most."""
    n = sample.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    if not n["n"] or not n["t"] or n["t"] == n["n"]:
        return np.zeros(0, np.uint64)
    rate = n["t"] / n["n"]
    counts = sample.select("toxic", F.explode(F.array_distinct("keys")).alias("key")).groupBy("key").agg(F.count("*").alias("rows"), F.sum("toxic").alias("bad"))
    z = (F.col("bad") - F.col("rows") * F.lit(rate)) / F.sqrt(F.col("rows") * F.lit(rate * (1 - rate)))
    best = counts.where(F.col("rows") >= MIN_ROWS_WITH_TERM).withColumn("z", z).orderBy(F.desc("z"), "key").limit(max_terms).where(F.col("z") > MIN_Z)
    return np.sort(np.array([r["key"] for r in best.select("key").collect()], np.int64).view(np.uint64))


def train(docs: DataFrame, labels: DataFrame, categories: Mapping[str, list[str]] | None = None, max_rows: int = MAX_ROWS,
          max_terms: int = MAX_TERMS, folds: int = FOLDS) -> Chain:
    """Fits the chain on the bounded sample; only the kept features of the sample's rows reach the driver."""
    categories = CATEGORIES if categories is None else categories
    names = [*categories, "other", "toxic"]
    sample = settle(training_sample(docs, labels, max_rows), "toxic-sample")
    keys = informative(sample, max_terms)
    empty = Chain(names, keys[:0], np.zeros((len(names), 0)), np.zeros((len(names), len(names))), np.full(len(names), -35.0))
    if not len(keys):
        return empty
    seeds = {name: word_keys(words) for name, words in categories.items()}
    wanted = np.unique(np.concatenate([keys, *seeds.values()])).view(np.int64)
    lookup = sample.sparkSession.createDataFrame(pa.table({"key": pa.array(wanted)}))
    hits = sample.select("doc_id", "toxic", F.explode("keys").alias("key")).join(lookup, "key").groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    rows = sample.select("doc_id", "toxic").distinct().join(hits, "doc_id", "left").orderBy("doc_id").toArrow()
    n, y = rows.num_rows, np.asarray(rows["toxic"], dtype=np.float64)
    lists = rows["keys"].combine_chunks()
    lists = lists.fill_null([]) if lists.null_count else lists
    row = np.repeat(np.arange(n), np.diff(np.asarray(lists.offsets)))
    key = np.asarray(lists.values, dtype=np.int64).view(np.uint64)
    times = np.zeros((n, len(keys)), np.int8)
    place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    hit = keys[place] == key
    np.add.at(times, (row[hit], place[hit]), 1)
    x = np.concatenate((times > 0, times > 1), axis=1).astype(np.float32)
    targets = {}
    seen = np.zeros(n, bool)
    for name, words in seeds.items():
        has = np.zeros(n, bool)
        has[row[np.isin(key, words)]] = True
        targets[name], seen = (has & (y == 1)).astype(float), seen | has
    targets["other"], targets["toxic"] = ((y == 1) & ~seen).astype(float), y
    fold = X.mix(np.arange(n, dtype=np.uint64)) % np.uint64(folds)
    weights, earlier, intercepts = np.zeros((len(names), x.shape[1])), np.zeros((len(names), len(names))), np.zeros(len(names))
    before = np.zeros((n, 0), np.float32)
    for k, name in enumerate(names):
        full = np.concatenate((x, before), axis=1)
        out = np.zeros(n, np.float32)
        for f in range(folds):
            held = fold == f
            w, b = fit_logistic(full[~held], targets[name][~held], L2)
            out[held] = sigmoid(full[held] @ w + b)
        w, intercepts[k] = fit_logistic(full, targets[name], L2)
        weights[k], earlier[k, :k] = w[: x.shape[1]], w[x.shape[1] :]
        before = np.concatenate((before, out[:, None]), axis=1)
    return Chain(names, keys, weights, earlier, intercepts)


def score(docs: DataFrame, chain: Chain, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, p_<category> for each link; no shuffle."""
    columns = [f"p_{name}" for name in chain.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in X.steps(batches, "body"):
            p = chain.probabilities(b.num_rows, *feature_keys(b["body"]))
            yield pa.RecordBatch.from_arrays([b["doc_id"], *[pa.array(p[:, k]) for k in range(p.shape[1])]], names=["doc_id", *columns])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body"))
    return rows.mapInArrow(run, ", ".join([f"doc_id {kind}", *[f"{c} double" for c in columns]]))


def without_toxic(docs: DataFrame, chain: Chain, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose probability of ``toxic`` is below ``threshold``; no shuffle, rows pass through whole."""
    schema, at = docs.schema, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for b in X.steps([named], f"c{at}"):
                p = chain.probabilities(b.num_rows, *feature_keys(b[f"c{at}"]))
                yield b.filter(pa.array(p[:, -1] < threshold)).rename_columns(batch.schema.names)

    return docs.mapInArrow(run, schema)

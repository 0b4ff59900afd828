"""Host-level quality rules: count rule failures by host, shrink the rates with an empirical beta prior, judge documents by host.

Nulls: a null text has no words (so it fails the length rule); a null host is a host of its own. Repeated rows are judged
one by one and each counts for its host. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treelab.llm import text as X
from treelab.llm.shared import settle

#: Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: A host whose shrunk failure rate is above this is rejected with all its documents.
MAX_HOST_RATE = 0.5
#: The weight of the prior, in documents, stays between these.
PRIOR_WEIGHT = (1.0, 1000.0)

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """Word, symbol, line and repetition counts of each text."""
    data, offsets, w = X.words(texts)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True
    starts_char = (data & 0xC0) != 0x80
    at, doc, key = X.windows(w, REPEAT_WINDOW)
    full = np.repeat(np.diff(w.first), np.diff(np.searchsorted(at, w.first))) >= REPEAT_WINDOW
    at, doc, key = at[full], doc[full], key[full]
    twice, _ = X.repeated(doc, key)
    cover = np.zeros(len(w.start) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + REPEAT_WINDOW, -1)
    repeat = np.cumsum(cover[:-1]) > 0
    line_start, line_end, line_doc, line_first = X.spans(data != 10, offsets)
    line_hash = X.span_hashes(data, data != 10, line_start, line_end)
    has_word = np.searchsorted(w.start, line_end) > np.searchsorted(w.start, line_start)
    _, again = X.repeated(line_doc[has_word], line_hash[has_word])
    n = len(offsets) - 1
    return {"n_words": np.diff(w.first), "word_chars": X.per_text(starts_char & ~X.SPACE[data], offsets),
            "n_symbols": X.per_text(symbol[data], offsets),
            "n_dup_lines": np.bincount(line_doc[has_word][again], minlength=n).astype(np.int64),
            "n_repeat_words": X.per_text(repeat, w.first)}


def text_measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """``keep`` and the counts of ``measure`` for every row; whole texts, no shuffle."""
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("body"))
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in X.steps(batches, "body"):
            m = measure(b["body"])
            yield pa.RecordBatch.from_arrays([*[b[c] for c in names], *[pa.array(m[c], pa.int64()) for c in MEASURES]],
                                             names=[*names, *MEASURES])

    schema = ", ".join([*[f"{n} {rows.schema[n].dataType.simpleString()}" for n in names], *[f"{c} bigint" for c in MEASURES]])
    return rows.mapInArrow(run, schema).withColumnsRenamed(dict(zip(names, keep, strict=True)))


def rule_failures(measured: DataFrame) -> DataFrame:
    """Adds one boolean per rule and ``base_failed``."""
    short = F.col("n_words") < MIN_WORDS
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return measured.withColumns({"short_failed": short, "repeat_failed": repeats, "base_failed": short | repeats})


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Beta prior of the hosts' failure rates by moments, from one row of sums: ``hosts`` has n_docs and n_failed.

    The spread is weighted by documents. Without spread, or with only failures or none, the prior has its greatest weight.
    """
    rate = F.col("n_failed") / F.col("n_docs")
    s = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"),
                  F.sum(F.col("n_docs") * rate * rate).alias("q")).first()
    if not s["n"]:
        return 1.0, 1.0
    mean = s["f"] / s["n"]
    spread = s["q"] / s["n"] - mean * mean
    weight = mean * (1 - mean) / spread - 1 if spread > 1e-12 else PRIOR_WEIGHT[1]
    weight = min(max(weight, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1])
    return mean * weight, (1 - mean) * weight


def host_report(failed: DataFrame, host: str = "host") -> DataFrame:
    """A row per host: documents, failures of each rule, shrunk rate and verdict. Summed before the shuffle."""
    counts = settle(failed.groupBy(host).agg(
        F.count("*").alias("n_docs"), *[F.sum(F.col(c).cast("long")).alias(f"n_{c}") for c in ("short_failed", "repeat_failed")],
        F.sum(F.col("base_failed").cast("long")).alias("n_failed")), "host-counts")
    a, b = beta_prior(counts)
    return counts.withColumn("shrunk_rate", (F.col("n_failed") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))) \
        .withColumn("host_rejected", F.col("shrunk_rate") > MAX_HOST_RATE)


def judge(docs: DataFrame, host=None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document with its counts, rule failures, its host's shrunk rate and ``kept``.

    ``host`` is a column (default: ``source``); hosts are joined back from a settled table of one row per host, which Spark
    broadcasts if its size allows and else joins with skew handling.
    """
    host = F.col("source") if host is None else host
    named = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.col(text).alias("text"))
    failed = settle(rule_failures(text_measures(named, keep=("doc_id", "host"))), "rule-failures")
    verdicts = host_report(failed).select("host", "shrunk_rate", "host_rejected")
    return failed.join(verdicts, "host").withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))

"""Ranked search against a plain computation, ties across tiles, blocks and slices."""

import collections
import math
import random
import re

import numpy as np
import pytest

from treelab.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k):
    bags = [(i, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for i, b in bags:
            m = 100 - 90 + (90 * sum(b.values()) * n_docs) // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t in terms if t in b)
            if s > 0:
                scores.append((-s, i is not None, i or 0))
        out += [(item, r, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def sample(n, seed):
    random.seed(seed)
    words = ["a", "B", "Über", "über", "x1", "42", "naïve", "日本", "the", "THE", "q", "rare%d" % seed] + [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(random.choices(words, k=random.choice([0, 1, 5, 40])))) for i in range(n)]
    docs += [(n, None), (None, "the x1 w3"), (None, "the x1 w3"), (n + 1, ""), (n + 2, "-- !?"), (n + 3, "w1 w2 " * 9000)]
    docs += [(i, "same copy of the w3 text") for i in range(n + 10, n + 60)]  # ties beyond k, over tiles
    random.shuffle(docs)
    items = [(i, " ".join(random.choices(words, k=random.randint(1, 12)))) for i in range(30)] + [(100, None), (101, ""), (102, "copy"), (102, "copy"), (103, "absent")]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"block_terms": 60, "doc_tile": 13, "item_tile": 3, "width": 5}])
def test_search_equals_the_plain_computation(spark, sizes):
    docs, items = sample(150, 5)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).selectExpr("*", "1 AS n", "'c' AS codes", "2 AS item_id")
    got = lexical.search(frame, spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int"), **sizes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items, 10)


def test_slices_bound_the_sums():
    """With weights near the bound every slice ends early, and the sums stay exact."""
    rng = np.random.default_rng(1)
    weight = rng.integers(2**30, 2**32, 40)
    doc, code = (x.ravel() for x in np.meshgrid(np.arange(4), np.arange(40), indexing="ij"))
    impact = rng.integers(1, lexical.IMPACT, len(doc))
    item, term = (x.ravel() for x in np.meshgrid(np.arange(3), np.arange(40), indexing="ij"))
    got = lexical.tile_scores(doc, code, impact, 4, item, term, 3, weight, 10**6)
    want = [[sum(int(weight[t]) * int(impact[d * 40 + t]) for t in range(40))] * 3 for d in range(4)]
    assert got.tolist() == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in lexical.search(docs, items).collect()] == [(1, 1, 1)]

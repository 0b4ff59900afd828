"""Array kernels against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from treelab.llm import quality_rules, text as X

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1c\xa0#|.Ü", max_size=60), st.text(max_size=30)), max_size=8)


def split(t):
    return [w.decode() for w in (t or "").encode().split()]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_and_hashes(texts):
    data, offsets, w = X.words(pa.array(texts, pa.string()))
    want = [split(t) for t in texts]
    got = [[bytes(data[w.start[i] : w.end[i]]).decode() for i in range(w.first[d], w.first[d + 1])] for d in range(len(texts))]
    assert got == want
    flat = [x for ws in want for x in ws]
    assert len(set(w.hash.tolist())) == len(set(flat))
    assert len({(a, b) for a, b in zip(flat, w.hash.tolist(), strict=True)}) == len(set(flat))


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(2, 6))
def test_windows(texts, size):
    _, _, w = X.words(pa.array(texts, pa.string()))
    at, doc, key = X.windows(w, size)
    want = []
    for d, t in enumerate(texts):
        ws = split(t)
        want += [(d, tuple(ws[i : i + size])) for i in range(max(1, len(ws) - size + 1))] if ws else []
    assert doc.tolist() == [d for d, _ in want]
    assert len(set(zip((x for _, x in want), key.tolist(), strict=True))) == len({x for _, x in want}) == len(set(key.tolist()))


def test_terms_lower_case_and_strip():
    texts = ["Größe, ÉTÉ!! abc123def", None, "", "x" * 5000 + " Y"]
    data, _, _, w = X.terms(pa.array(texts, pa.string()))
    got = [bytes(data[s:e]).decode() for s, e in zip(w.start, w.end, strict=True)]
    assert got == ["größe", "été", "abc", "def", "x" * 5000, "y"]


def test_steps_keep_every_row():
    texts = pa.array(["a" * n for n in (0, 5, 100, 3, 0, 7)] + [None])
    batch = pa.RecordBatch.from_arrays([texts], names=["body"])
    parts = list(X.steps([batch, batch.slice(0, 0)], "body", 10))
    assert [x for p in parts for x in p["body"].to_pylist()] == texts.to_pylist()


def brute(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {p for places in windows.values() if len(places) > 1 for i in places for p in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n#é\r", max_size=120)), max_size=6))
def test_measures(texts):
    got = quality_rules.measure(pa.array(texts, pa.string()))
    rows = np.stack([got[c] for c in quality_rules.MEASURES], axis=1).tolist() if texts else []
    assert rows == [brute(t) for t in texts]

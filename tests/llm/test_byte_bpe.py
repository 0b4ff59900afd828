"""Merge replay against the library, piece by piece merging and round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from treelab.llm import byte_bpe
from treelab.llm.queries import QUERIES

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(PATH), special_tokens={})


HARD = ["", " ", "\n\n  \t", "it's we'll I'd 'S", "a" * 3001, "ab" * 777 + "a", " " * 500 + "x", "!" * 997, "0123456789" * 50, "日本語テキスト 漢字", "naïve Ünïcode ß x",
        "\U0001f600\U0001f468‍\U0001f469 é", "<|endoftext|>", "\x00\x01\x1c\x85", "aaaa aaa aa a" * 20, "﻿x̀"]


def test_ids_equal_the_library(library):
    code = byte_bpe.Codec(PATH, P.PATTERN)
    random.seed(3)
    letters = "etaoin shrdlu éß日1'’.\n" + "\U0001f600"
    texts = HARD + ["".join(random.choice(letters) for _ in range(random.randint(0, 400))) for _ in range(400)]
    for group in (texts[:100], texts[100:], HARD):  # the second time pieces are known
        ids, ends = code.encode(group)
        for i, t in enumerate(group):
            own = ids[ends[i] : ends[i + 1]]
            assert own.tolist() == library.encode_ordinary(t)
            assert code.decode(own)[0].tobytes() == t.encode()


def test_replay_follows_any_ranks():
    """Ranks that no training would give: a new pair may rank below the merge that made it."""
    random.seed(11)
    for _ in range(60):
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 256 + 40:
            tokens.add(bytes(random.choice(b"abc") for _ in range(random.randint(2, 5))))
        multi = [t for t in tokens if len(t) > 1]
        random.shuffle(multi)
        ranks = {t: i for i, t in enumerate(multi)} | {bytes([b]): 1000 + b for b in range(256)}
        pieces = list({bytes(random.choice(b"abc") for _ in range(random.randint(1, 14))) for _ in range(50)})
        ids, size = byte_bpe.Replay(ranks).merge(pieces)
        ends = np.cumsum(size)
        for p, a, b in zip(pieces, ends - size, ends, strict=True):
            assert ids[a:b].tolist() == merge_one(p, ranks)


def merge_one(piece, ranks):
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, 10**9), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 10**9:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_forgetting_keeps_ids(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MAX_PIECES", 3)
    code = byte_bpe.Codec(PATH, P.PATTERN)
    for t in ("one two three four five", "five six", "one more time"):
        assert code.encode([t])[0].tolist() == library.encode_ordinary(t)


def digest(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_query_equals_the_library(spark, data, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = QUERIES["op11_byte_bpe"](spark, data).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), digest(ids), hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest())


def test_edges(spark, library):
    """Nulls, repeated rows, clashing names, other columns, a very long text and an empty table."""
    long = "word " * 50_000 + "x" * 20_000
    rows = [(None, "a b", "n"), (1, None, "i"), (1, None, "i"), (2, "", None), (3, long, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = byte_bpe.decoded(byte_bpe.encoded(docs, PATH, P.PATTERN, ("doc_id",)), PATH, P.PATTERN).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"]).decode(), r["n_tokens"]) for r in out) == sorted(
        (i or 0, t or "", len(library.encode_ordinary(t or ""))) for i, t, _ in rows)
    named = byte_bpe.encoded(docs.withColumnRenamed("ids", "body"), PATH, P.PATTERN, ("doc_id", "body"))
    assert named.columns == ["doc_id", "body", "n_tokens", "ids"] and named.count() == 5
    assert byte_bpe.digests(docs.limit(0), PATH, P.PATTERN).collect() == []

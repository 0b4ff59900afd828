"""Byte-level BPE by corpus-level merge replay: whole texts to token ids and back.

The pieces of many texts (matches of the pattern) are numbered, and every distinct piece is merged once: the bytes of all new pieces
of a step lie end to end, an inverted index leads from each merge rank to the places where its pair stands, and the merges are replayed
in rank order over the whole step. A merge touches its two neighbours only, whose new pairs enter the index. Should a new pair rank below
the one in hand, the rest of that one waits, so each piece sees its merges in exactly the order of the library: lowest rank, then
leftmost. A piece that is a token by itself is that token. Texts are then gathered from the pieces by array operations.

Each task works on its own rows; nothing is shuffled. Null texts count as empty and have no ids. Repeated rows are encoded each. Very long
texts are taken whole, and a long piece costs n log n. Empty tables give empty results. Other columns are carried by name on request.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from treelab.llm import text as X

#: Bytes of text whose new pieces are merged together.
STEP = 3 << 20
#: Distinct pieces that a worker remembers; beyond it starts anew.
MAX_PIECES = 1_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks (which are their ids) from a file of base64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PairRanks(dict):
    """Rank of the merge of two token ids, found once per pair; -1 if their bytes are no token."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.token = ranks, {rank: token for token, rank in ranks.items()}

    def __missing__(self, pair: tuple[int, int]) -> int:
        rank = self[pair] = self.ranks.get(self.token[pair[0]] + self.token[pair[1]], -1)
        return rank


class Replay:
    """Merges the bytes of many pieces at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, PairRanks(ranks)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.byte_pair = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int32)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after another, and how many each has."""
        if not pieces:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begin = np.cumsum(size) - size
        last = np.zeros(len(data), bool)
        last[begin + size - 1] = True
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int32, len(pieces))
        symbol = self.byte_id[data]
        symbol[begin[whole >= 0]] = whole[whole >= 0]
        alive = np.repeat(whole < 0, size)
        first = np.zeros(len(data), bool)
        first[begin] = True
        symbol[~alive & ~first] = -1
        index = self._index(data, alive & ~last)
        place = np.arange(len(data), dtype=np.int64)
        done = self._replay(array("i", symbol.tobytes()), array("q", np.where(last, -1, place + 1).tobytes()),
                            array("q", np.where(first, -1, place - 1).tobytes()), index)
        ids = np.frombuffer(done, np.int32)
        kept = ids >= 0
        return ids[kept], np.add.reduceat(kept.astype(np.int64), begin)

    def _index(self, data: np.ndarray, inner: np.ndarray) -> dict[int, list[int]]:
        """Places of each rank among the pairs of bytes."""
        at = np.flatnonzero(inner)
        rank = self.byte_pair[data[at].astype(np.int32) * 256 + data[at + 1]] if len(at) else np.zeros(0, np.int32)
        at, rank = at[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cut = np.flatnonzero(np.diff(rank)) + 1
        return {int(rank[x[0]]): at[x].tolist() for x in np.split(np.arange(len(at)), cut)} if len(at) else {}

    def _replay(self, symbol: array, after: array, before: array, index: dict[int, list[int]]) -> array:
        pairs, waiting = self.pairs, list(index)
        heapq.heapify(waiting)
        while waiting:
            rank = heapq.heappop(waiting)
            places = index.pop(rank)
            places.sort()
            for done, i in enumerate(places, 1):
                j = after[i]
                if symbol[i] < 0 or j < 0 or pairs[symbol[i], symbol[j]] != rank:
                    continue  # a neighbour was merged since the place was noted
                symbol[i], symbol[j] = rank, -1
                k, h = after[j], before[i]
                after[i], lower = k, rank
                if k >= 0:
                    before[k] = i
                    new = pairs[rank, symbol[k]]
                    if new >= 0:
                        lower = min(lower, new)
                        if new in index:
                            index[new].append(i)
                        else:
                            index[new] = [i]
                            heapq.heappush(waiting, new)
                if h >= 0:
                    new = pairs[symbol[h], rank]
                    if new >= 0:
                        lower = min(lower, new)
                        if new in index:
                            index[new].append(h)
                        else:
                            index[new] = [h]
                            heapq.heappush(waiting, new)
                if lower < rank and done < len(places):  # the new pair comes first
                    index.setdefault(rank, []).extend(places[done:])
                    heapq.heappush(waiting, rank)
                    break
        return symbol


class _Numbers(dict):
    """Numbers pieces in the order of their first look-up."""

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        return number


class Codec:
    """Encodes and decodes with one file of ranks and one pattern; remembers the pieces it has merged."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.find = regex.compile(pattern).findall
        ranks = load_ranks(path)
        self.replay = Replay(ranks)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        self.token_bytes = np.frombuffer(b"".join(table), np.uint8)
        self.token_size = np.fromiter(map(len, table), np.int64, len(table))
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.ids = _Numbers(), np.zeros(0, np.int32)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the n + 1 places where texts begin and end."""
        if len(self.numbers) > MAX_PIECES:
            self._forget()
        known = len(self.numbers)
        look = self.numbers.__getitem__
        parts = [np.fromiter(map(look, self.find(t)), np.int32) for t in texts]
        if len(self.numbers) > known:
            fresh = list(self.numbers)[known:] if known else list(self.numbers)
            ids, size = self.replay.merge([p.encode() for p in fresh])
            self.start = np.concatenate((self.start, len(self.ids) + np.cumsum(size) - size))
            self.ids, self.size = np.concatenate((self.ids, ids)), np.concatenate((self.size, size))
        piece = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        ends = np.cumsum([0, *map(len, parts)])
        total = np.concatenate(([0], np.cumsum(self.size[piece])))
        return gather(self.ids, self.start[piece], self.size[piece]), total[ends]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and the n + 1 places where ids begin and end."""
        size = self.token_size[ids]
        return gather(self.token_bytes, self.token_start[ids], size), np.concatenate(([0], np.cumsum(size)))


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``values`` from ``start``, ``size`` long, one after another."""
    total = int(size.sum())
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    at = np.repeat((start - (np.cumsum(size) - size)).astype(kind), size)
    at += np.arange(total, dtype=kind)
    return values[at]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker, file and pattern."""
    return Codec(path, pattern)


def public_pattern() -> str:
    """The pattern of the public files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Byte strings that lie end to end, as an array of binaries."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]) \
        .cast(pa.binary())


def encoded(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers) of every row's whole text."""
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.coalesce(text, F.lit("")).alias("body"))
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path, pattern)
        for b in X.steps(batches, "body", STEP):
            ids, ends = code.encode(b["body"].to_pylist())
            yield pa.RecordBatch.from_arrays([*[b[c] for c in names], pa.array(np.diff(ends)), _binary(ids.astype("<u4").view(np.uint8), 4 * ends)],
                                             names=[*names, "n_tokens", "ids"])

    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    return rows.mapInArrow(run, f"{kinds}, n_tokens bigint, ids binary").withColumnsRenamed(dict(zip(names, keep, strict=True)))


def decoded(rows: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the bytes that their ``ids`` stand for; the bytes of whole texts are UTF-8."""
    names = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path, pattern)
        for b in X.steps(batches, ids, STEP):
            packed = pc.fill_null(b[ids].cast(pa.large_binary()), b"")
            size = np.asarray(pc.binary_length(packed)) // 4
            ends = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
            data, at = code.decode(np.frombuffer(b"".join(packed.to_pylist()), "<u4"))
            yield pa.RecordBatch.from_arrays([*[b[c] for c in names], _binary(data, at[ends])], names=[*names, out])

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the bytes they decode to."""
    back = decoded(encoded(docs, path, pattern), path, pattern)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

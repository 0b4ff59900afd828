"""Words, lines and hashes of many texts at once: array kernels over Arrow batches, used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one call of a kernel holds; a longer text is taken alone and whole.
STEP = 1 << 21

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_random = np.random.default_rng(20240607)
BYTE_KEY = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE_KEY = _random.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the result depends on every bit of ``x``."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def steps(batches: Iterator[pa.RecordBatch], column: str, step: int = STEP) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of rows with at most ``step`` bytes of text, or one row."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0))
        total, begin = np.cumsum(sizes, dtype=np.int64), 0
        while begin < batch.num_rows:
            done = total[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(total, done + step, "right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the n + 1 places where they begin and end. Null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the two-byte Latin letters À to Þ; lengths stay."""
    out = LOWER[data]
    second = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    out[second] += 32
    return out


@dataclass
class Words:
    """Words of a run of texts. ``first[d]`` is the first word of text ``d``; ``first[d + 1]`` ends it."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def spans(keep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of kept bytes inside each text: start, end, text number, first run of each text."""
    before, after = np.zeros(len(keep), bool), np.zeros(len(keep), bool)
    before[1:], after[:-1] = keep[:-1], keep[1:]
    inner = offsets[(offsets > 0) & (offsets < len(keep))]
    before[inner], after[inner - 1] = False, False
    start, end = np.flatnonzero(keep & ~before), np.flatnonzero(keep & ~after) + 1
    first = np.searchsorted(start, offsets)
    return start, end, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first


def span_hashes(data: np.ndarray, keep: np.ndarray, start: np.ndarray, end: np.ndarray, head: int = 0) -> np.ndarray:
    """64-bit hashes of runs of kept bytes; with ``head``, of the first ``head`` bytes of each run."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    begin = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(begin, size)
    part = BYTE_KEY[data[keep]] * PLACE_KEY[place & 4095]
    if size.max() > 4096:
        part *= (place >> 12).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    if head:
        part[place >= head] = 0
        size = np.minimum(size, head)
    return mix(np.add.reduceat(part, begin) ^ size.astype(np.uint64))


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, Words]:
    """Bytes, text offsets and words of texts; a word is a maximal run without space, tab, LF, VT, FF and CR."""
    data, offsets = raw(texts)
    keep = ~SPACE[data]
    start, end, doc, first = spans(keep, offsets)
    return data, offsets, Words(start, end, doc, first, span_hashes(data, keep, start, end))


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """As ``words`` for lower-cased runs of letters (all bytes above ASCII count as letters); also the mask of letters."""
    data, offsets = raw(texts)
    data = lowered(data)
    keep = LETTER[data]
    start, end, doc, first = spans(keep, offsets)
    return data, offsets, keep, Words(start, end, doc, first, span_hashes(data, keep, start, end))


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words: first word, text number, hash.

    A text of fewer words has one window with all its words; a text without words has none.
    """
    n, total = len(w.hash), np.diff(w.first)
    left = np.repeat(w.first[1:], total) - np.arange(n)  # words from here to the end of the text
    place = np.arange(n) - np.repeat(w.first[:-1], total)
    at = np.flatnonzero((left >= size) | ((place == 0) & (left < size)))
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        inside = left[at] > k
        out[inside] += w.hash[at[inside] + k] * PLACE_KEY[k]
    return at, w.doc[at], mix(out ^ np.minimum(left[at], size).astype(np.uint64))


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row whether its (doc, key) occurs twice or more, and whether an earlier row has it."""
    n = len(key)
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool)
    joint = mix(key ^ mix(doc.astype(np.uint64)))
    order = np.argsort(joint, kind="stable")
    same = np.concatenate(([False], joint[order[1:]] == joint[order[:-1]]))
    again, twice = np.zeros(n, bool), np.zeros(n, bool)
    again[order] = same
    twice[order] = same | np.concatenate((same[1:], [False]))
    return twice, again

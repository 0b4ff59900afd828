"""Benchmark decontamination by latent semantic retrieval.

Texts are sequences of lower-cased words of letters, whose hashes fall into ``BUCKETS`` term buckets. Passages are runs of
``PASSAGE`` words. Document frequencies of all buckets over all passages give TF-IDF weights. The latent space is a distributed
randomised singular value decomposition of all passages, over the terms that the benchmark uses: with A the passages' rows
and W a random matrix, one pass sums A'(A W), and the Nystroem form of A'A gives the leading right singular vectors.

Windows of every document (two sizes, so that short items fill a window too) are projected and compared with the benchmark's
own windows by cosine; both sizes share the sums of short runs of words. A candidate whose stretch of the document has fewer places with
words of the item than a common subsequence needs is dropped, which loses nothing. The others are aligned, all of a run of texts at once: the longest common subsequence of the item and the stretch of the
document where the item would lie, and that of the item's answer (its last sentence). A document holds an item if 80 % of the item's
words are there in order, or 50 % with 60 % of the answer's (a paraphrase).

The benchmark is read in blocks of bounded size, each sent to the tasks; all else is scanned and summed by Spark. Null or
empty texts hold nothing; null or wordless items match nothing; repeated rows are searched one by one; repeated items each match.
Empty tables give empty results. Very long texts are searched whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treelab.llm import text as X
from treelab.llm.shared import settle

BUCKETS = 1 << 16
PASSAGE = 32
#: Window sizes and strides.
WINDOWS = ((12, 4), (32, 8))
RANK, OVERSAMPLING = 128, 16
MIN_COSINE = 0.5
MIN_COMMON, MIN_PARAPHRASE, MIN_ANSWER = 0.8, 0.5, 0.6
#: Bytes of benchmark text that are sent to the tasks at a time.
BLOCK_BYTES = 8 << 20
#: Candidates that are aligned at a time (and words of a batch of passages between cuts), passages whose rows are summed at a time, and runs of words whose windows are projected at a time.
CHUNK, PASSAGES, RUNS = 1 << 16, 1 << 12, 1 << 12
#: Candidates whose words are counted at a time.
CANDIDATES = 1 << 13
#: Largest table of words by items, and words of a step whose counts are added up for all items of that table.
MEMBER_BYTES, STEP_WORDS = 1 << 24, 4
#: Rows that are summed at a time, and steps in a slab of running totals, so that they stay in the processor's cache.
SUM_ROWS, SLAB = 1024, 64
#: Sums that are taken side by side, and most rows of a column in one of them.
SIDE, PIECE = 512, 16


def term_ids(docs: DataFrame, text: str = "text") -> DataFrame:
    """The term buckets of each text as 16-bit integers, settled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in X.steps(batches, "body"):
            w = X.terms(b["body"])[3]
            ids = (w.hash >> np.uint64(48)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([pa.array([ids[w.first[i] : w.first[i + 1]].tobytes() for i in range(b.num_rows)], pa.binary())], names=["ids"])

    return settle(docs.select(F.col(text).alias("body")).mapInArrow(run, "ids binary"), "term-ids")


def _passages(batches: Iterator[pa.RecordBatch], step: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of ids and the passage number of each."""
    for b in X.steps(batches, "ids", 2 * step):
        sizes = np.asarray(pa.compute.binary_length(b["ids"])).astype(np.int64) // 2
        ids = np.frombuffer(b"".join(b["ids"].to_pylist()), np.uint16)
        if len(ids):
            place = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield ids, np.cumsum(place % PASSAGE == 0) - 1


def inverse_frequencies(ids: DataFrame) -> np.ndarray:
    """log((1 + passages) / (1 + passages with the bucket)) for every bucket, counted over all passages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, passages = np.zeros(BUCKETS, np.int64), 0
        for term, passage in _passages(batches):
            pairs = np.sort(passage * BUCKETS + term)
            once = pairs[np.concatenate(([True], pairs[1:] != pairs[:-1]))]
            counts += np.bincount(once % BUCKETS, minlength=BUCKETS)
            passages += int(passage[-1]) + 1
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(counts[used], passages))], names=["bucket", "n"])

    sums = ids.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = np.asarray(sums["bucket"]), np.asarray(sums["n"])
    total = int(n[bucket == -1].sum())
    counts = np.zeros(BUCKETS)
    counts[bucket[bucket >= 0]] = n[bucket >= 0]
    return np.log((1 + total) / (1 + counts)).astype(np.float32)


def _segment_sums(table: np.ndarray, index: np.ndarray, value: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Sums of table[index] * value from each head to the next, in order."""
    out, ends, at = np.empty((len(head), table.shape[1]), np.float32), np.append(head, len(index)), 0
    while at < len(head):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + SUM_ROWS, "right")) - 1)
        part = table.take(index[ends[at] : ends[stop]], axis=0)
        part *= value[ends[at] : ends[stop], None]
        np.add.reduceat(part, head[at:stop] - ends[at], axis=0, out=out[at:stop])
        at = stop
    return out


def _piece_sums(table: np.ndarray, index: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of table[index] over consecutive pieces of ``size`` (below 2^16) entries: pieces of like size are added up side by side."""
    order = np.argsort(size.astype(np.uint16), kind="stable")[::-1]
    begin, size, out = (np.cumsum(size) - size)[order], size[order], np.zeros((len(size), table.shape[1]), table.dtype)
    for i in range(0, len(order), SIDE):
        at, total = begin[i : i + SIDE], np.zeros((min(SIDE, len(order) - i), table.shape[1]), table.dtype)
        for j, n in enumerate(np.searchsorted(-size[i : i + SIDE], -np.arange(size[i])).tolist()):  # the first n have an entry j
            total[:n] += table.take(index[at[:n] + j], axis=0)
        out[order[i : i + SIDE]] = total
    return out


def _running_totals(counts: np.ndarray) -> np.ndarray:
    """Totals of the rows before each row, and of all rows, modulo 2^16: slabs of rows are added up side by side."""
    slabs = max(1, -(-len(counts) // SLAB))
    padded = np.zeros((slabs * SLAB, counts.shape[1]), counts.dtype)
    padded[: len(counts)] = counts
    padded, total = padded.reshape(slabs, SLAB, -1), np.zeros((slabs * SLAB + 1, counts.shape[1]), np.uint16)
    inner = total[1:].reshape(slabs, SLAB, -1)
    inner[:, 0] = padded[:, 0]
    for k in range(1, SLAB):
        np.add(inner[:, k - 1], padded[:, k], out=inner[:, k])
    inner[1:] += np.cumsum(inner[:-1, -1], axis=0, dtype=np.uint16)[:, None]
    return total


def latent_space(ids: DataFrame, idf: np.ndarray, columns: np.ndarray, rank: int = RANK, oversampling: int = OVERSAMPLING) -> np.ndarray:
    """Leading right singular vectors (one row per entry of ``columns``, the sorted buckets) of the matrix of all passages."""
    width = min(rank + oversampling, len(columns))
    if not width:
        return np.zeros((0, 0), np.float32)
    omega = np.random.default_rng(5).standard_normal((len(columns), width)).astype(np.float32)
    weighted = omega * idf[columns][:, None]
    column_of = np.full(BUCKETS, -1, np.int32)
    column_of[columns] = np.arange(len(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(columns), width), np.float32)
        for term, passage in _passages(batches):
            energy = np.maximum(np.bincount(passage, weights=idf[term].astype(np.float64) ** 2), 1e-12).astype(np.float32)
            column = column_of[term]
            known = np.flatnonzero(column >= 0)
            column, own = column[known], passage[known]
            # a passage is cut in two at every ``CHUNK`` words; its parts then count as two rows
            head = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])) | (np.arange(len(own)) % CHUNK == 0)) if len(own) else known
            size, energy = np.diff(np.append(head, len(own))), energy[own[head]]
            for begin in range(0, len(size), PASSAGES):
                n = size[begin : begin + PASSAGES]
                c = column[head[begin] : head[begin] + int(n.sum())]
                rows = _piece_sums(weighted, c, n)
                rows /= energy[begin : begin + PASSAGES, None]  # a row of A W times the length that the passage's entries are divided by
                order = np.argsort(c.astype(np.uint16), kind="stable")
                per_column = np.bincount(c, minlength=len(columns))
                pieces = -(-per_column // PIECE)
                of_piece = np.repeat(np.arange(len(columns)), pieces)
                place = np.arange(len(of_piece)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                sums = _piece_sums(rows, np.repeat(np.arange(len(n)), n)[order], np.minimum(per_column[of_piece] - place * PIECE, PIECE))
                cut = np.flatnonzero(place == 0)
                out[of_piece[cut]] += _segment_sums(sums, np.arange(len(sums)), idf[columns[of_piece]], cut)
        used = np.flatnonzero(out.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.FixedSizeListArray.from_arrays(pa.array(out[used].ravel()), width).cast(pa.list_(pa.float32()))],
                                         names=["col", "row"])

    sums = ids.mapInArrow(run, "col int, row array<float>").groupBy("col") \
        .agg(F.array(*[F.sum(F.col("row")[j]) for j in range(width)]).alias("row")).toArrow()
    image = np.zeros((len(columns), width))
    if sums.num_rows:
        image[np.asarray(sums["col"])] = np.asarray(sums["row"].combine_chunks().values).reshape(-1, width)
    core = omega.T.astype(np.float64) @ image
    value, vector = np.linalg.eigh((core + core.T) / 2)
    keep = value > max(value.max(), 0) * 1e-9
    if not keep.any():
        return np.zeros((len(columns), 0), np.float32)
    basis, _, _ = np.linalg.svd(image @ (vector[:, keep] / np.sqrt(value[keep])), full_matrices=False)
    return np.ascontiguousarray(basis[:, :rank], np.float32)


def common_length(item: dict[int, int], stretch: list[int]) -> int:
    """Length of the longest common subsequence, by bit vectors: ``item`` maps a word to the bits of its places."""
    places = 0
    for bits in item.values():
        places |= bits
    row = places
    for word in stretch:
        met = row & item.get(word, 0)
        row = (row + met) | (row - met)
    return (places & ~row).bit_count()


def places_of(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, word in enumerate(words):
        out[word] = out.get(word, 0) | 1 << i
    return out


def pair_place(item: np.ndarray, word: np.ndarray, size: int) -> np.ndarray:
    """Where a pair of item and word stands in a hashed set of ``size`` (a power of two) places."""
    return (item * 0x9E3779B1 + word * 0x85EBCA6B >> 7) & (size - 1)


@dataclass
class Items:
    """A block of the benchmark: ids, words, answers; and for each window size the normalised latent vectors of item windows."""

    ids: list
    size: np.ndarray
    words: list[dict[int, int]]
    answers: list[dict[int, int]]
    answer_size: np.ndarray
    vectors: list[np.ndarray]
    owner: list[np.ndarray]
    offset: list[np.ndarray]
    #: All words of the block in order, and by hash of (item, number of a word): 1 for words of the item, 2 for those of its answer.
    #: Where hashes meet the larger value stands, so no word of an item is ever missed.
    vocabulary: np.ndarray
    pairs: np.ndarray
    #: By bucket, the number of its first word, and whether it has more.
    first: np.ndarray
    crowded: np.ndarray
    #: By number of a word (the last row for foreign words) and item, whether the item has the word; None if that is a large table.
    member: np.ndarray | None
    #: As ``member`` for items of up to 64 words: where the masks of item and word stand, the last one if it has none.
    entry: np.ndarray | None
    #: Of items of up to 64 words: item * len(vocabulary) + word in order, the word's places in the item and its answer as bits (and none at the
    #: end); by item, all places.
    keys: np.ndarray
    masks: np.ndarray
    places: np.ndarray

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word in the block's vocabulary, or -1."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        bucket = (hashes >> np.uint64(48)).astype(np.uint16)
        at = self.first[bucket]
        same = self.vocabulary[at] == hashes
        other = np.flatnonzero(self.crowded[bucket] & ~same)
        at[other] = np.minimum(np.searchsorted(self.vocabulary, hashes[other]), len(self.vocabulary) - 1)
        same[other] = self.vocabulary[at[other]] == hashes[other]
        return np.where(same, at, -1)

    def most_met(self, item: np.ndarray, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """At least the number of places of word[low:high] with words of the item: counts of whole steps of words, added up once for all items."""
        begin = int(low.min())
        part = word[begin : int(high.max())]
        part = np.concatenate((part, np.full(-len(part) % STEP_WORDS, -1, part.dtype)))
        counts = self.member.take(part[::STEP_WORDS], axis=0, mode="wrap")  # -1 is the last row
        for j in range(1, STEP_WORDS):
            counts += self.member.take(part[j::STEP_WORDS], axis=0, mode="wrap")
        total = _running_totals(counts)  # differences of stretches of less than 2^16 words are right modulo 2^16
        return total[(high - begin + STEP_WORDS - 1) // STEP_WORDS, item] - total[(low - begin) // STEP_WORDS, item]

    def may_hold(self, item: np.ndarray, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """False only where word[low:high] has fewer places with words of the item, or of its answer, than the rule asks to be in order.

        Candidates that the bound of ``most_met`` leaves are looked at word by word only if their items are too long to be aligned all at once.
        """
        out = np.zeros(len(item), bool)
        if not len(item):
            return out
        left = np.arange(len(item))
        if self.member is not None and (high - low).max() + 2 * STEP_WORDS < 1 << 16:
            left = np.flatnonzero(self.most_met(item, word, low, high) >= (MIN_PARAPHRASE * self.size)[item])
            short = self.size[item[left]] <= 64
            out[left[short]] = True
            left = left[~short]
        for i in range(0, len(left), CANDIDATES):
            c = left[i : i + CANDIDATES]
            d, a, z = item[c], low[c], high[c]
            met, of_answer = np.zeros(len(d), np.int32), np.zeros(len(d), np.int32)
            for j in range(int((z - a).max())):
                w = word[np.minimum(a + j, len(word) - 1)]
                kind = self.pairs[pair_place(d, w, len(self.pairs))]
                kind[(a + j >= z) | (w < 0)] = 0
                met += kind > 0
                of_answer += kind > 1
            out[c] = (met >= MIN_COMMON * self.size[d]) | ((met >= MIN_PARAPHRASE * self.size[d]) & (of_answer >= MIN_ANSWER * self.answer_size[d]))
        return out

    def common(self, item: np.ndarray, hashes: np.ndarray, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths of the longest common subsequences of each item, and of its answer, with hashes[low:high]: items of up to 64 words
        all at once, by ``common_length`` on machine words, longer ones one by one."""
        out = np.zeros((2, len(item)), np.int64)
        fits = self.size[item] <= 64
        for c in np.flatnonzero(~fits):
            stretch = hashes[low[c] : high[c]].tolist()
            out[:, c] = common_length(self.words[item[c]], stretch), common_length(self.answers[item[c]], stretch)
        for i in range(0, len(item), CHUNK):
            c = np.flatnonzero(fits[i : i + CHUNK]) + i
            if not len(c):
                continue
            d, a, z = item[c], low[c], high[c]
            every = self.places[:, d]
            row = every.copy()
            for j in range(int((z - a).max())):
                w = np.where(a + j < z, word[np.minimum(a + j, len(word) - 1)], -1)
                if self.entry is not None:
                    met = row & self.masks.take(self.entry[w, d], axis=1)
                else:
                    key = d * len(self.vocabulary) + w
                    at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                    met = row & np.where((w >= 0) & (self.keys[at] == key), self.masks[:, at], np.uint64(0))
                row = (row + met) | (row - met)
            out[:, c] = np.bitwise_count(every & ~row)
        return out[0], out[1]


def answer_words(body: str) -> str:
    """The last sentence of an item, or the last third of an item of one sentence."""
    parts = [p for p in body.replace("!", ".").replace("?", ".").replace("\n", ".").split(".") if p.strip()]
    if len(parts) > 1:
        return parts[-1]
    words = body.split()
    return " ".join(words[-max(1, len(words) // 3) :])


def index_items(ids: list, texts: list[str], idf: np.ndarray, columns: np.ndarray, basis: np.ndarray) -> Items:
    """Windows of the items in the latent space; items of up to 32 words have windows of 12, longer ones of 32."""
    w = X.terms(pa.array(texts, pa.string()))[3]
    a = X.terms(pa.array([answer_words(t) for t in texts], pa.string()))[3]
    bucket = (w.hash >> np.uint64(48)).astype(np.int64)
    size = np.diff(w.first)
    listed = lambda x, d: x.hash[x.first[d] : x.first[d + 1]].tolist()
    vectors, owner, offset = [], [], []
    for k, (length, _) in enumerate(WINDOWS):
        rows, own, off = [], [], []
        for d in range(len(texts)):
            n = int(size[d])
            if not n or (n <= WINDOWS[-1][0]) != (k == 0):
                continue
            starts = sorted({*range(0, max(n - length, 0) + 1, max(length // 2, 1)), max(n - length, 0)})
            for s in starts:
                part = bucket[w.first[d] + s : w.first[d] + min(s + length, n)]
                v = (basis[np.searchsorted(columns, part)] * idf[part][:, None]).sum(axis=0)
                rows.append(v / max(float(np.linalg.norm(v)), 1e-9))
                own.append(d)
                off.append(s)
        vectors.append(np.array(rows, np.float32).reshape(len(rows), basis.shape[1]))
        owner.append(np.array(own, np.int64))
        offset.append(np.array(off, np.int64))
    vocabulary, number = np.unique(w.hash, return_inverse=True)
    pairs = np.zeros(1 << max(16, int(16 * len(number)).bit_length()), np.uint8)
    pairs[pair_place(w.doc, number, len(pairs))] = 1
    pairs[pair_place(a.doc, np.searchsorted(vocabulary, a.hash), len(pairs))] = 2
    words, answers = ([places_of(listed(x, d)) for d in range(len(texts))] for x in (w, a))
    first = np.searchsorted(vocabulary, np.arange(BUCKETS + 1, dtype=np.uint64)[:-1] << np.uint64(48))
    crowded = np.diff(np.append(first, len(vocabulary))) > 1
    short = np.flatnonzero(size <= 64)
    entries = sorted((int(d) * len(vocabulary) + int(np.searchsorted(vocabulary, np.uint64(h))), bits, answers[d].get(h, 0))
                     for d in short for h, bits in words[d].items())
    keys = np.array([e[0] for e in entries], np.int64)
    member = entry = None
    if (len(vocabulary) + 1) * len(texts) <= MEMBER_BYTES:
        member = np.zeros((len(vocabulary) + 1, len(texts)), np.uint8)
        member[number, w.doc] = 1
        entry = np.full(member.shape, len(keys), np.int32)
        entry[keys % max(len(vocabulary), 1), keys // max(len(vocabulary), 1)] = np.arange(len(keys))
    places = np.zeros((2, len(texts)), np.uint64)
    for d in short:
        places[:, d] = [(1 << int(n)) - 1 for n in (size[d], len(listed(a, d)))]
    return Items(ids, size, words, answers, np.diff(a.first), vectors, owner, offset, vocabulary, pairs, np.minimum(first, max(len(vocabulary) - 1, 0)), crowded,
                 member, entry, keys,
                 np.array([[e[1] for e in entries] + [0], [e[2] for e in entries] + [0]], np.uint64), places)


def search(texts: pa.Array, items: Items, idf: np.ndarray, columns: np.ndarray, basis: np.ndarray) -> list[tuple[int, int, float, float, float]]:
    """(text number, item number, cosine, share of the item, share of its answer) of every item that a text holds."""
    w = X.terms(texts)[3]
    kinds = [(k, length, stride) for k, (length, stride) in enumerate(WINDOWS) if len(items.vectors[k])]
    if not len(w.hash) or not kinds:
        return []
    column_of = np.full(BUCKETS, -1, np.int32)
    column_of[columns] = np.arange(len(columns))
    column = column_of[(w.hash >> np.uint64(48)).astype(np.uint16)]
    weighted = np.vstack((basis * idf[columns][:, None], np.zeros((1, basis.shape[1]), np.float32)))  # the last row is for foreign words
    word = items.numbers(w.hash)
    place = np.arange(len(w.hash)) - w.first[:-1][w.doc]
    left = w.first[1:][w.doc] - np.arange(len(w.hash))
    unit = math.gcd(*(stride for _, _, stride in kinds))
    cut = np.flatnonzero(place % unit == 0)  # windows are runs of whole strides, and those of whole units
    # vectors by eights, so that comparisons are looked through eight at a time
    vectors = {k: np.vstack((items.vectors[k], np.zeros((-len(items.vectors[k]) % 8, basis.shape[1]), np.float32))).T for k, _, _ in kinds}
    kept = []
    for i in range(0, len(cut), RUNS):
        head = cut[i : i + RUNS + max(length for _, length, _ in kinds) // unit - 1]
        runs = np.zeros((len(head) + 1, weighted.shape[1]), np.float32)  # the last row stands for runs beyond the end
        runs[:-1] = weighted.take(column[head], axis=0)
        for j in range(1, unit):
            runs[:-1] += weighted.take(np.where(left[head] > j, column[np.minimum(head + j, len(column) - 1)], -1), axis=0)
        near = []
        for k, length, stride in kinds:
            own, sums = np.flatnonzero(place[head] % stride == 0), runs
            if stride > unit:
                sums = np.zeros((len(own) + 1, weighted.shape[1]), np.float32)
                sums[:-1] = runs.take(own, axis=0)
                for j in range(1, stride // unit):
                    sums[:-1] += runs.take(np.where(left[head[own]] > j * unit, np.minimum(own + j, len(head)), -1), axis=0)
            at = np.flatnonzero((own < RUNS) & ((place[head[own]] == 0) | (left[head[own]] > length - stride)))
            b, latent = head[own[at]], sums.take(at, axis=0)
            for j in range(1, length // stride):
                latent += sums.take(np.where(left[b] > j * stride, at + j, -1), axis=0)
            latent /= np.maximum(np.sqrt(np.einsum("ij,ij->i", latent, latent)), 1e-9)[:, None]
            cosine = latent @ vectors[k]
            hits = (cosine >= MIN_COSINE).reshape(-1, 8)
            some = np.flatnonzero(hits.view(np.uint64).ravel())
            eight, bit = np.nonzero(hits.take(some, axis=0))
            hit = some[eight] * 8 + bit
            row, query = np.divmod(hit, cosine.shape[1])
            item, slack = items.owner[k], stride + items.size[items.owner[k]] // 8
            start, begins, ends = b[row], (b - place[b])[row], (b + left[b])[row]
            near.append((item[query], np.maximum(begins, start - (items.offset[k] + slack)[query]),
                         np.minimum(ends, start + (items.size[item] + slack - items.offset[k])[query]), cosine.ravel()[hit]))
        item, low, high, cosine = (np.concatenate(x) for x in zip(*near, strict=True))
        may = np.flatnonzero(items.may_hold(item, word, low, high))
        kept.append((item[may], low[may], high[may], cosine[may]))
    item, low, high, cosine = (np.concatenate(x) for x in zip(*kept, strict=True))
    common, answer = (x / y for x, y in zip(items.common(item, w.hash, word, low, high),
                                            (items.size[item], np.maximum(items.answer_size[item], 1)), strict=True))
    holds = np.flatnonzero((common >= MIN_COMMON) | ((common >= MIN_PARAPHRASE) & (answer >= MIN_ANSWER)))
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    for doc, it, *rank in zip(w.doc[low[holds]].tolist(), item[holds].tolist(), common[holds].tolist(), answer[holds].tolist(), cosine[holds].tolist(), strict=True):
        found[doc, it] = max(found.get((doc, it), (0.0, 0.0, 0.0)), tuple(rank))
    return [(doc, item, c, share, answer) for (doc, item), (share, answer, c) in sorted(found.items())]


def blocks_of(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[tuple[list, list[str]]]:
    """The benchmark in blocks of at most ``BLOCK_BYTES`` (or one item), in order."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text")).where("text is not null").orderBy("id", "text").toLocalIterator():
        if texts and size + len(row["text"]) > BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row["id"])
        texts.append(row["text"])
        size += len(row["text"])
    if texts:
        yield ids, texts


@dataclass
class Space:
    idf: np.ndarray
    columns: np.ndarray
    basis: np.ndarray


def fit(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> Space:
    """Weights and latent space, from all passages of ``docs``; columns are the buckets that the benchmark uses."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in X.steps(batches, "body"):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(X.terms(b["body"])[3].hash >> np.uint64(48)).astype(np.int64))], names=["bucket"])

    used = benchmark.select(F.col(text).alias("body")).mapInArrow(run, "bucket bigint").distinct().toArrow()
    columns = np.sort(np.asarray(used["bucket"], dtype=np.int64))
    ids = term_ids(docs, text)
    idf = inverse_frequencies(ids)
    return Space(idf, columns, latent_space(ids, idf, columns))


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, cosine, item_share, answer_share: a row for every item that a document holds."""
    space = fit(docs, benchmark, text)
    kinds = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, item_id {benchmark.schema[item_id].dataType.simpleString()}"
    schema = f"{kinds}, cosine double, item_share double, answer_share double"
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body"))
    out = docs.sparkSession.createDataFrame([], schema)
    for ids, texts in blocks_of(benchmark, item_id, text):
        items = index_items(ids, texts, space.idf, space.columns, space.basis)

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for b in X.steps(batches, "body"):
                hit = search(b["body"], items, space.idf, space.columns, space.basis)
                if hit:
                    doc, item, cosine, share, answer = zip(*hit, strict=True)
                    yield pa.RecordBatch.from_arrays([b["doc_id"].take(pa.array(doc)), pa.array([items.ids[i] for i in item]), pa.array(cosine, pa.float64()),
                                                      pa.array(share, pa.float64()), pa.array(answer, pa.float64())],
                                                     names=["doc_id", "item_id", "cosine", "item_share", "answer_share"])

        out = out.unionByName(rows.mapInArrow(run, schema))
    return out


def without_benchmark(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item; rows pass through their tasks, nothing is shuffled."""
    space = fit(docs, benchmark, text)
    at, schema = docs.columns.index(text), docs.schema
    for ids, texts in blocks_of(benchmark, item_id, text):
        items = index_items(ids, texts, space.idf, space.columns, space.basis)

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
                for b in X.steps([named], f"c{at}"):
                    clean = np.ones(b.num_rows, bool)
                    clean[[h[0] for h in search(b[f"c{at}"], items, space.idf, space.columns, space.basis)]] = False
                    yield b.filter(pa.array(clean)).rename_columns(batch.schema.names)

        docs = docs.mapInArrow(run, schema)
    return docs

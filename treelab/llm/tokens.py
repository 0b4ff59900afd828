"""Token shards: whole texts as token ids, one wavelet matrix per shard, random access from one compressed file.

Documents are ordered by doc_id (null first), then text. Shards are ranges of that order with about ``shard_bytes`` of text; equal
doc_ids may be split over shards, since the text takes part in the order. Every document ends with ``end_id``.

File (little-endian): magic, n_tokens, n_docs, n_planes, block size, alphabet size, bytes of the doc_ids; the alphabet (sorted distinct
ids, 4 bytes each; codes are places in it), document ends, zeros per plane, the doc_ids (an Arrow stream); a directory of blocks (offset, bytes, ones before it); then the blocks, each
compressed by itself. Plane 0 holds the highest bits of the codes in text order; each next plane holds the next bits, stably
sorted by all bits before, zeros first. Access, counting and finding occurrences read two blocks a plane at most.

Null texts count as empty: their documents hold the end id alone. Repeated rows are documents of their own. An empty table gives
no shard and no rows. Very long texts are encoded whole.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window as W, functions as F

from treelab.llm.shared import arrow_rows, folder, qualified, settle

MAGIC = b"WVMX0001"
HEADER, ENTRY = "<8sQQIIIQ", "<QIQ"
#: Bits of a plane that are compressed together.
BLOCK_BITS = 1 << 18
SHARD_BYTES = 32 << 20
#: Bits between the counts of ones that a reader keeps for an unpacked block, and unpacked blocks that it keeps.
STEP_BITS = 512
CACHE_BLOCKS = 256
#: Entries of the cache of encoded parts that one worker keeps.
CACHE_PARTS = 900_000
#: Ids that are looked up in a table at a time (numpy widens them to eight bytes), and rows that a worker is sent at a time.
STEP_IDS, BATCH_ROWS = 1 << 18, 512

# --- tokenizer ---------------------------------------------------------------------------------------------------------


class Encoder:
    """Encodes whole texts with a tokenizer file; parts seen before come from a bounded cache.

    A tokenizer that drops white space and encodes the matches of a pattern one by one gives a text the ids of its parts one after
    another, so each part is encoded once. ``split_pattern`` tells whether that holds for a file; others encode text by text.
    Texts of Latin-1 characters are cut by that pattern at once; of others, words with further characters are parts of their own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        spec = json.loads(self.tokenizer.to_str())
        pieces = split_pattern(spec)
        self.pieces = re.compile(latin_pattern(pieces)) if pieces else None
        suffix = spec["model"].get("end_of_word_suffix")
        #: Whether an id ends a part.
        self.ends = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        self.parts: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes of ``dtype``."""
        if self.pieces is None:
            return [self._pack(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        if len(self.parts) > CACHE_PARTS:
            self.parts = {}
        cut = [self._cut(t) for t in texts]
        get = self.parts.get
        known = [list(map(get, parts)) for parts in cut]
        holes = [(parts, ids, at) for parts, ids in zip(cut, known, strict=True) if None in ids for at in _empty_places(ids)]
        self._learn({parts[at] for parts, _, at in holes})
        for parts, ids, at in holes:
            ids[at] = self.parts[parts[at]]
        return [b"".join(ids) for ids in known]

    def _cut(self, text: str) -> list[str]:
        if self._plain(text):
            return self.pieces.findall(text.lower())
        out: list[str] = []
        for word in text.replace("\n", " ").split(" "):
            if self._plain(word):
                out += self.pieces.findall(word.lower())
            else:
                out.append("\0" + word)
        return out

    def _plain(self, text: str) -> bool:
        """Whether normalisation only lower-cases the text, letter by letter, and no special token can be in it."""
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return False
        return "<|" not in text and "\0" not in text

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _learn(self, new: set[str]) -> None:
        """One call for many parts: a space between two makes each a part of its own."""
        hard = [p for p in new if p[0] == "\0"]
        for p, e in zip(hard, self.tokenizer.encode_batch([p[1:] for p in hard], add_special_tokens=False) if hard else [], strict=True):
            self.parts[p] = self._pack(e.ids)
        easy = [p for p in new if p[0] != "\0"]
        for i in range(0, len(easy), 2000):
            group = easy[i : i + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, self.dtype)
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) == len(group) and ends[-1] == len(ids):
                data, size, begin = ids.tobytes(), self.dtype.itemsize, 0
                for p, end in zip(group, ends, strict=True):
                    self.parts[p] = data[begin * size : end * size]
                    begin = end
            else:
                for p, e in zip(group, self.tokenizer.encode_batch(group, add_special_tokens=False), strict=True):
                    self.parts[p] = self._pack(e.ids)


def _empty_places(ids: list[bytes | None]) -> Iterator[int]:
    at = -1
    for _ in range(ids.count(None)):
        at = ids.index(None, at + 1)
        yield at


def latin_pattern(pattern: str) -> str:
    """The pattern with its classes of letters, numbers and white space spelled out for the characters up to U+00FF."""
    chars = [chr(i) for i in range(256)]
    white = "\t\n\x0b\x0c\r \x85\xa0"
    classes = {r"\p{L}": "".join(c for c in chars if unicodedata.category(c)[0] == "L"),
               r"\p{N}": "".join(c for c in chars if unicodedata.category(c)[0] == "N"), r"\s": white}
    for name, members in classes.items():
        pattern = pattern.replace(name, re.escape(members))
    return pattern


def public_path(name: str) -> str:
    """Path of a file of the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern(spec: dict) -> str | None:
    """The pattern whose matches are the words of a tokenizer, if it drops white space, lower-cases and has no context across words."""
    kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if kinds != ["NFC", "Replace", "Lowercase"] or not steps or steps[0].get("type") != "Split" or spec.get("post_processor"):
        return None
    first = steps[0]
    drops = first.get("behavior") == "Removed" and first.get("invert") and "\\s" in first["pattern"].get("Regex", "")
    level = len(steps) == 2 and steps[1].get("type") == "ByteLevel" and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space")
    added = all(not t["single_word"] and not t["lstrip"] and not t["rstrip"] and t["content"].startswith("<|") for t in spec.get("added_tokens", []))
    return first["pattern"]["Regex"] if drops and level and added else None


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)


# --- wavelet matrix ----------------------------------------------------------------------------------------------------


def _looked_up(table: np.ndarray, index: np.ndarray) -> np.ndarray:
    """table[index], in steps."""
    out = np.empty(len(index), table.dtype)
    for i in range(0, len(index), STEP_IDS):
        out[i : i + STEP_IDS] = table[index[i : i + STEP_IDS]]
    return out


def build(ids: np.ndarray, ends: np.ndarray, doc_ids: pa.Array) -> bytes:
    """File of a shard: ``ids`` of all its documents, ``ends`` and ``doc_ids`` of the documents in it."""
    names = pa.BufferOutputStream()
    with pa.ipc.new_stream(names, pa.schema([("doc_id", doc_ids.type)])) as out:
        out.write_batch(pa.RecordBatch.from_arrays([doc_ids], names=["doc_id"]))
    names = zstandard.ZstdCompressor(level=1).compress(names.getvalue())
    seen = np.zeros(int(ids.max()) + 1 if len(ids) else 1, bool)
    for i in range(0, len(ids), STEP_IDS):
        seen[ids[i : i + STEP_IDS]] = True
    alphabet = np.flatnonzero(seen).astype("<u4")
    place = (np.cumsum(seen) - 1).astype(np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
    codes = _looked_up(place, ids)
    planes = max(1, int(max(len(alphabet) - 1, 1)).bit_length())
    pack = zstandard.ZstdCompressor(level=1)
    zeros, directory, blocks = [], [], []
    after, bit = np.empty_like(codes), np.empty(len(codes), bool)
    for plane in range(planes):
        mask, ones = codes.dtype.type(1 << (planes - 1 - plane)), 0
        for begin in range(0, max(len(codes), 1), BLOCK_BITS):
            part = bit[begin : begin + BLOCK_BITS]
            np.not_equal(codes[begin : begin + BLOCK_BITS] & mask, 0, out=part)
            data = pack.compress(np.packbits(part, bitorder="little").tobytes())
            directory.append((len(data), ones))
            blocks.append(data)
            ones += int(np.count_nonzero(part))
        zeros.append(len(codes) - ones)
        zero, one = 0, zeros[-1]
        for begin in range(0, len(codes), BLOCK_BITS):
            part, code = bit[begin : begin + BLOCK_BITS], codes[begin : begin + BLOCK_BITS]
            n = int(np.count_nonzero(part))
            np.compress(part, code, out=after[one : one + n])
            np.compress(np.logical_not(part, out=part), code, out=after[zero : zero + len(code) - n])
            zero, one = zero + len(code) - n, one + n
        codes, after = after, codes
    lead = struct.pack(HEADER, MAGIC, len(ids), len(ends), planes, BLOCK_BITS, len(alphabet), len(names))
    lead += alphabet.tobytes() + ends.astype("<u8").tobytes() + np.array(zeros, "<u8").tobytes() + names
    at = len(lead) + struct.calcsize(ENTRY) * len(directory)
    entries = []
    for size, ones in directory:
        entries.append(struct.pack(ENTRY, at, size, ones))
        at += size
    return lead + b"".join(entries) + b"".join(blocks)


class WaveletMatrix:
    """Reads a shard from ``read(offset, size)``; blocks are fetched and unpacked when they are needed."""

    def __init__(self, read):
        self.read = read
        magic, self.n, self.n_docs, self.planes, self.block, n_alphabet, n_names = struct.unpack(HEADER, read(0, struct.calcsize(HEADER)))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        sizes = [4 * n_alphabet, 8 * self.n_docs, 8 * self.planes, n_names]
        self.per_plane = max(1, -(-self.n // self.block))
        rest = read(struct.calcsize(HEADER), sum(sizes) + struct.calcsize(ENTRY) * self.planes * self.per_plane)
        self.alphabet = np.frombuffer(rest, "<u4", n_alphabet)
        self.ends = np.frombuffer(rest, "<u8", self.n_docs, sizes[0]).astype(np.int64)
        self.zeros = np.frombuffer(rest, "<u8", self.planes, sizes[0] + sizes[1]).astype(np.int64)
        at = sum(sizes)
        self.entries = [struct.unpack_from(ENTRY, rest, at + struct.calcsize(ENTRY) * i) for i in range(self.planes * self.per_plane)]
        self.unpack = zstandard.ZstdDecompressor()
        names = self.unpack.decompress(rest[at - n_names : at])
        self.doc_ids = pa.ipc.open_stream(names).read_all()["doc_id"].combine_chunks()
        #: Unpacked blocks, the one used last at the end, each with the ones before every ``STEP_BITS`` of it.
        self.cached: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def _unpacked(self, plane: int, block: int) -> np.ndarray:
        offset, size, _ = self.entries[plane * self.per_plane + block]
        raw = np.frombuffer(self.unpack.decompress(self.read(offset, size), max_output_size=self.block), np.uint8)
        return np.unpackbits(raw, count=min(self.block, self.n - block * self.block), bitorder="little")

    def _bits(self, plane: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        held = self.cached.pop((plane, block), None)
        if held is None:
            bits = self._unpacked(plane, block)
            steps = np.add.reduceat(bits, np.arange(0, len(bits), STEP_BITS), dtype=np.int64) if len(bits) else np.zeros(0, np.int64)
            held = bits, np.concatenate(([0], np.cumsum(steps)))
            while len(self.cached) >= CACHE_BLOCKS:
                del self.cached[next(iter(self.cached))]
        self.cached[plane, block] = held
        return held

    def _rank1(self, plane: int, i: int) -> int:
        """Ones before place ``i``."""
        if i >= self.n:
            return self.n - int(self.zeros[plane])
        block, inside = divmod(i, self.block)
        bits, before = self._bits(plane, block)
        step = inside // STEP_BITS
        return self.entries[plane * self.per_plane + block][2] + int(before[step]) + int(np.count_nonzero(bits[step * STEP_BITS : inside]))

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) ``bit`` of a plane."""
        before = [e[2] if bit else j * self.block - e[2] for j, e in enumerate(self.entries[plane * self.per_plane : (plane + 1) * self.per_plane])]
        block = int(np.searchsorted(before, k, "right")) - 1
        bits, ones = self._bits(plane, block)
        inside = ones if bit else np.minimum(np.arange(len(ones)) * STEP_BITS, len(bits)) - ones
        step = int(np.searchsorted(inside, k - before[block], "right")) - 1
        part = bits[step * STEP_BITS : (step + 1) * STEP_BITS]
        return block * self.block + step * STEP_BITS + int(np.flatnonzero(part == bit)[k - before[block] - int(inside[step])])

    def access(self, i: int) -> int:
        """Token at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for plane in range(self.planes):
            bit = int(self._bits(plane, i // self.block)[0][i % self.block])
            ones = self._rank1(plane, i)
            i = int(self.zeros[plane]) + ones if bit else i - ones
            code = code << 1 | bit
        return int(self.alphabet[code])

    def _code(self, token: int) -> int:
        k = int(np.searchsorted(self.alphabet, token))
        return k if k < len(self.alphabet) and self.alphabet[k] == token else -1

    def _range(self, code: int, begin: int, end: int) -> tuple[int, int]:
        for plane in range(self.planes):
            a, b = self._rank1(plane, begin), self._rank1(plane, end)
            if code >> (self.planes - 1 - plane) & 1:
                begin, end = int(self.zeros[plane]) + a, int(self.zeros[plane]) + b
            else:
                begin, end = begin - a, end - b
        return begin, end

    def rank(self, token: int, end: int, begin: int = 0) -> int:
        """How often ``token`` stands in places begin .. end - 1."""
        code = self._code(token)
        if code < 0:
            return 0
        a, b = self._range(code, max(begin, 0), min(end, self.n))
        return max(b - a, 0)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of ``token``, or -1."""
        code = self._code(token)
        if code < 0 or not 0 <= k < self.rank(token, self.n):
            return -1
        at = self._range(code, 0, self.n)[0] + k
        for plane in reversed(range(self.planes)):
            bit = code >> (self.planes - 1 - plane) & 1
            at = self._select(plane, bit, at - int(self.zeros[plane]) if bit else at)
        return at

    def all_ids(self) -> np.ndarray:
        """All tokens in order; planes are merged from the last to the first, block by block."""
        codes = np.zeros(self.n, np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32)
        out = np.empty_like(codes)
        for plane in reversed(range(self.planes)):
            zeros = int(self.zeros[plane])
            codes[zeros:] |= codes.dtype.type(1 << (self.planes - 1 - plane))
            for block in range(self.per_plane if self.n else 0):
                bit, begin = self._unpacked(plane, block).view(bool), block * self.block
                one = zeros + self.entries[plane * self.per_plane + block][2]
                zero, part = begin + zeros - one, out[begin : begin + len(bit)]
                ones = np.flatnonzero(bit)
                part[ones] = codes[one : one + len(ones)]
                part[np.flatnonzero(np.logical_not(bit, out=bit))] = codes[zero : zero + len(bit) - len(ones)]
            codes, out = out, codes
        del out
        return _looked_up(self.alphabet, codes)

    def document(self, d: int) -> list[int]:
        """Tokens of document ``d`` of the shard, one by one."""
        return [self.access(i) for i in range(int(self.ends[d - 1]) if d else 0, int(self.ends[d]))]


# --- files -------------------------------------------------------------------------------------------------------------


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and name of a path; one without scheme is local, so ``write_shards`` qualifies its folder first."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]:", "s3:", path)))


def write_file(path: str, data: bytes) -> None:
    """Whole or not at all: a task that is run again, or twice, replaces the file with the same bytes."""
    store, name = _place(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    temporary = f"{name}.{np.random.default_rng().integers(1 << 62)}.part"
    with store.open_output_stream(temporary) as out:
        out.write(data)
    store.move(temporary, name)


def open_shard(path: str) -> WaveletMatrix:
    """A shard for random access."""
    store, name = _place(path)
    source = store.open_input_file(name)
    return WaveletMatrix(lambda at, size: source.read_at(size, at))


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the shards and returns their settled list: shard, path, n_docs, n_tokens, n_bytes.

    A ``path`` without scheme lies where Spark's own readers would look for it, not on the disk of the task.
    """
    path = qualified(docs.sparkSession, path)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("body"))
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    ordered = rows.withColumn("tie", F.xxhash64("body")).repartitionByRange(shards, "doc_id", "tie") \
        .sortWithinPartitions("doc_id", "tie", "body").drop("tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        code = encoder(tokenizer)
        end = np.array([end_id], code.dtype).tobytes()
        parts, ids, sizes = [], [], []
        for b in batches:
            for i in range(0, b.num_rows, 256):
                for data in code.encode(b["body"].slice(i, 256).to_pylist()):
                    parts.append(data + end)
                    sizes.append(len(parts[-1]) // code.dtype.itemsize)
            ids.append(b["doc_id"].take(pa.array(np.arange(b.num_rows))))  # a copy: the column itself would hold the texts of its batch
            b = None
        if not sizes:
            return
        number = TaskContext.get().partitionId()
        tokens = np.frombuffer(b"".join(parts), code.dtype)
        del parts
        data = build(tokens, np.cumsum(sizes), pa.concat_arrays(ids))
        name = f"{path}/shard-{number:07d}.wvm"
        write_file(name, data)
        yield pa.RecordBatch.from_pylist([{"shard": number, "path": name, "n_docs": len(sizes), "n_tokens": len(tokens), "n_bytes": len(data)}])

    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return settle(ordered.mapInArrow(run, "shard bigint, path string, n_docs bigint, n_tokens bigint, n_bytes bigint"), "shards")


def with_starts(shards: DataFrame) -> DataFrame:
    """Adds the number of tokens in all shards before; there is one row per shard, ordered by one task."""
    at = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(at), F.lit(0)))


def read_documents(shards: DataFrame, doc_id_type: str = "bigint") -> DataFrame:
    """Reads the files back: shard, doc_id, start (tokens of all documents before), n_tokens, ids_crc32."""
    files = with_starts(shards).select("shard", "path", "start").repartitionByRange(max(1, shards.count()), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            matrix = open_shard(row["path"])
            ids = matrix.all_ids()
            begins = np.concatenate(([0], matrix.ends[:-1])).astype(np.int64)
            view = memoryview(ids).cast("B")
            sums = [zlib.crc32(view[4 * x : 4 * y]) for x, y in zip(begins.tolist(), matrix.ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(begins), row["shard"], np.int64)), matrix.doc_ids, pa.array(begins + row["start"]),
                 pa.array(matrix.ends - begins), pa.array(sums, pa.int64())],
                names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, f"shard bigint, doc_id {doc_id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_table(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes ``docs`` into shards below the shared folder and reads them back."""
    shards = write_shards(docs, folder(docs.sparkSession, "token-shards"), tokenizer, end_id, doc_id, text)
    return read_documents(shards, docs.schema[doc_id].dataType.simpleString())

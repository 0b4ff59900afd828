"""Near duplicates by BagMinHash: signatures of shingle multisets, banding, exact verification, classes.

A document is the multiset of its five-word shingles (a text of one to four words: one shingle). Two documents are linked if the
weighted Jaccard similarity of their multisets is at least 0.8; classes are the connected components.

Signatures. Each shingle spans a Poisson process over time and over its weight axis, cut at integer weights and laid out in
dyadic shells [0,1), [1,2), [2,4), ...: a shingle of count c uses the shells below c whole and thins the last one at c, so a
process costs the logarithm of its weight, and two documents that share a shingle see the same points up to the smaller
count. Each point falls on a random component; a component keeps its first point, whose probability of being common to two
documents is their weighted Jaccard similarity. Points of a document are drawn in order of time until the latest first arrival.

Candidates. Documents that agree on a band meet in its bucket. Buckets of up to four have all their pairs verified. In a larger one
the hub, the member with most bucket mates, is compared with all members. What is still apart is compared inside tasks that hold two lots
of the bucket each, with their multisets: pairs of different parts that size and sketch allow are verified there, the closest first, and a
pair whose parts have met meanwhile is skipped. Only links leave a task, and of the open buckets that a pair shares only the first tests it.

Texts without words form one class. Null texts count as empty. Equal texts are one node, so copies cost one signature group.
Rows without doc_id take part; a class's id is its smallest doc_id (null if it has none). Repeated rows stay, in one class.
Empty tables give empty results. Very long texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from treelab.llm import text as X
from treelab.llm.shared import settle

SHINGLE = 5
#: Similarity as a fraction: at least 4 / 5.
SIMILAR = (4, 5)
BANDS, ROWS = 28, 5
SIZE = BANDS * ROWS
#: Members up to which a bucket has all its pairs compared at once.
SMALL = 4
#: Members in a lot of a larger bucket, of which a task compares two.
LOT = 4096
#: Share of equal sketch bytes below which a pair is not similar.
MIN_SKETCH = 0.55

#: Size of the filter that keeps texts which are no candidates from being looked at twice: 8 MB.
FILTER_BITS = 1 << 26

_STEP = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of each distinct shingle, in order of text number and hash."""
    _, _, w = X.words(texts)
    _, doc, key = X.windows(w, SHINGLE)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    return doc[begin], key[begin], np.diff(np.append(begin, len(key)))


def signatures(n: int, doc: np.ndarray, key: np.ndarray, count: np.ndarray, size: int = SIZE) -> np.ndarray:
    """BagMinHash signatures, n rows of ``size`` 32-bit values, from weighted elements (doc, key, count)."""
    item_doc, seed, low, width, limit = [doc], [key], [np.zeros(len(key))], [np.ones(len(key))], [count.astype(np.float64)]
    shell = 1
    while (reach := count > (1 << (shell - 1))).any():
        d, k = doc[reach], key[reach]
        base = float(1 << (shell - 1))
        item_doc.append(d)
        seed.append(X.mix(k ^ X.mix(np.full(1, shell, np.uint64))))
        low.append(np.full(len(d), base))
        width.append(np.full(len(d), base))
        limit.append(count[reach].astype(np.float64))
        shell += 1
    item_doc, seed, low, width, limit = (np.concatenate(x) for x in (item_doc, seed, low, width, limit))
    best = np.full(n * size, _EMPTY, np.uint64)
    time, step = np.zeros(len(seed)), 0
    while len(seed):
        events = int(np.clip(8192 // len(seed), 1, 128))
        state = X.mix(seed[:, None] + (np.arange(step + 1, step + events + 1, dtype=np.uint64) * _STEP)[None, :])
        step += events
        gaps = -np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width[:, None]
        at = time[:, None] + np.cumsum(gaps, axis=1)
        time = at[:, -1]
        point = X.mix(state)
        place = (point >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)
        level = low[:, None] + (point & np.uint64(0xFFFFFFFF)).astype(np.float64) * (width[:, None] * 2.0**-32)
        value = (at.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (X.mix(point) >> np.uint64(32))
        inside = level < limit[:, None]
        cell = item_doc[:, None] * size + place.astype(np.int64)
        np.minimum.at(best, cell[inside], value[inside])
        latest = best.reshape(n, size).max(axis=1)
        latest = np.where(latest == _EMPTY, np.inf, (latest >> np.uint64(32)).astype(np.uint32).view(np.float32).astype(np.float64))
        live = time <= latest[item_doc]
        item_doc, seed, low, width, limit, time = (x[live] for x in (item_doc, seed, low, width, limit, time))
    return (best & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(n, size)


def band_hashes(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit hash per row and band."""
    parts = sig.reshape(len(sig), bands, rows).astype(np.uint64) * X.PLACE_KEY[:rows]
    return X.mix(X.mix(parts).sum(axis=2, dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * _STEP)


def node_of(text: Column) -> Column:
    """16 bytes that stand for a text; all texts without words share one."""
    body = F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.when(body.rlike(r"[^ \t\n\x0B\f\r]"), body).otherwise(F.lit(""))))


def row_key(doc_id: Column, node: Column) -> Column:
    """16 bytes that stand for a text under its doc_id."""
    return F.unhex(F.md5(F.concat(F.when(doc_id.isNull(), "-").otherwise(F.concat(F.lit("+"), doc_id.cast("string"), F.lit(":"))), F.hex(node))))


def banded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """node, doc_id, row_key, n_shingles, bands (empty for texts without words) for every row; no shuffle."""
    node = node_of(F.col(text))
    rows = docs.select(node.alias("node"), F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), node).alias("row_key"), F.col(text).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in X.steps(batches, "body"):
            doc, key, count = shingle_counts(b["body"])
            total = np.bincount(doc, weights=count, minlength=b.num_rows).astype(np.int64)
            full = np.flatnonzero(total)
            sig = signatures(len(full), np.searchsorted(full, doc), key, count)
            ends = np.zeros(b.num_rows + 1, np.int32)
            ends[1:] = np.cumsum(np.where(total > 0, BANDS, 0))
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(band_hashes(sig).ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([b["node"], b["doc_id"], b["row_key"], pa.array(total), lists], names=names)

    names = ["node", "doc_id", "row_key", "n_shingles", "bands"]
    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(run, f"node binary, doc_id {kind}, row_key binary, n_shingles bigint, bands array<bigint>")


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A bit per hash value of ``column`` (16 random bytes): which rows cannot be among ``keys``. Its size is fixed; a full one lets all pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(FILTER_BITS // 64, np.int64)
        for b in batches:
            _set_bits(words, _key_hash(b[column]))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used])], names=["at", "bits"])

    found = keys.select(column).mapInArrow(run, "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy()
    return out


def _key_hash(keys: pa.Array) -> np.ndarray:
    return (np.frombuffer(b"".join(keys.to_pylist()), "<u8")[::2] % np.uint64(FILTER_BITS)).astype(np.int64)


def _set_bits(words: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(words, at >> 6, np.left_shift(np.int64(1), at & 63))


def shingle_bags(rows: DataFrame, keys: np.ndarray | None = None) -> DataFrame:
    """``row_key``, ``node``, its multiset as a sorted array of 64-bit hashes with repeats, in bytes, and a ``sketch``: a byte of each
    signature value; ``rows``: row_key, node, body. With ``keys`` only rows that the filter lets pass."""
    sent = None if keys is None else rows.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if sent is not None and whole.num_rows:
                at = _key_hash(whole["row_key"])
                whole = whole.filter(pa.array((sent.value[at >> 6] >> (at & 63) & 1).astype(bool)))
            for b in X.steps(iter([whole]), "body"):
                doc, key, count = shingle_counts(b["body"])
                flat = np.repeat(key, count)
                ends = np.searchsorted(np.repeat(doc, count), np.arange(b.num_rows + 1))
                bags = [flat[ends[i] : ends[i + 1]].tobytes() for i in range(b.num_rows)]
                full = np.flatnonzero(np.diff(ends))
                sketches = np.zeros((b.num_rows, SIZE), np.uint8)
                sketches[full] = signatures(len(full), np.searchsorted(full, doc), key, count) & 0xFF
                yield pa.RecordBatch.from_arrays([b["row_key"], b["node"], pa.array(bags, pa.binary()), pa.array([x.tobytes() for x in sketches], pa.binary())],
                                                 names=["row_key", "node", "bag", "sketch"])

    return rows.select("row_key", "node", "body").mapInArrow(run, "row_key binary, node binary, bag binary, sketch binary")


def overlap(a: bytes, b: bytes) -> int:
    """Size of the intersection of two multisets of 64-bit hashes."""
    return common_size(*(np.unique(np.frombuffer(x, np.uint64), return_counts=True) for x in (a, b)))


def enough(common, size_a, size_b):
    """Whether an overlap of two bags makes their weighted Jaccard similarity reach the threshold; exact in integers."""
    return common * (SIMILAR[0] + SIMILAR[1]) >= SIMILAR[0] * (size_a + size_b)


def verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose multisets are similar.

    Sketches go first: a pair of similarity 0.8 has less than ``MIN_SKETCH`` of its bytes equal with a chance below 1e-9. Only the
    others' multisets are moved and compared.
    """
    def compare(column: str, good):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x, y = b["x"], b["y"]
                kept = [good(x[i].as_buffer(), y[i].as_buffer()) for i in range(b.num_rows)]
                yield b.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

        def joined(these: DataFrame) -> DataFrame:
            both = these.join(bags.select(F.col("node").alias("a"), F.col(column).alias("x")), "a") \
                .join(bags.select(F.col("node").alias("b"), F.col(column).alias("y")), "b")
            return both.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")

        return joined

    near = compare("sketch", lambda p, q: int((np.frombuffer(p, np.uint8) == np.frombuffer(q, np.uint8)).sum()) >= MIN_SKETCH * SIZE)
    alike = compare("bag", lambda p, q: enough(overlap(p, q), len(p) // 8, len(q) // 8))
    return alike(near(pairs))


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, root) after merging the roots that ``links`` (a, b: roots) connect: the smallest root stands for all.

    Minimum labels with pointer jumping, one settled table per step; the number of steps grows with the logarithm of the longest
    chain of links.
    """
    edges = settle(links.union(links.select("b", "a")).distinct(), "edges")
    roots = edges.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("root"), F.least("a", "low").alias("low"))
    while True:
        near = edges.join(roots.select(F.col("root").alias("b"), "low"), "b").groupBy("a").agg(F.min("low").alias("near"))
        moved = roots.join(near, roots["root"] == near["a"]).select("root", F.col("low").alias("old"), F.least("low", "near").alias("low"))
        jump = roots.select(F.col("root").alias("low"), F.col("low").alias("further"))
        roots = settle(moved.join(jump, "low").select("root", "old", F.least("low", "further").alias("low")), "roots")
        if roots.where(F.col("old") != F.col("low")).isEmpty():
            return settle(labels.join(roots, "root", "left").select("node", F.coalesce("low", "root").alias("root")), "labels")
        roots = roots.drop("old")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row_key, class_id, is_first for every row; ``is_first`` marks the rows of one (text, doc_id) per class."""
    rows = settle(banded(docs, doc_id, text), "banded")
    nodes = settle(rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first"),
                                            F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "nodes")
    spread = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    shared = spread.groupBy("key").agg(F.count("*").alias("mates")).where("mates > 1")
    members = settle(spread.join(shared, "key"), "members")
    degrees = members.groupBy("node").agg(F.sum("mates").alias("degree"))
    candidates = settle(nodes.select("node", F.col("first")["row_key"].alias("row_key")).join(degrees, "node"), "candidates")
    members = members.join(candidates.select("node", "degree"), "node")
    node = node_of(F.col(text))
    bodies = docs.select(row_key(F.col(doc_id), node).alias("row_key"), node.alias("node"), F.col(text).alias("body"))
    made = shingle_bags(bodies, key_filter(candidates, "row_key"))  # texts are not shuffled, only the multisets of candidates
    bags = settle(made.join(candidates.select("row_key"), "row_key", "left_semi").dropDuplicates(["row_key"]).drop("row_key"), "bags")
    labels = linked(members, bags, candidates.select("node", F.col("node").alias("root")))
    named = nodes.select("node", "doc_id", "first").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = named.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.min("first").alias("head"))
    by_node = settle(named.select("node", "root").join(heads, "root").select("node", "class_id", F.col("head")["row_key"].alias("head_key")), "classes")
    return rows.select("node", "doc_id", "row_key").join(by_node, "node") \
        .select("doc_id", "row_key", "class_id", (F.col("row_key") == F.col("head_key")).alias("is_first"))


def linked(members: DataFrame, bags: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels (node, root) of the candidate nodes after all pairs that meet in a bucket. ``members``: key, band, node, n, degree, mates.

    Buckets of up to ``SMALL`` have all their pairs verified, larger ones their hub against all members; then open buckets, those with
    members in different parts, are compared in full.
    """
    lot = F.when(F.col("mates") <= SMALL, F.xxhash64("node"))
    best = F.max_by(F.struct("node", "n"), F.struct("degree", "node")).alias("hub")
    hubs = members.groupBy("key", lot.alias("lot")).agg(best).select("key", F.col("hub")["node"].alias("hub"), F.col("hub")["n"].alias("hub_n"))
    fits = F.least("n", "hub_n") * SIMILAR[1] >= F.greatest("n", "hub_n") * SIMILAR[0]
    tested = settle(members.join(hubs, "key").where((F.col("node") != F.col("hub")) & fits)
                    .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "pairs")
    labels = merged(labels, settle(verified(tested, bags), "links"))
    members = members.where(F.col("mates") > SMALL).select("key", "band", "node", "n")
    parts = members.join(labels, "node").groupBy("key", "root").agg(F.count("*").alias("size"))
    largest = parts.groupBy("key").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.sum("size").alias("all"),
                                       (F.sum("size") - F.max("size")).alias("rest")).where("rest > 0")
    open_ = settle(members.join(largest, "key").join(labels, "node"), "open")
    return merged(labels, settle(across(open_, bags).distinct(), "links"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after the links (a, b)."""
    if links.isEmpty():
        return labels
    ends = links.join(labels.select(F.col("node").alias("a"), F.col("root").alias("root_a")), "a") \
        .join(labels.select(F.col("node").alias("b"), F.col("root").alias("root_b")), "b").where("root_a != root_b")
    return components(labels, ends.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))


def across(open_: DataFrame, bags: DataFrame) -> DataFrame:
    """Links (a, b) that join the parts of each bucket as far as its pairs do. ``open_``: key, band, node, n, root, main (largest part of the
    bucket), all, rest (members outside it).

    Members outside the largest part are dealt to lots, and so are all members; a task compares one lot with one lot. It returns a
    forest: no link between nodes that its other links connect already. A pair is tested in the first band in which it meets.
    """
    lots = lambda c: F.ceil(F.col(c) / LOT).cast("int")
    mine = lambda c, salt: F.pmod(F.xxhash64("node", F.lit(salt)), lots(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), lots(c) - 1))
    common = ["key", "band", "node", "n", "root"]
    left = open_.where(F.col("root") != F.col("main")).select(*common, mine("rest", 1).alias("row"), every("all").alias("col"), F.lit(True).alias("outer"))
    right = open_.select(*common, every("rest").alias("row"), mine("all", 2).alias("col"), F.lit(False).alias("outer"))
    # a node that is on both sides of a task travels once
    rows = left.unionByName(right).groupBy(*common, "row", "col").agg(F.max("outer").alias("outer"), F.max(~F.col("outer")).alias("inner")) \
        .join(bags.join(open_.groupBy("node").agg(F.collect_list(F.struct("band", "key")).alias("meets")), "node"), "node")

    def run(t: pa.Table) -> pa.Table:
        outer, inner = (np.flatnonzero(t[c].to_numpy(zero_copy_only=False)) for c in ("outer", "inner"))
        node, n = t["node"].to_pylist(), t["n"].to_numpy()
        root = np.unique(np.array(t["root"].to_pylist(), object), return_inverse=True)[1]
        sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(-1, SIZE)
        meets = np.zeros((len(node), BANDS), np.int64)  # key of each band with an open bucket
        flat = t["meets"].combine_chunks()
        meets[np.repeat(np.arange(len(node)), np.asarray(pc.list_value_length(flat))), flat.flatten().field("band").to_numpy()] = flat.flatten().field("key").to_numpy()
        pairs = _allowed(outer, inner, root, n, sketch, meets, t["band"][0].as_py())
        up, counts = list(range(int(root.max()) + 1 if len(root) else 0)), {}

        def top(r: int) -> int:
            while up[r] != r:
                up[r] = up[up[r]]
                r = up[r]
            return r

        def counted(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in counts:
                counts[i] = np.unique(np.frombuffer(t["bag"][i].as_buffer(), np.uint64), return_counts=True)
            return counts[i]

        links = []
        for i, j in pairs:
            r, q = top(int(root[i])), top(int(root[j]))
            if r != q and enough(common_size(counted(i), counted(j)), int(n[i]), int(n[j])):
                up[r] = q
                links.append((min(node[i], node[j]), max(node[i], node[j])))
        return pa.table({"a": pa.array([x[0] for x in links], pa.binary()), "b": pa.array([x[1] for x in links], pa.binary())})

    return rows.groupBy("key", "row", "col").applyInArrow(run, "a binary, b binary")


def _allowed(outer: np.ndarray, inner: np.ndarray, root: np.ndarray, n: np.ndarray, sketch: np.ndarray, meets: np.ndarray,
             band: int) -> Iterator[tuple[int, int]]:
    """Pairs of different parts that meet in ``band`` first and that size and sketch allow: the closest one of each outer member, then the others."""
    later = []
    for i in outer.tolist():
        near = inner[(root[inner] != root[i]) & (np.minimum(n[inner], n[i]) * SIMILAR[1] >= np.maximum(n[inner], n[i]) * SIMILAR[0])]
        near = near[~((meets[near, :band] == meets[i, :band]) & (meets[i, :band] != 0)).any(axis=1)]
        same = (sketch[near] == sketch[i]).sum(axis=1)
        good = np.flatnonzero(same >= MIN_SKETCH * SIZE)
        near = near[good[np.argsort(-same[good], kind="stable")]]
        if len(near):
            yield i, int(near[0])
            later.append((i, near[1:]))
    for i, near in later:
        for j in near.tolist():
            yield i, j


def common_size(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Size of the intersection of two multisets given as sorted values and their counts."""
    if not len(a[0]) or not len(b[0]):
        return 0
    place = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    return int(np.minimum(a[1][place], b[1])[a[0][place] == b[0]].sum())


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each class: the one with the smallest doc_id (then text digest)."""
    first = classes(docs, doc_id, text).where("is_first").select(F.col("row_key").alias("_keep_key")).distinct()
    keyed = docs.select(F.struct("*").alias("row"), row_key(F.col(doc_id), node_of(F.col(text))).alias("_keep_key"))
    return keyed.join(first, "_keep_key", "left_semi").dropDuplicates(["_keep_key"]).select("row.*")

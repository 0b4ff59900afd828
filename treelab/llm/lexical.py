"""Ranked lexical search: every item against all documents by dense blocked matrix products, exact in integers.

Terms are maximal runs of digits, ASCII letters (lower-cased) and characters beyond ASCII. Items come in blocks whose distinct terms stay
within ``BLOCK_TERMS``; the driver holds one block at a time. For each block one scan turns every document into its length and the
counts of the block's terms (settled, far smaller than the text), and document frequencies are summed from it. A second scan multiplies
tiles of document impacts with tiles of item weights in float64. A tile's vocabulary is compact, that is only terms that occur in both, and cut into
slices whose weights keep every partial sum of integers below 2^53, so the products are exact however BLAS orders its sums; slices are
added as 64-bit integers. A tile keeps, per item, all scores down to its k-th one, so ties are settled by doc_id and not by the tile.

Equal doc_ids are documents of their own; a null doc_id ranks before all others among equal scores. Each item row is a query of its own,
and repeated rows get equal results. Null and empty texts have no terms: such an item has no results, such a document no score. Fewer than
k scores above 0 are all returned. Empty tables give empty results. Very long texts are taken whole. Further columns are ignored.
Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window as W, functions as F

from treelab.llm import text as X
from treelab.llm.shared import settle

#: Distinct terms of the items that are searched together; a longer item is a block by itself.
BLOCK_TERMS = 1_000_000
#: Documents and items of a tile, and columns of a slice of its vocabulary.
DOC_TILE, ITEM_TILE, SLICE = 2048, 256, 2048
#: Impacts are below this, so weights of a slice may add up to 2^53 / IMPACT.
IMPACT = 1_000_000
#: Parts that each item's candidates are reduced in before they meet.
FAN = 256

TERM = np.zeros(256, bool)
TERM[48:58] = TERM[65:91] = TERM[97:123] = TERM[128:] = True


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of the texts in order, and the n + 1 places where the terms of a text begin and end."""
    data, offsets = X.raw(texts)
    keep = TERM[data]
    start, end, _, first = X.spans(keep, offsets)
    return X.span_hashes(X.LOWER[data], keep, start, end), first


@dataclass
class Block:
    """Items searched together: ids by number, sorted distinct term hashes, and the items' terms as places in them."""

    ids: list
    vocabulary: np.ndarray
    term: np.ndarray    # places in the vocabulary, item by item
    begin: np.ndarray   # n + 1 places in ``term``

    def tiles(self, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """First item, item of each term within the tile, and the term."""
        for at in range(0, len(self.ids), size):
            ends = self.begin[at : at + size + 1]
            yield at, np.repeat(np.arange(len(ends) - 1), np.diff(ends)), self.term[ends[0] : ends[-1]]


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id and the sorted distinct term hashes of every item with a term."""
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in X.steps(batches, "body"):
            key, first = term_hashes(b["body"])
            bags = [np.unique(key[first[i] : first[i + 1]]).tobytes() for i in range(b.num_rows)]
            out = pa.RecordBatch.from_arrays([b["item_id"], pa.array(bags, pa.binary())], names=["item_id", "terms"])
            yield out.filter(pa.array([len(x) > 0 for x in bags], pa.bool_()))

    return rows.mapInArrow(run, f"item_id {rows.schema['item_id'].dataType.simpleString()}, terms binary")


def blocks(items: DataFrame, item_id: str = "item_id", text: str = "text", block_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """The items block by block, in any order."""
    ids: list = []
    bags: list[np.ndarray] = []
    size = 0
    for row in settle(item_terms(items, item_id, text), "item-terms").toLocalIterator():
        bag = np.frombuffer(row["terms"], np.uint64)
        if ids and size + len(bag) > block_terms:
            yield _block(ids, bags)
            ids, bags, size = [], [], 0
        ids.append(row["item_id"])
        bags.append(bag)
        size += len(bag)
    if ids:
        yield _block(ids, bags)


def _block(ids: list, bags: list[np.ndarray]) -> Block:
    vocabulary, term = np.unique(np.concatenate(bags), return_inverse=True)
    return Block(ids, vocabulary, term, np.cumsum([0, *map(len, bags)]))


def term_counts(docs: DataFrame, vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (terms), and the vocabulary's terms in each document: ``codes`` (places) and ``counts``, as packed 32-bit integers."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        for b in X.steps(batches, "body"):
            key, first = term_hashes(b["body"])
            n = np.diff(first)
            at = np.minimum(np.searchsorted(words, key), len(words) - 1)
            known = words[at] == key
            joint, count = np.unique(np.repeat(np.arange(len(n)), n)[known] * len(words) + at[known], return_counts=True)
            ends = 4 * np.searchsorted(joint, np.arange(len(n) + 1) * len(words)).astype(np.int32)
            packed = [pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(v.astype("<i4"))])
                      for v in (joint % len(words), np.minimum(count, 2**31 - 1))]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n, pa.int64()), *packed], names=["doc_id", "n", "codes", "counts"])

    return rows.mapInArrow(run, "doc_id bigint, n bigint, codes binary, counts binary")


def document_frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """In how many documents each of the ``size`` terms occurs; tasks add up their own documents first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(_flat(b["codes"]), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["code", "df"])

    out = np.zeros(size, np.int64)
    found = counted.select("codes").mapInArrow(run, "code bigint, df bigint").groupBy("code").agg(F.sum("df").alias("df")).toArrow()
    out[found["code"].to_numpy()] = found["df"].to_numpy()  # no more rows than the block has terms
    return out


def _flat(packed: pa.Array) -> np.ndarray:
    """The integers of all rows of a packed column, one after another."""
    return np.frombuffer(b"".join(packed.to_pylist()), "<i4")


def tile_scores(doc: np.ndarray, code: np.ndarray, impact: np.ndarray, n_docs: int, item: np.ndarray, term: np.ndarray, n_items: int,
                weight: np.ndarray, width: int = SLICE) -> np.ndarray:
    """Scores (documents, items) of a tile: sums of weight times impact over the terms of both sides."""
    scores = np.zeros((n_docs, n_items), np.int64)
    common = np.intersect1d(code, term)
    total = np.cumsum(weight[common])
    begin = 0
    while begin < len(common):
        spent = int(total[begin - 1]) if begin else 0
        end = min(begin + width, int(np.searchsorted(total, spent + 2**53 // IMPACT)))
        end = max(end, begin + 1)  # a weight by itself is far below the bound
        columns = common[begin:end]
        mine, theirs = (np.searchsorted(columns, x) for x in (code, term))
        here, there = (np.minimum(x, len(columns) - 1) for x in (mine, theirs))
        own, other = columns[here] == code, columns[there] == term
        left, right = np.zeros((n_docs, len(columns))), np.zeros((len(columns), n_items))
        left[doc[own], here[own]] = impact[own]
        right[there[other], item[other]] = weight[term[other]]
        scores += (left @ right).astype(np.int64)
        begin = end
    return scores


def best(item: np.ndarray, score: np.ndarray, known: np.ndarray, doc_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first rows of each item: highest score, then no doc_id, then smallest doc_id."""
    order = np.lexsort((doc_id, known, -score, item))
    sorted_item = item[order]
    start = np.searchsorted(sorted_item, sorted_item)
    return order[np.arange(len(order)) - start < k]


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
           block_terms: int = BLOCK_TERMS, doc_tile: int = DOC_TILE, item_tile: int = ITEM_TILE, width: int = SLICE) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank (from 1), doc_id, score. The sizes of blocks and tiles do not change results."""
    out = None
    for block in blocks(items, item_id, text, block_terms):
        found = _search_block(docs, block, items.schema[item_id].dataType, k, doc_id, text, doc_tile, item_tile, width)
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = items.schema[item_id].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return out


def _search_block(docs: DataFrame, block: Block, id_type, k: int, doc_id: str, text: str, doc_tile: int, item_tile: int, width: int) -> DataFrame:
    spark = docs.sparkSession
    words = spark.sparkContext.broadcast(block.vocabulary)
    counted = settle(term_counts(docs, words, doc_id, text), "term-counts")
    words.unpersist()
    total = counted.agg(F.sum((F.col("n") > 0).cast("long")).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"] or 0, total["terms"] or 0
    df = document_frequencies(counted, len(block.vocabulary)) if n_terms else np.zeros(len(block.vocabulary), np.int64)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    ids, block.ids = block.ids, list(range(len(block.ids)))
    sent = spark.sparkContext.broadcast((block, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = sent.value
        kept = [np.zeros(0, np.int64)] * 4  # item, score, whether there is a doc_id, doc_id
        floor = np.zeros(len(items.ids), np.int64)  # score of the k-th document so far
        for b in (part for whole in batches for at in range(0, whole.num_rows, doc_tile) for part in [whole.slice(at, doc_tile)]):
            known = np.asarray(b["doc_id"].is_valid()).astype(np.int64)
            number = b["doc_id"].fill_null(0).to_numpy()
            code, count = _flat(b["codes"]), _flat(b["counts"]).astype(np.int64)
            doc = np.repeat(np.arange(b.num_rows), [len(x) // 4 for x in b["codes"].to_pylist()])
            norm = 100 - 90 + (90 * b["n"].to_numpy() * n_docs) // max(n_terms, 1)
            impact = (1_000_000_000 * count) // (1000 * count + 8 * norm[doc])
            for at, item, term in items.tiles(item_tile):
                size = min(item_tile, len(items.ids) - at)
                scores = tile_scores(doc, code, impact, b.num_rows, item, term, size, weights, width)
                low = np.maximum(floor[at : at + size], 1)
                if b.num_rows > k:
                    low = np.maximum(low, np.partition(scores, -k, axis=0)[-k])
                row, column = np.nonzero(scores >= low)
                new = [column + at, scores[row, column], known[row], number[row]]
                mine = (kept[0] >= at) & (kept[0] < at + size)
                joined = [np.concatenate((old[mine], x)) for old, x in zip(kept, new, strict=True)]
                good = best(*joined, k)
                joined = [x[good] for x in joined]
                kept = [np.concatenate((old[~mine], x)) for old, x in zip(kept, joined, strict=True)]
                full = np.flatnonzero(np.bincount(joined[0] - at, minlength=size) >= k)
                lowest = np.full(size, np.iinfo(np.int64).max)
                np.minimum.at(lowest, joined[0] - at, joined[1])
                floor[at + full] = lowest[full]
        yield pa.RecordBatch.from_arrays([pa.array(kept[0]), pa.array(kept[1]), pa.array(kept[3], mask=kept[2] == 0)], names=["item_no", "score", "doc_id"])

    order = (F.desc("score"), F.asc_nulls_first("doc_id"))
    found = counted.mapInArrow(run, "item_no bigint, score bigint, doc_id bigint").withColumn("part", F.spark_partition_id() % FAN)
    first = found.withColumn("r", F.row_number().over(W.partitionBy("item_no", "part").orderBy(*order))).where(F.col("r") <= k)
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("item_no").orderBy(*order))).where(F.col("rank") <= k)
    ranked = settle(ranked.select("item_no", "rank", "doc_id", "score"), "ranked")
    sent.unpersist()
    return ranked.join(_names(spark, ids, id_type), "item_no").select("item_id", "rank", "doc_id", "score")


def _names(spark: SparkSession, ids: list, id_type) -> DataFrame:
    return spark.createDataFrame([Row(item_no=i, item_id=v) for i, v in enumerate(ids)], f"item_no bigint, item_id {id_type.simpleString()}")

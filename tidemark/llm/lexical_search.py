"""Ranked lexical search: every document scored for every item by dense blocked matrix products.

Terms are the maximal runs of letters, digits and characters beyond ASCII, with A-Z lower-cased. ``N``
documents have a term, ``L`` is the sum of their lengths, ``df`` counts the documents that hold a term.
A term weighs ``floor(1000 ln((2N + 2) / (2 df + 1)))``; its impact on a document of ``n`` terms that holds
it ``tf`` times is ``10^9 tf div (1000 tf + 20 m)`` with ``m = 50 + (50 n N) div L``.

Items are the stated query set and come in blocks of about BLOCK_TERMS (item, term) pairs, one item at
least; a block is all that is ever sent to the executors. One pass over the texts keeps each document's
length and its counts of the block's terms. A second pass multiplies: a tile of items has a compact
vocabulary of its own, a tile of documents becomes a dense matrix of impacts over that vocabulary, and the
product of both in float64 gives their scores. A product of a weight and an impact is below 2^53 / WIDTH or
the vocabulary is cut, so that no partial sum reaches 2^53 and every score is an exact integer.

Each task keeps the best ``k`` documents of an item while it goes through its tiles. Documents that equal
the last of them stay in until their ids decide, so ties fall the same way however the table is split.

Cases: null texts, and texts without a term, hold no document term and are found by nothing; items without
a term, and items of which no term occurs, have no rows. Item rows with one id are one query with the terms
of all of them; a null id is an id. Documents that share an id are ranked each by itself; null ids come last
among equal scores. An empty table on either side gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import bytes_of, cut, stored

#: (item, term) pairs of one block of items.
BLOCK_TERMS = 200_000
#: Items and documents of one product.
ITEM_TILE, DOC_TILE = 64, 1024
#: Columns of one product at most.
WIDTH = 4096

#: Every byte that is no part of a term becomes a space; A-Z become a-z.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class ItemBlock:
    """Items, their vocabulary and, for each item, the sorted numbers of its terms."""

    ids: list[int | None]
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]


def item_blocks(items: DataFrame, size: int = BLOCK_TERMS) -> Iterator[ItemBlock]:
    """The items in order of their ids, ``size`` (item, term) pairs at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text"):
            found = [list(set(terms(t))) for t in bytes_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])

    listed = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").mapInArrow(work, "item_id BIGINT, terms ARRAY<BINARY>")
    single = listed.select("item_id", F.explode("terms").alias("term")).distinct()
    rows = single.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).orderBy("item_id")
    ids, vocabulary, lists, held = [], {}, [], 0
    for row in rows.toLocalIterator():
        if ids and held + len(row["terms"]) > size:
            yield ItemBlock(ids, vocabulary, lists)
            ids, vocabulary, lists, held = [], {}, [], 0
        ids.append(row["item_id"])
        lists.append(np.sort([vocabulary.setdefault(bytes(t), len(vocabulary)) for t in row["terms"]]))
        held += len(row["terms"])
    if ids:
        yield ItemBlock(ids, vocabulary, lists)


_COUNTED = "doc_id BIGINT, n BIGINT, held ARRAY<INT>, tf ARRAY<BIGINT>"


def _counted(docs: DataFrame, vocabulary) -> DataFrame:
    """Each document's length and its counts of the terms of the broadcast ``vocabulary``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in cut(batches, "text"):
            sizes, held, counts = [], [], []
            for text in bytes_of(batch.column(1)):
                words = terms(text)
                known = np.array([x for x in map(number, words) if x is not None], np.int32)
                found, tf = np.unique(known, return_counts=True)
                sizes.append(len(words))
                held.append(found)
                counts.append(tf.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(held, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["doc_id", "n", "held", "tf"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, _COUNTED)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impacts of terms that documents of ``n`` terms hold ``tf`` times."""
    lengths, at = np.unique(n, return_inverse=True)
    m = np.array([50 + 50 * int(x) * n_docs // n_terms for x in lengths], np.int64)[at]  # beyond 64 bits in between
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class ItemTile:
    """Some items of a block: their compact vocabulary and the weights over it."""

    def __init__(self, first: int, lists: list[np.ndarray], weights: np.ndarray):
        self.first, self.size = first, len(lists)
        self.columns = np.unique(np.concatenate(lists))
        self.place = np.full(len(weights), -1, np.int64)
        self.place[self.columns] = np.arange(len(self.columns))
        self.weights = np.zeros((len(lists), len(self.columns)))
        for row, listed in enumerate(lists):
            self.weights[row, self.place[listed]] = weights[listed]
        # An impact is below 10^6, so this many products of it stay below 2^53.
        self.width = max(1, min(WIDTH, (1 << 53) // (1_000_000 * max(1, int(weights.max(initial=0))))))

    def scores(self, doc: np.ndarray, held: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores (items x documents) of documents given as triples of document, term and impact."""
        column = self.place[held]
        mine = column >= 0
        doc, column, impact = doc[mine], column[mine], impact[mine]
        total = np.zeros((self.size, n_docs), np.int64)
        for start in range(0, len(self.columns), self.width):
            stop = min(start + self.width, len(self.columns))
            inside = (column >= start) & (column < stop)
            dense = np.zeros((n_docs, stop - start))
            dense[doc[inside], column[inside] - start] = impact[inside]
            total += (self.weights[:, start:stop] @ dense.T).astype(np.int64)
        return total


class Best:
    """The best ``k`` (score, document) of each item so far, ties by document."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.floor = np.ones(n_items, np.int64)
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.no_id = np.zeros(0, bool)

    def offer(self, first: int, scores: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        """Scores of items from ``first`` on for documents ``doc`` (``no_id``: the id is null)."""
        low = self.floor[first : first + len(scores)]
        if scores.shape[1] > self.k:
            low = np.maximum(low, np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k])
        item, at = np.nonzero(scores >= low[:, None])  # whoever equals the last one stays in
        if not len(item):
            return
        rows = [
            np.concatenate(x)
            for x in (
                (self.item, item + first), (self.score, scores[item, at]), (self.doc, doc[at]), (self.no_id, no_id[at]),
            )
        ]
        order = np.lexsort((rows[2], rows[3], -rows[1], rows[0]))
        rows = [x[order] for x in rows]
        starts = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]])
        rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        last = rank == self.k - 1
        self.floor[rows[0][last]] = rows[1][last]
        self.item, self.score, self.doc, self.no_id = (x[rank < self.k] for x in rows)


_FOUND = "item_id BIGINT, doc_id BIGINT, score BIGINT"


def _scored(counted: DataFrame, block, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best ``k`` documents of each item in each task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        tiles = [
            ItemTile(s, items.terms[s : s + ITEM_TILE], weights) for s in range(0, len(items.ids), ITEM_TILE)
        ]
        best = Best(len(items.ids), k)
        for batch in batches:
            for start in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(start, DOC_TILE)
                lists = part.column(2)
                sizes = np.diff(lists.offsets.to_numpy())
                held, tf = (x.flatten().to_numpy() for x in (lists, part.column(3)))
                doc = np.repeat(np.arange(part.num_rows), sizes)
                n = part.column(1).to_numpy()
                impact = impacts(tf, np.repeat(n, sizes), n_docs, n_terms)
                ids = part.column(0).fill_null(0).to_numpy()
                no_id = part.column(0).is_null().to_numpy(zero_copy_only=False)
                for tile in tiles:
                    best.offer(tile.first, tile.scores(doc, held, impact, part.num_rows), ids, no_id)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([items.ids[i] for i in best.item], pa.int64()),
                pa.array(best.doc, pa.int64(), mask=best.no_id),
                pa.array(best.score, pa.int64()),
            ],
            ["item_id", "doc_id", "score"],
        )

    return counted.mapInArrow(work, _FOUND)


def search(docs: DataFrame, items: DataFrame, k: int = 50, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of the ``k`` best documents (score above 0) of every item."""
    spark = docs.sparkSession
    found = spark.createDataFrame([], _FOUND)
    for block in item_blocks(items, block_terms):
        shared = spark.sparkContext.broadcast(block)
        counted = stored(_counted(docs, spark.sparkContext.broadcast(block.vocabulary)), "term-counts")
        n_docs, n_terms = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = counted.select(F.explode("held").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        weights = np.zeros(len(block.vocabulary), np.int64)
        for row in held.toLocalIterator():  # a row for each term of the block at most
            weights[row["term"]] = weight(row["df"], n_docs)
        with_terms = counted.where(F.size("held") > 0)
        found = found.union(stored(_scored(with_terms, shared, weights, n_docs, n_terms, k), "best-documents"))
    place = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")

"""Benchmark decontamination: a BM25 index of the test items with block-max pruning.

The items are the indexed side; every passage of every training text is a query. Impacts (BM25
term weights of an item) are divided by the item's score against itself, so that one threshold means
the same share of every item. Items lie in blocks of ``BLOCK``; the index keeps, for each term, its
largest impact over all items and over each block. A passage is pruned when the sum of its terms'
largest impacts is under the threshold, then block by block by the block maxima; only blocks that
pass are scored exactly. The bounds are upper bounds, so every (passage, item) above the threshold is found.

A text is cut into steps as long as the longest of all items; a passage is two steps that follow each other,
so that some passage holds the whole of any run of an item's length.

Found items are verified on the whole text: the last line of an item (or its last sentence) is its
answer, the rest its question; enough of the distinct word grams of both must occur in the text. Grams have
``GRAM`` words, and fewer in a short question or answer, so that one changed word never takes more than half
of them (but for a part of a single word, which must stand in the text). A question of
``LONE`` words or more is indexed once more on its own, and its item is also found when all grams of the question
occur, whatever became of the answer; its score is then the question's.

The items are taken in shards of at most ``SHARD`` rows, each small enough to go to every task;
term statistics cover all items.

Cases: null or empty texts and items match nothing; an item without words is left out; equal items
are reported each under its own id; repeated documents are each reported. Rows with a null doc_id
are reported with a null id and, when filtering, dropped like others. Extra columns are ignored or kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import bytes_of, cut, free_name

K1, B = 1.2, 0.75
BLOCK, SHARD = 8, 1000
GRAM = 5
LONE = 8
SCORE, OVERLAP = 0.6, 0.5
#: Lower case for A-Z, a space for every ASCII character that is no letter or digit.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))
_SENTENCE = re.compile(rb"(?<=[.?!])\s+")


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def question_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """The item's words as question and answer; an item of one sentence is all question."""
    parts = [x for x in text.split(b"\n") if terms(x)]
    if len(parts) < 2:
        parts = [x for x in _SENTENCE.split(text) if terms(x)]
    if len(parts) < 2:
        return terms(text), []
    return terms(b" ".join(parts[:-1])), terms(parts[-1])


def grams(words: list[bytes], n: int = GRAM) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    n = min(n, len(words))
    return set(zip(*(words[k:] for k in range(n)), strict=False))


def gram_length(words: int) -> int:
    """The longest gram, up to ``GRAM``, of which one changed word leaves half in a part of so many words."""
    return max(1, min(GRAM, (words + 1) // 3))


@dataclass(frozen=True)
class ItemIndex:
    """One shard of items; rows of the arrays are terms, in the order of ``vocabulary``."""

    ids: list
    parts: list  # (question grams, answer grams) of each item
    vocabulary: dict
    postings: list  # per term: {block: (item positions, impacts)}
    most: np.ndarray  # largest impact of each term; the last row, for unknown words, is zero
    blocks: np.ndarray  # (terms + 1, blocks) largest impact in each block
    window: int
    home: list  # of an entry that is a question on its own: the place of its item; else None


def build_index(items: list[tuple], frequency: dict, total: int, mean_length: float, window: int | None = None) -> ItemIndex:
    """``items``: (item_id, text bytes); ``frequency``: items that hold a term, over all shards.

    ``window``: words of the longest item of all shards; None: of ``items``.
    """
    items = [(i, t, w) for i, t in items if (w := terms(t))]
    window = window or max((len(w) for _, _, w in items), default=1)
    split = [question_answer(t) for _, t, _ in items]
    home: list[int | None] = [None] * len(items)
    home += [at for at, (question, answer) in enumerate(split) if answer and len(question) >= LONE]
    items += [(items[at][0], items[at][1], split[at][0]) for at in home[len(items) :]]
    split += [split[at] for at in home[len(split) :]]
    vocabulary: dict[bytes, int] = {}
    postings: list[dict] = []
    for at, (_, _, words) in enumerate(items):
        counts = Counter(words)
        weights = {}
        for term, tf in counts.items():
            n = frequency[term]
            idf = math.log(1 + (total - n + 0.5) / (n + 0.5))
            weights[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_length))
        own = sum(weights.values())
        for term, weight in weights.items():
            row = vocabulary.setdefault(term, len(vocabulary))
            if row == len(postings):
                postings.append(defaultdict(list))
            postings[row][at // BLOCK].append((at, weight / own))
    blocks = np.zeros((len(vocabulary) + 1, -(-len(items) // BLOCK)), np.float32)
    for row, lists in enumerate(postings):
        for block, found in lists.items():
            blocks[row, block] = max(x for _, x in found)
    parts = [tuple(grams(p, gram_length(len(p))) for p in both) for both in split]
    return ItemIndex(
        [i for i, _, _ in items], parts, vocabulary, [dict(x) for x in postings], blocks.max(1, initial=0), blocks, window, home
    )


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one range after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


def retrieve(index: ItemIndex, texts: list[np.ndarray], threshold: float) -> list[dict[int, tuple[float, int]]]:
    """For each text, the items that some passage scores at or above the threshold: best score and its passage.

    ``texts``: the words as term rows of the index, -1 for words that no item has. A text is cut into
    steps of the longest item's length; passage ``p`` is the distinct terms of steps ``p`` and ``p + 1``.
    """
    best: list[dict[int, tuple[float, int]]] = [{} for _ in texts]
    steps = np.array([max(1, -(-len(x) // index.window)) for x in texts])
    first = np.concatenate([[0], np.cumsum(steps)])
    rows = np.concatenate(texts)
    step = np.concatenate([f + np.arange(len(x)) // index.window for f, x in zip(first, texts, strict=False)])
    width = len(index.vocabulary) + 1
    known = rows >= 0
    keys = np.unique(step[known] * width + rows[known])  # distinct terms of each step
    if not len(keys):
        return best
    at, term = keys // width, keys % width
    before = np.searchsorted(keys, keys - width)
    fresh = keys[np.minimum(before, len(keys) - 1)] != keys - width  # not in the step before
    fresh &= ~np.isin(at, first)  # a text's first step ends no passage
    weight = index.most[term].astype(np.float64)
    sums = np.bincount(at, weight, first[-1]) + np.bincount(at[fresh] - 1, weight[fresh], first[-1])
    slack = threshold - 1e-4  # the bounds are summed in floats
    passages = np.flatnonzero(sums >= slack)
    if not len(passages):
        return best
    lo, hi = np.searchsorted(at, passages), np.searchsorted(at, passages + 1)
    far = np.flatnonzero(fresh)
    lo2, hi2 = np.searchsorted(at[far], passages + 1), np.searchsorted(at[far], passages + 2)
    last = np.isin(passages + 1, first)
    hi2[last] = lo2[last]
    own = np.searchsorted(first, passages, side="right") - 1
    for start in range(0, len(passages), 2048):
        part = slice(start, start + 2048)
        near_size, far_size = hi[part] - lo[part], hi2[part] - lo2[part]
        held = np.concatenate([term[_ranges(lo[part], hi[part])], term[far[_ranges(lo2[part], hi2[part])]]])
        of = np.concatenate([np.repeat(np.arange(len(near_size)), near_size), np.repeat(np.arange(len(far_size)), far_size)])
        order = np.argsort(of, kind="stable")
        held, of = held[order], of[order]
        ends = np.cumsum(near_size + far_size)
        bounds = np.add.reduceat(index.blocks[held], ends - near_size - far_size, axis=0)
        for p, block in zip(*np.nonzero(bounds >= slack), strict=True):
            scores: dict[int, float] = defaultdict(float)
            for row in held[ends[p] - near_size[p] - far_size[p] : ends[p]]:
                for item, impact in index.postings[row].get(block, ()):
                    scores[item] += impact
            text = own[start + p]
            for item, score in scores.items():
                if score >= threshold and score > best[text].get(item, (0.0, 0))[0]:
                    best[text][item] = (score, int(passages[start + p] - first[text]))
    return best


def leaks(index: ItemIndex, texts: list[bytes | None], threshold: float, overlap: float) -> list[list[tuple]]:
    """For each text, (item position, passage, score, question overlap, answer overlap) of the items that it holds."""
    words = [terms(t) for t in texts]
    if not texts or not index.ids:
        return [[] for _ in texts]
    get = index.vocabulary.get
    rows = [np.fromiter(map(get, w, repeat(-1)), np.int64, len(w)) for w in words]
    out: list[list[tuple]] = []
    for own, best in zip(words, retrieve(index, rows, threshold), strict=True):
        held: dict[int, set] = {}
        found: dict[int, tuple] = {}
        for item, (score, passage) in sorted(best.items()):  # items come before lone questions
            shares = []
            for part in index.parts[item]:
                n = len(next(iter(part), ()))
                if n and n not in held:
                    held[n] = grams(own, n) if len(own) >= n else set()
                shares.append(len(part & held[n]) / len(part) if n else 1.0)
            home = index.home[item]
            if home is None and min(shares) >= overlap:
                found[item] = (item, passage, score, *shares)
            elif home is not None and shares[0] == 1.0:
                found.setdefault(home, (home, passage, score, *shares))
        out.append(list(found.values()))
    return out


def item_shards(benchmark: DataFrame, shard: int = SHARD) -> Iterator[ItemIndex]:
    """The index, one shard after the other; statistics are those of all items."""
    items = benchmark.select("item_id", F.encode("text", "utf-8").alias("t")).where("t IS NOT NULL")
    row = T.StructType([T.StructField("term", T.BinaryType()), T.StructField("words", T.LongType())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(t) for t in batch.column(0).to_pylist()]
            flat = [(x, 0) for w in found for x in set(w)] + [(None, len(w)) for w in found if w]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in flat], pa.binary()), pa.array([x for _, x in flat], pa.int64())], ["term", "words"]
            )

    stats = items.select("t").mapInArrow(split, row).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("w"), F.max("words").alias("longest"))
    whole = stats.where("term IS NULL").first()
    if not whole:
        return
    total, mean = whole["n"], whole["w"] / whole["n"]
    count = items.count()
    shards = max(1, -(-count // shard))
    for k in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id", "t"), F.lit(shards)) == k)
        rows = sorted(((r["item_id"], bytes(r["t"])) for r in part.collect()), key=lambda r: (r[0] is None, r))
        mine = {x for _, t in rows for x in terms(t)}
        if shards == 1:
            held = stats.where("term IS NOT NULL").collect()
        else:
            words = part.select("t").mapInArrow(split, row).select("term").distinct()
            held = stats.join(words, "term", "left_semi").collect()
        yield build_index(rows, {bytes(r["term"]): r["n"] for r in held if bytes(r["term"]) in mine}, total, mean, whole["longest"])


_FOUND = [
    T.StructField("passage", T.LongType()), T.StructField("bm25", T.DoubleType()),
    T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType()),
]


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = SCORE, overlap: float = OVERLAP) -> DataFrame:
    """One row for each document row and item that it holds: doc_id, item_id, passage, bm25, overlaps."""
    kinds = [docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType]
    schema = T.StructType([*map(T.StructField, ("doc_id", "item_id"), kinds), *_FOUND])
    item_type = to_arrow_type(kinds[1])
    found = None
    for index in item_shards(benchmark):

        def search(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in cut(batches, "text"):
                found = leaks(index, bytes_of(batch.column(1)), threshold, overlap)
                hits = [(i, *x) for i, held in enumerate(found) for x in held]
                columns = list(zip(*hits, strict=True)) if hits else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(columns[0], pa.int64())),
                        pa.array([index.ids[x] for x in columns[1]], item_type),
                        pa.array(columns[2], pa.int64()),
                        *(pa.array(c, pa.float64()) for c in columns[3:]),
                    ],
                    schema.names,
                )

        part = docs.select("doc_id", "text").mapInArrow(search, schema)
        found = part if found is None else found.union(part)
    if found is None:  # no item has a word
        return docs.limit(0).select("doc_id", *(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[1:]))
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = SCORE, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are."""
    mark = free_name(docs, "_clean")
    for index in item_shards(benchmark):
        schema = T.StructType([*docs.schema.fields, T.StructField(mark, T.BooleanType())])

        def judge(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in cut(batches, "text"):
                texts = bytes_of(batch.column(batch.schema.get_field_index("text")))
                clean = pa.array([not x for x in leaks(index, texts, threshold, overlap)], pa.bool_())
                yield pa.RecordBatch.from_arrays([*batch.columns, clean], [*batch.schema.names, mark])

        docs = docs.mapInArrow(judge, schema).where(F.col(mark)).drop(mark)
    return docs

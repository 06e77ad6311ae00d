"""SentencePiece encoding by sampling, and lossless decoding.

A text is a lattice of vocabulary pieces. Forward filtering gives each position the weight of all
segmentations that reach it; backward sampling then draws pieces from the end to the start, each in
proportion to its share of that weight, so whole segmentations are drawn from their exact
distribution. The draws come from a counter-based hash of (row key, word number, draw number): a row
always gets the same pieces, wherever and however often it runs.

A piece has spaces at its start only, one before other characters or a run of nothing else, so a text's
lattice is the product of the lattices of its words (the spaces before it, if any, and the characters up
to the next space): forward filtering is done once for each distinct word of a batch, and all occurrences
are sampled together, draw by draw. Words may have any length: up to ``WORD_BYTES`` bytes their weights
are summed together, place by place; longer ones one by one, on a logarithmic scale. Piece weights come
from the model's ranks by Zipf's rule, raised to ``theta``. Characters without a piece become byte
pieces, and so does a literal U+2581, which stands for the space inside pieces: decoding joins the
pieces' bytes and gives back exactly the text.

Cases: null text has null ids and decodes to null; empty text has no ids. Rows are seeded by their
key, and a null key is a key too; rows that share key and text get the same pieces. Extra columns are
ignored or kept.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import GOLDEN, bytes_of, cut, mix

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Words of more bytes are filtered on a logarithmic scale.
WORD_BYTES = 64
THETA = 1.0
#: Keeps products of the weights of up to WORD_BYTES bytes inside a double; it cancels out, for
#: all segmentations of a word have the same bytes.
_PER_BYTE = 100.0
_SLICE = 1 << 20
_U64 = np.uint64
#: Bytes of the character that a byte starts; 0 inside a character.
_CHARACTER = np.array([1] * 0x80 + [0] * 0x40 + [2] * 0x20 + [3] * 0x10 + [4] * 0x10, np.uint8)


@dataclass(frozen=True)
class Pieces:
    """The vocabulary as a trie over bytes."""

    text: list[bytes]  # of each id
    byte_ids: np.ndarray  # id of each byte's piece
    weights: np.ndarray  # of each id, times _PER_BYTE a byte
    edges: np.ndarray  # sorted node * 256 + byte
    targets: np.ndarray  # node that the edge leads to
    ids: np.ndarray  # piece that ends at a node, or -1; the last one, of node -1, is -1
    roots: np.ndarray  # node after a first byte, or -1


def load_pieces(path: str = VOCABULARY, theta: float = THETA) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    text, byte_ids, ids = [], np.zeros(256, np.int32), [-1]
    weights = np.zeros(model.vocab_size())
    edges: dict[int, int] = {}
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            text.append(bytes([int(piece[3:5], 16)]))
            weights[i] = _PER_BYTE * (1 / (model.vocab_size() + 10.0)) ** theta
            continue
        raw = piece.replace("▁", " ").encode()
        usable = not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        usable = usable and (b" " not in raw[1:] or not raw.strip(b" "))
        text.append(raw if usable else b"")
        if not usable or not raw:
            continue
        rank = min(-model.get_score(i), float(model.vocab_size()))
        weights[i] = (1 / (rank + 10.0)) ** theta * _PER_BYTE ** len(raw)
        node = 0
        for k in range(len(raw)):
            key = node << 8 | raw[k]
            if key not in edges:
                edges[key] = len(ids)
                ids.append(-1)
            node = edges[key]
        ids[node] = i
    order = sorted(edges)
    roots = np.array([edges.get(b, -1) for b in range(256)], np.int32)
    ids.append(-1)
    return Pieces(text, byte_ids, weights, np.array(order, np.int32), np.array([edges[k] for k in order], np.int32), np.array(ids, np.int32), roots)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and how many each text has; a text's words joined are the text.

    A text is cut before each run of spaces.
    """
    marked = pc.replace_substring(texts, pattern=b" ", replacement=b"\xff ")  # 0xFF is in no UTF-8 text
    marked = pc.replace_substring(marked, pattern=b" \xff", replacement=b" ")  # none inside a run
    parts = pc.split_pattern(marked, pattern=b"\xff")
    words = parts.flatten()
    sizes = pc.binary_length(words).to_numpy()
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy())
    if not sizes.all():
        words, text = words.filter(pa.array(sizes > 0)), text[sizes > 0]
    return words, np.bincount(text, minlength=len(texts))


def _lattice(pieces: Pieces, words: pa.Array) -> tuple[np.ndarray, ...]:
    """Forward filtering over distinct words.

    Nodes are byte positions; a word of n bytes has n + 1 nodes. Returns each word's first and last
    node, the first edge of each node, and of the edges, which are grouped by end node: start node,
    piece, and the share of the node's weight up to and with the edge.
    """
    sizes = pc.binary_length(words).to_numpy().astype(np.int32)
    base = np.concatenate([[0], np.cumsum(sizes + 1, dtype=np.int32)]).astype(np.int32)
    flat = np.zeros(base[-1], np.uint8)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    packed = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    flat[np.arange(len(packed), dtype=np.int32) + np.repeat(np.arange(len(words), dtype=np.int32), sizes)] = packed
    inside = np.ones(len(flat), bool)
    inside[base[1:] - 1] = False  # the last node of each word
    counts = np.zeros(len(flat), np.uint8)  # edges that end at a node
    covered = np.zeros(len(flat), bool)
    lead = _CHARACTER[flat]
    starts, ends, found, ranks = [], [], [], []

    def add(origin: np.ndarray, at: np.ndarray, piece: np.ndarray) -> None:
        starts.append(origin), ends.append(at), found.append(piece), ranks.append(counts[at])
        counts[at] += 1

    origin = np.flatnonzero(inside).astype(np.int32)
    at, node, depth = origin + np.int32(1), pieces.roots[flat[origin]], 1
    while len(at):
        piece = pieces.ids[node]  # the last id, -1, is that of node -1: no such piece
        done = np.flatnonzero(piece >= 0)
        ended = origin[done]
        add(ended, at[done], piece[done])
        if depth <= 4:
            covered[ended[lead[ended] == depth]] = True
        more = np.flatnonzero(inside[at] & (node >= 0))
        node, at, origin = node[more], at[more], origin[more]
        keys = node << 8 | flat[at]
        spot = np.minimum(np.searchsorted(pieces.edges, keys), len(pieces.edges) - 1)
        hit = np.flatnonzero(pieces.edges[spot] == keys)
        node, at, origin, depth = pieces.targets[spot[hit]], at[hit] + np.int32(1), origin[hit], depth + 1
    # Characters without a piece: one byte piece for each of their bytes.
    head = np.maximum.accumulate(np.where(inside & (lead > 0), np.arange(len(flat), dtype=np.int32), -1))
    bare = np.flatnonzero(inside & ((head < 0) | ~covered[np.maximum(head, 0)])).astype(np.int32)
    add(bare, bare + np.int32(1), pieces.byte_ids[flat[bare]])
    heads = np.concatenate([[0], np.cumsum(counts, dtype=np.int32)]).astype(np.int32)
    spot = heads[np.concatenate(ends)] + np.concatenate(ranks)  # by end node, then in the order found
    start, piece = np.empty(len(spot), np.int32), np.empty(len(spot), np.int32)
    start[spot], piece[spot] = np.concatenate(starts), np.concatenate(found)
    alpha, share = np.zeros(len(flat)), pieces.weights[piece]
    alpha[base[:-1]] = 1.0
    short = np.flatnonzero(sizes <= WORD_BYTES)
    width = sizes[short] + 1
    inner = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
    nodes = np.repeat(base[short], width) + inner.astype(np.int32)
    by_place = nodes[np.argsort(inner.astype(np.uint8), kind="stable")]
    cuts = np.cumsum(np.bincount(inner, minlength=1))
    for a, b in zip(cuts, cuts[1:], strict=False):
        to = by_place[a:b]
        to = to[counts[to] > 0]  # no edge ends inside a character
        size = counts[to].astype(np.int64)
        edge = np.repeat(heads[to] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        part = alpha[start[edge]] * share[edge]
        share[edge] = part
        alpha[to] = np.add.reduceat(part, np.cumsum(size) - size)
    for word in np.flatnonzero(sizes > WORD_BYTES).tolist():
        _filter_long(int(base[word]), int(base[word + 1]), heads, start, share, alpha)
    total = np.cumsum(share / np.repeat(alpha, counts))
    upto = total - np.repeat(np.concatenate([[0.0], total])[heads[:-1]], counts)
    upto[heads[1:][counts > 0] - 1] = 2.0  # the last edge of a node takes the rest
    return base[:-1], base[1:] - 1, heads, start, piece, upto


def _filter_long(first: int, end: int, heads: np.ndarray, start: np.ndarray, share: np.ndarray, alpha: np.ndarray) -> None:
    """Forward filtering over the nodes of one word of any length: ``share`` becomes each edge's part of its node."""
    edges = slice(int(heads[first]), int(heads[end]))
    begins, weights = (start[edges] - first).tolist(), np.log(share[edges]).tolist()
    limits = (heads[first : end + 1] - heads[first]).tolist()
    logs, parts = [0.0] * (end - first), [0.0] * len(begins)
    for node in range(1, end - first):
        a, b = limits[node], limits[node + 1]
        if a == b:  # no edge ends inside a character
            continue
        terms = [logs[begins[k]] + weights[k] for k in range(a, b)]
        top = max(terms)
        scaled = [math.exp(t - top) for t in terms]
        total = sum(scaled)
        logs[node] = top + math.log(total)
        parts[a:b] = [x / total for x in scaled]
    share[edges] = parts
    alpha[first:end] = 1.0


def sample(pieces: Pieces, texts: pa.Array, keys: np.ndarray) -> list[np.ndarray]:
    """The sampled ids of each text (binary, not null); ``keys``: a 64-bit seed for each text."""
    words, counts = words_of(texts.cast(pa.large_binary()))
    if not len(words):
        return [np.zeros(0, np.int32) for _ in range(len(texts))]
    coded = words.dictionary_encode()
    number = coded.indices.to_numpy()
    first, last, heads, start, piece, upto = _lattice(pieces, coded.dictionary)
    ordinal = np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)
    with np.errstate(over="ignore"):
        seed = mix(np.repeat(keys, counts) + GOLDEN * (ordinal.astype(_U64) + _U64(1)))
    node, goal, live = last[number], first[number], np.arange(len(number))
    drawn, owners, length = [], [], np.zeros(len(number), np.int64)
    step = 0
    while len(live):
        with np.errstate(over="ignore"):
            u = (mix(seed[live] + GOLDEN * _U64(step)) >> _U64(11)).astype(np.float64) * 2.0**-53
        edge = heads[node]
        past = np.flatnonzero(upto[edge] <= u)
        while len(past):
            edge[past] += 1
            past = past[upto[edge[past]] <= u[past]]
        drawn.append(piece[edge]), owners.append(live)
        length[live] += 1
        node = start[edge]
        more = node != goal
        live, node, goal = live[more], node[more], goal[more]
        step += 1
    out = np.empty(int(length.sum()), np.int32)
    ends = np.cumsum(length)
    for k, (ids, owner) in enumerate(zip(drawn, owners, strict=True)):
        out[ends[owner] - 1 - k] = ids
    limits = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    return [out[a:b] for a, b in zip(limits, limits[1:], strict=False)]


class Decoder:
    """Joins the bytes of pieces."""

    def __init__(self, pieces: Pieces):
        self.sizes = np.array([len(x) for x in pieces.text], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.flat = np.frombuffer(b"".join(pieces.text), np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.starts[ids] - before, sizes) + np.arange(sizes.sum())].tobytes()


def _filled(texts: pa.Array) -> pa.Array:
    return pc.fill_null(texts.cast(pa.large_binary()), b"")


def _seeds(keys: pa.Array) -> np.ndarray:
    values = keys.cast(pa.int64()).fill_null(-(1 << 62)).to_numpy(zero_copy_only=False)
    return mix(values.astype(np.int64).view(_U64) + GOLDEN)


def encode(docs: DataFrame, key: str = "doc_id", vocabulary: str = VOCABULARY, theta: float = THETA) -> DataFrame:
    """``key`` and ``ids``, the sampled pieces of ``text``; ``key`` is an integer column."""
    pieces = load_pieces(vocabulary, theta)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text", _SLICE):
            texts = bytes_of(batch.column(1))
            ids = sample(pieces, _filled(batch.column(1)), _seeds(batch.column(0)))
            ids = [None if t is None else x for t, x in zip(texts, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(key, "text").mapInArrow(work, schema)


def decode(encoded: DataFrame, key: str = "doc_id", vocabulary: str = VOCABULARY) -> DataFrame:
    """``key`` and ``text`` of rows with ``ids``."""
    pieces = load_pieces(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = Decoder(pieces)
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                texts = [None if x is None else join(np.array(x, np.int64)) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary()).cast(pa.string())], [key, "text"])

    schema = T.StructType([T.StructField(key, encoded.schema[key].dataType), T.StructField("text", T.StringType())])
    return encoded.select(key, "ids").mapInArrow(work, schema)


def round_trip(docs: DataFrame, key: str = "doc_id", vocabulary: str = VOCABULARY, theta: float = THETA) -> DataFrame:
    """``encode`` and ``decode`` in one pass over ``docs``, with digests in place of ids and text.

    Returns ``key``, ``n_pieces``, ``ids_sha256`` (of the ids as little-endian 32-bit integers),
    ``decoded_sha256`` and ``lossless`` (decoding gave the text). Digests of null text are null.
    """
    pieces = load_pieces(vocabulary, theta)
    names = [key, "n_pieces", "ids_sha256", "decoded_sha256", "lossless"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = Decoder(pieces)
        for batch in cut(batches, "text", _SLICE):
            texts = bytes_of(batch.column(1))
            ids = sample(pieces, _filled(batch.column(1)), _seeds(batch.column(0)))
            back = [join(x) for x in ids]
            null = [t is None for t in texts]
            keep = lambda values: [None if gone else v for gone, v in zip(null, values, strict=True)]  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array(keep([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids]), pa.string()),
                    pa.array(keep([hashlib.sha256(x).hexdigest() for x in back]), pa.string()),
                    pa.array([(t or b"") == x for t, x in zip(texts, back, strict=True)], pa.bool_()),
                ],
                names,
            )

    kinds = [docs.schema[key].dataType, T.LongType(), T.StringType(), T.StringType(), T.BooleanType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return docs.select(key, "text").mapInArrow(work, schema)

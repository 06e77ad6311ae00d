"""Language ID: a string-kernel classifier.

The kernel of two texts is the number of byte n-grams (1 to 3, blended) that both hold, over the
geometric mean of the numbers that each holds. Landmarks (labelled texts) span a Nyström feature
map; one-versus-rest kernel ridge regression gives a weight per landmark and language. The presence
kernel is linear in the presence vector, so ``(X L) A = X (L A)``: a batch of texts is scored by
one product of its presence matrix with an (n-gram, language) matrix.

Training rows are a bounded sample: at most ``per_language`` texts of each language, those with the
smallest hash of their id; a limit from the language's number of ids passes only a few more to the ranking. There
may be ``MOST_LANGUAGES`` languages, more are an error. The sampled texts stay on the executors: the driver gets the
landmarks' distinct n-gram codes and the sums of the regression. Scoring reads every row and every text whole.

Cases: null text, empty text and text without letters give ``und`` with score 0. Rows with null
``lang`` are scored, not learned from. Without any labelled row everything is ``und`` with score 0.
Repeated rows and ids are scored one by one; of a repeated id and language the smallest text is learned from.
Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm.common import bytes_of, cut, free_name, hash_limit, stored
from tidemark.session import small_frame

NONE = "und"
#: The model has a column for each language, and what is broadcast has ``per_language`` ids for each.
MOST_LANGUAGES = 1000
_LETTER = re.compile(r"[^\W\d_]")  # also matches numerals such as U+00B2, which are no letters
#: Lower case for A-Z, a space for every other ASCII character that is not a letter.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_CODE_BITS = 25
_SECOND, _THIRD = 256, 256 + 65536
#: Slope of the softmax that turns ridge outputs (about -1 to 1) into a score.
_SLOPE = 4.0


@dataclass(frozen=True)
class KernelModel:
    languages: tuple[str, ...]
    codes: np.ndarray  # sorted n-gram codes that any landmark holds
    weights: np.ndarray  # (codes, languages)


NO_MODEL = KernelModel((), np.zeros(0, np.int64), np.zeros((0, 0)))


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of every distinct n-gram of every text, ordered by row, then code."""
    folded = [t.translate(_FOLD) for t in texts]
    flat = np.frombuffer(b"\0".join(folded) + b"\0\0\0", np.uint8).astype(np.int64)
    rows = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) + 1 for t in folded]) << _CODE_BITS
    a, b, c = flat[: len(rows)], flat[1 : len(rows) + 1], flat[2 : len(rows) + 2]
    one, two, three = a != 0, (a != 0) & (b != 0), (a != 0) & (b != 0) & (c != 0)
    keys = np.unique(
        np.concatenate([
            (rows | a)[one],
            (rows | (_SECOND + (a << 8 | b)))[two],
            (rows | (_THIRD + (a << 16 | b << 8 | c)))[three],
        ])
    )
    return keys >> _CODE_BITS, keys & ((1 << _CODE_BITS) - 1)


def _presence(texts: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The dense presence matrix over ``codes``, and each text's number of distinct n-grams."""
    rows, found = ngrams(texts)
    counts = np.bincount(rows, minlength=len(texts)).astype(np.float64)
    matrix = np.zeros((len(texts), len(codes)), np.float32)
    at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
    known = codes[at] == found
    matrix[rows[known], at[known]] = 1
    return matrix, counts


@dataclass(frozen=True)
class Basis:
    """The Nyström feature map that the landmarks span."""

    names: tuple[str, ...]
    codes: np.ndarray  # sorted n-gram codes that any landmark holds
    held: list[np.ndarray]  # the distinct codes of each landmark
    project: np.ndarray  # (landmarks, features)

    def marks(self) -> np.ndarray:
        """(landmarks, codes): presence over the root of the landmark's number of codes."""
        out = np.zeros((len(self.held), len(self.codes)), np.float32)
        for row, own in zip(out, self.held, strict=True):
            row[np.searchsorted(self.codes, own)] = 1 / math.sqrt(max(len(own), 1))
        return out

    def sums(self, texts: list[bytes], languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Features times features and features times targets, summed over the texts."""
        marks, size = self.marks(), self.project.shape[1] + 1
        gram, target = np.zeros((size, size)), np.zeros((size, len(self.names)))
        for start in range(0, len(texts), 256):
            part, counts = _presence(texts[start : start + 256], self.codes)
            kernel = (part @ marks.T) / np.sqrt(np.maximum(counts, 1))[:, None]
            phi = np.hstack([kernel @ self.project, np.ones((len(kernel), 1))])
            y = np.array([[1.0 if x == n else -1.0 for n in self.names] for x in languages[start : start + 256]])
            gram += phi.T @ phi
            target += phi.T @ y
        return gram, target

    def solve(self, gram: np.ndarray, target: np.ndarray, ridge: float) -> KernelModel:
        solved = np.linalg.solve(gram + ridge * np.eye(len(gram)), target)
        weights = self.marks().T.astype(np.float64) @ (self.project @ solved[:-1])
        return KernelModel(self.names, self.codes, np.vstack([weights, solved[-1:]]).astype(np.float32))


def span(names: tuple[str, ...], held: list[np.ndarray]) -> Basis:
    """The feature map of landmarks with these distinct codes."""
    codes = np.unique(np.concatenate(held))
    basis = Basis(names, codes if len(codes) else np.zeros(1, np.int64), held, np.zeros((0, 0)))
    marks = basis.marks()
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * max(values.max(), 1e-9)
    return replace(basis, project=vectors[:, keep] / np.sqrt(values[keep]))


def distinct_codes(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct n-gram codes of each text."""
    rows, found = ngrams(texts)
    return np.split(found, np.searchsorted(rows, np.arange(1, len(texts))))


def fit_kernel(texts: list[bytes], languages: list[str], landmarks: int, ridge: float) -> KernelModel:
    """The model of a few texts at hand; the first texts of each language are its landmarks."""
    names = tuple(sorted(set(languages)))
    if not names:
        return NO_MODEL
    each = max(1, landmarks // len(names))
    chosen = [i for n in names for i in [j for j, x in enumerate(languages) if x == n][:each]]
    basis = span(names, distinct_codes([texts[i] for i in chosen]))
    return basis.solve(*basis.sums(texts, languages), ridge)


def has_letter(text: bytes) -> bool:
    return any(m.group().isalpha() for m in _LETTER.finditer(text.decode("utf-8", "replace")))


def predict(model: KernelModel, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
    filled = [t or b"" for t in texts]
    labels, scores = [NONE] * len(texts), np.zeros(len(texts))
    if not model.languages or not texts:
        return labels, scores
    for start in range(0, len(filled), 512):
        part = filled[start : start + 512]
        rows, found = ngrams(part)
        counts = np.bincount(rows, minlength=len(part))
        at = np.minimum(np.searchsorted(model.codes, found), len(model.codes) - 1)
        known = model.codes[at] == found
        sums = np.stack(
            [np.bincount(rows[known], model.weights[at[known], k], len(part)) for k in range(len(model.languages))], 1
        )
        raw = sums / np.sqrt(np.maximum(counts, 1))[:, None] + model.weights[-1]
        odds = np.exp(_SLOPE * (raw - raw.max(1, keepdims=True)))
        odds /= odds.sum(1, keepdims=True)
        for i, text in enumerate(part):
            if has_letter(text):
                best = int(np.argmax(raw[i]))
                labels[start + i], scores[start + i] = model.languages[best], odds[i, best]
    return labels, scores


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def training_sample(docs: DataFrame, per_language: int) -> tuple[tuple[str, ...], DataFrame]:
    """The languages, and (lang, rank, doc_id, text) of at most ``per_language`` ids of each that are not held out."""
    labelled = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    ids = labelled.select("doc_id", "lang").distinct().withColumn("hash", F.xxhash64("doc_id"))
    counts = ids.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    limits = small_frame(
        docs.sparkSession, [{"lang": r["lang"], "most": hash_limit(per_language, r["count"])} for r in counts],
        T.StructType([T.StructField("lang", T.StringType()), T.StructField("most", T.LongType())]),
    )
    few = ids.join(F.broadcast(limits), "lang").where("hash <= most")  # one row a language
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    chosen = few.select("doc_id", "lang", F.row_number().over(order).alias("rank")).where(F.col("rank") <= per_language)
    # At most ``per_language`` times MOST_LANGUAGES ids.
    sample = labelled.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("lang", "rank", "doc_id").agg(F.min("text").alias("text"))
    return tuple(sorted(r["lang"] for r in counts)), stored(sample, "language-sample")


def fit_language_model(
    docs: DataFrame, per_language: int = 300, landmarks: int = 128, ridge: float = 0.1
) -> KernelModel:
    """Learn from at most ``per_language`` texts of each language that are not held out.

    The features are as many as the landmarks, so the sums that each task returns are small.
    """
    names, sample = training_sample(docs, per_language)
    if not names:
        return NO_MODEL

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text"):
            found = distinct_codes(bytes_of(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))], ["lang", "rank", "codes"]
            )

    first = sample.select("lang", "rank", "text").where(F.col("rank") <= max(1, landmarks // len(names)))
    marked = sorted(first.mapInArrow(codes, "lang STRING, rank INT, codes ARRAY<INT>").collect(), key=lambda r: (r["lang"], r["rank"]))
    basis = span(names, [np.array(r["codes"], np.int64) for r in marked])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = basis.project.shape[1] + 1
        gram, target, least = np.zeros((size, size)), np.zeros((size, len(names))), None
        for batch in cut(batches, "text"):
            at = batch.column(0).to_pylist()
            least = least or (at[0], batch.column(1)[0].as_py())
            more = basis.sums(bytes_of(batch.column(2)), at)
            gram, target = gram + more[0], target + more[1]
        if least:
            rows = [pa.array([x]) for x in (*least, gram.tobytes(), target.tobytes())]
            yield pa.RecordBatch.from_arrays([rows[0], rows[1].cast(pa.int32()), *rows[2:]], ["lang", "rank", "gram", "target"])

    # The same texts meet in the same order in every run, so the sums are the same to the last bit.
    dealt = sample.select("lang", "rank", "text").repartition(len(names), "rank").sortWithinPartitions("lang", "rank")
    parts = sorted(dealt.mapInArrow(add_up, "lang STRING, rank INT, gram BINARY, target BINARY").collect(), key=lambda r: (r["lang"], r["rank"]))
    size = basis.project.shape[1] + 1
    gram = sum(np.frombuffer(bytes(r["gram"])).reshape(size, size) for r in parts)
    target = sum(np.frombuffer(bytes(r["target"])).reshape(size, len(names)) for r in parts)
    return basis.solve(gram, target, ridge)


def detect_language(docs: DataFrame, model: KernelModel) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row of ``docs``."""
    id_type = docs.schema["doc_id"].dataType

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text"):
            labels, scores = predict(model, bytes_of(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(score, schema)


def keep_known_language(docs: DataFrame, model: KernelModel) -> DataFrame:
    """The rows of ``docs`` that have a language, all columns as they are; ``und`` rows go.

    Those are the texts without a letter. A model that learned no language rejects nothing else:
    without any label every text with a letter stays.
    """
    mark = free_name(docs, "_known")

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text"):
            text = batch.column(batch.schema.get_field_index("text"))
            texts = bytes_of(text)
            labels, _ = predict(model, texts)
            known_one = [x != NONE for x in labels] if model.languages else [has_letter(t or b"") for t in texts]
            kept = pa.array(known_one, pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, kept], [*batch.schema.names, mark])

    schema = T.StructType([*docs.schema.fields, T.StructField(mark, T.BooleanType())])
    return docs.mapInArrow(known, schema).where(F.col(mark)).drop(mark)

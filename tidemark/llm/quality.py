"""Quality scores: a Bradley-Terry model fitted on preference pairs.

Each labelled good text is preferred to labelled bad ones. The chance that ``a`` wins against ``b``
is ``sigmoid(w . (x_a - x_b))``; ``w`` minimises the logistic loss over the pairs' feature
differences. Texts are then ranked by ``w . x``. The threshold is a quantile of the training
scores, at the share of bad texts, and the score is a logistic curve through it: a text at the
threshold scores exactly ``THRESHOLD``.

Features are statistics of the whole text. All rows that may be learned from are: moments, loss and
threshold are those of every one of them. Their features are gathered in cells of about ``per_label``
rows of the more frequent label, with rows of the other one beside them; each text meets texts of the
other label in its cell. Where those are too few to go round, they stand in several cells. Every step
of the minimisation reads the cells where they lie, and the driver adds up one sum a task. The threshold
is found by counting scores in bins, ever finer, not by sorting them.

Cases: null text counts as empty; an empty text has the features of zero and a score like any other.
An id with several texts is learned from once, by its smallest features. Without both labels every score is 0.5. Rows without a label, with null quality, repeated rows and
repeated ids are all scored; labels that contradict each other for an id, and labels other than 0 and 1, are left out of training.
Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import bytes_of, cut, stored

THRESHOLD = 0.3
_SYMBOLS = re.compile(r"[^\w\s.,;:'\"()\-]")
_DIGITS = re.compile(r"\d")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MARKED = re.compile(r"[^\w\s]{2,}")
FEATURES = (
    "log_words", "word_length", "long_words", "upper", "symbols", "digits", "marked_words", "distinct_words",
    "top_word", "repeated_neighbour", "distinct_lines", "words_a_line", "spaces", "bare_symbols", "commonness",
)


def features(text: str) -> list[float]:
    """The text's statistics, in the order of FEATURES; all finite."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    chars, n = len(text), len(words)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    lengths = [*map(len, words)]
    return [
        math.log1p(n),
        math.log1p(sum(lengths) / n),
        sum(x > 20 for x in lengths) / n,
        len(_UPPER.findall(text)) / chars,
        len(_SYMBOLS.findall(text)) / chars,
        len(_DIGITS.findall(text)) / chars,
        min(1.0, len(_MARKED.findall(text)) / n),
        math.log(len(counts)) / math.log(n) if n > 1 else 1.0,
        (max(counts.values()) - 1) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(set(lines)) / max(1, len(lines)),
        math.log1p(n / max(1, len(lines))),
        1 - sum(lengths) / chars,
        sum(not any(map(str.isalnum, w)) * c for w, c in counts.items()) / n,
        sum(c for c in counts.values() if c > 1) / n,
    ]


@dataclass(frozen=True)
class PairModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def rank(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.rank(x) - self.threshold
        return 1 / (1 + np.exp(-np.clip(raw + math.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))


def quantile(scores: np.ndarray, weights: np.ndarray, share: float) -> float:
    """Between the two neighbouring scores with ``share`` of the whole weight below them."""
    order = np.argsort(scores, kind="stable")
    below = np.cumsum(weights[order]) / weights.sum()
    at = min(int(np.searchsorted(below, share - 1e-12)), len(scores) - 2)
    return float((scores[order[at]] + scores[order[at + 1]]) / 2)


def _pairs(g: np.ndarray, b: np.ndarray, opponents: int, seed: int = 7) -> np.ndarray:
    """Feature differences of pairs: each text meets ``opponents`` texts of the other label."""
    draw = np.random.default_rng(seed)
    return np.vstack([
        np.repeat(g, opponents, 0) - b[draw.integers(0, len(b), len(g) * opponents)],
        g[draw.integers(0, len(g), len(b) * opponents)] - np.repeat(b, opponents, 0),
    ])


def _sums(pairs: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number of pairs, slope and curvature of their logistic loss at ``w``, in one flat array."""
    p = 1 / (1 + np.exp(np.clip(pairs @ w, -30, 30)))  # chance that the worse one wins
    return np.concatenate([[len(pairs)], pairs.T @ p, ((pairs * (p * (1 - p))[:, None]).T @ pairs).ravel()])


def _newton(sums: Callable[[np.ndarray], np.ndarray], size: int, rounds: int, penalty: float) -> np.ndarray:
    """The weights that minimise the loss whose sums over all pairs ``sums`` gives."""
    w = np.zeros(size)
    for _ in range(rounds):
        found = sums(w)
        n, slope, curve = found[0], found[1 : size + 1], found[size + 1 :].reshape(size, size)
        step = np.linalg.solve(curve / n + penalty * np.eye(size), slope / n - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_pairs(
    good: np.ndarray, bad: np.ndarray, opponents: int = 16, rounds: int = 60, penalty: float = 1e-3,
) -> PairModel | None:
    """Newton's method on the pairs' logistic loss, for rows in memory; ``fit_quality_model`` does it for a table."""
    if not len(good) or not len(bad):
        return None
    both = np.vstack([good, bad])
    mean, spread = both.mean(0), np.maximum(both.std(0), 1e-6)
    g, b = np.clip((good - mean) / spread, -8, 8), np.clip((bad - mean) / spread, -8, 8)
    pairs = _pairs(g, b, opponents)
    w = _newton(lambda w: _sums(pairs, w), pairs.shape[1], rounds, penalty)
    share = len(b) / (len(g) + len(b))
    return PairModel(mean, spread, w, quantile(np.concatenate([g @ w, b @ w]), np.ones(len(both)), share))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``features`` of every row of ``docs``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text"):
            found = [features((t or b"").decode("utf-8", "replace")) for t in bytes_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "features"]
            )

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("features", T.ArrayType(T.DoubleType()))])
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(FEATURES))


def _valued(rows: DataFrame, name: str, value: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``doc_id`` of measured rows, and ``value`` of their features as ``name``."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value(x), pa.float64())], ["doc_id", name])

    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField(name, T.DoubleType())])
    return rows.select("doc_id", "features").mapInArrow(apply, schema)


def _cells(learned: DataFrame, n_good: int, n_bad: int, per_label: int) -> DataFrame:
    """A row for each cell: ``good`` and ``bad``, the features of its rows by ascending id, one after the other.

    Rows of the more frequent label are in one cell. The others form groups of 64 or more rows, as many
    groups as cells if they suffice; a group is in every cell that has its number modulo the groups.
    """
    large = F.col("quality") == F.lit(int(n_good >= n_bad))
    cells = -(-max(n_good, n_bad) // per_label)
    groups = max(1, min(cells, min(n_good, n_bad) // 64))
    apart = F.when(large, F.lit(cells)).otherwise(F.lit(groups)).cast("bigint")
    places = F.sequence(F.pmod(F.xxhash64("doc_id"), apart), F.lit(cells - 1).cast("bigint"), apart)
    side = lambda q: F.flatten(F.transform(
        F.sort_array(F.collect_list(F.when(F.col("quality") == q, F.struct("doc_id", "features")))), lambda r: r["features"]
    ))
    return learned.withColumn("cell", F.explode(places)).groupBy("cell").agg(side(1).alias("good"), side(0).alias("bad"))


def _cell_sums(cells: DataFrame, mean: np.ndarray, spread: np.ndarray, w: np.ndarray, opponents: int) -> np.ndarray:
    """``_sums`` over all cells; each task sends one row, and they are added in the order of their cells."""
    scaled = lambda flat: np.clip((np.asarray(flat.values).reshape(-1, len(mean)) - mean) / spread, -8, 8)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, total = None, 0.0
        for batch in batches:
            for cell, good, bad in zip(*batch.columns, strict=True):
                g, b = scaled(good), scaled(bad)
                if len(g) and len(b):
                    first = cell.as_py() if first is None else first
                    total = total + _sums(_pairs(g, b, opponents, 7 + cell.as_py()), w)
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([total.tolist()])], ["first", "sums"])

    found = cells.select("cell", "good", "bad").mapInArrow(add, "first BIGINT, sums ARRAY<DOUBLE>").collect()
    return np.sum([r["sums"] for r in sorted(found, key=lambda r: r["first"])], axis=0)


def _smallest(values: DataFrame, name: str, place: int, bins: int = 1024) -> tuple[float, float]:
    """The values at ``place`` and ``place + 1``, counted from 0 in ascending order."""
    value, rest, at = F.col(name), values, place
    ends = values.agg(F.min(name).alias("lo"), F.max(name).alias("hi")).first()
    while ends["lo"] < ends["hi"]:
        width = ends["hi"] - ends["lo"]
        number = F.least(F.floor((value - ends["lo"]) / width * bins), F.lit(bins - 1).cast("bigint"))
        counted = rest.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("lo"), F.max(name).alias("hi"))
        for ends in sorted(counted.collect(), key=lambda r: r["bin"]):  # at most ``bins`` rows
            if at < ends["n"]:
                break
            at -= ends["n"]
        rest = values.where(value.between(ends["lo"], ends["hi"]))
    found = ends["lo"]
    if at + 1 < rest.count():
        return found, found
    above = values.where(value > found).agg(F.min(name)).first()[0]
    return found, found if above is None else above


def fit_measured(measured: DataFrame, labels: DataFrame, per_label: int = 4000, opponents: int = 16, rounds: int = 60, penalty: float = 1e-3) -> PairModel | None:
    """Learn from the labels of all measured rows that are not held out."""
    agreed = (
        labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_other"))
        .where((F.col("quality") == F.col("_other")) & F.col("quality").isin(0, 1))
        .drop("_other")
    )
    once = measured.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("features").alias("features"))
    learned = stored(once.join(agreed, "doc_id"), "quality-rows")
    each = [F.col("features")[k] for k in range(len(FEATURES))]
    moments = learned.agg(
        F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"),
        F.array(*map(F.avg, each)).alias("mean"), F.array(*map(F.stddev_pop, each)).alias("spread"),
    ).first()
    n_good, n_bad = moments["good"], moments["bad"]
    if not n_good or not n_bad:
        return None
    mean, spread = np.array(moments["mean"]), np.maximum(np.array(moments["spread"]), 1e-6)
    cells = stored(_cells(learned, n_good, n_bad, per_label), "quality-cells")
    w = _newton(lambda w: _cell_sums(cells, mean, spread, w, opponents), len(FEATURES), rounds, penalty)
    model = PairModel(mean, spread, w, 0.0)
    ranks = stored(_valued(learned, "rank", model.rank), "quality-ranks")
    return replace(model, threshold=sum(_smallest(ranks, "rank", n_bad - 1)) / 2)


def fit_quality_model(docs: DataFrame, labels: DataFrame, per_label: int = 4000) -> PairModel | None:
    """Learn from all labelled rows that are not held out; ``per_label`` of a label meet in one cell."""
    return fit_measured(measure(docs), labels, per_label)


def score_measured(measured: DataFrame, model: PairModel | None) -> DataFrame:
    """``doc_id`` and ``score`` of every measured row."""
    return _valued(measured, "score", model.score if model else lambda x: np.full(len(x), 0.5))


def score_quality(docs: DataFrame, model: PairModel | None) -> DataFrame:
    """``doc_id`` and ``score`` of every row of ``docs``."""
    return score_measured(measure(docs), model)

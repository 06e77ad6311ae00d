"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at both ends, A-Z in lower case. Keys of at least
``MIN_POINTS`` code points are kept by the first document that holds them; elsewhere their lines go.

Documents come in batches, in ascending id. The index is a set of runs, each a table of
(hash, owner) sorted by hash, grouped in levels. A batch is merge-joined with the runs: keys that
a run knows belong to that run's owner; the anti-joined rest belongs to the batch's smallest id and
becomes a new run of level 0. When a level holds FAN_OUT runs they are merged into one run of the
next level, so a key is rewritten once a level and a batch meets few runs.

Cases: null or empty text is one empty line. A null id counts as one document after all others.
Rows that share an id are one document: the smallest holder keeps the line in each of its rows.
Extra columns are ignored, or kept where the rows are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.llm.common import bytes_of, cut, free_name, spread_join, stored

MIN_POINTS = 10
FAN_OUT = 2
BATCHES = 4
_LAST = (1 << 63) - 1
_SPACE = b" \t\n\v\f\r"


def line_hash(line: bytes) -> bytes | None:
    """The 128-bit hash of a line's key; None for keys that are too short to count."""
    key = line.strip(_SPACE).lower()
    if len(key) < MIN_POINTS or (len(key) < 4 * MIN_POINTS and len(key.decode("utf-8", "replace")) < MIN_POINTS):
        return None
    return xxhash.xxh3_128_digest(key)


class LineIndex:
    """The runs of one job; ``add`` takes the batches in order."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[list[DataFrame]] = []

    def _known(self) -> DataFrame | None:
        runs = [run for level in self.levels for run in level]
        known = None
        for run in runs:
            known = run if known is None else known.union(run)
        return known

    def add(self, keys: DataFrame) -> DataFrame:
        """The (hash, doc) rows of the batch that lose the key; its own new keys join the runs."""
        first = keys.groupBy("hash").agg(F.min("doc").alias("doc"), F.max("doc").alias("last"))
        known = self._known()
        if known is None:
            fresh, dropped = first, None
        else:
            fresh = first.join(known, "hash", "left_anti")
            dropped = spread_join(keys, first.select("hash").join(known, "hash"), "hash", F.col("doc"))
            dropped = dropped.where(F.col("doc") != F.col("owner")).select("hash", "doc")
        fresh = stored(fresh.sortWithinPartitions("hash"), "line-run")
        inside = spread_join(keys, fresh.where("doc != last").select("hash", F.col("doc").alias("owner")), "hash", F.col("doc"))
        inside = inside.where(F.col("doc") != F.col("owner")).select("hash", "doc")
        lost = stored(inside if dropped is None else inside.union(dropped), "line-drops")
        self._push(fresh.select("hash", F.col("doc").alias("owner")), 0)
        return lost

    def _push(self, run: DataFrame, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= FAN_OUT:
            merged = None
            for part in self.levels[level]:
                merged = part if merged is None else merged.union(part)
            self.levels[level] = []
            merged = merged.groupBy("hash").agg(F.min("owner").alias("owner")).sortWithinPartitions("hash")
            self._push(stored(merged, "line-run"), level + 1)


def _doc(column: Column) -> Column:
    return F.coalesce(column.cast("long"), F.lit(_LAST))


def line_keys(docs: DataFrame) -> DataFrame:
    """(doc, hash) for every distinct key of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text"):
            hashes = [list({h for x in (t or b"").split(b"\n") if (h := line_hash(x))}) for t in bytes_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.list_(pa.binary()))], ["doc", "hashes"])

    schema = T.StructType([T.StructField("doc", T.LongType()), T.StructField("hashes", T.ArrayType(T.BinaryType()))])
    found = docs.select(_doc(F.col("doc_id")).alias("doc"), "text").mapInArrow(work, schema)
    return found.select("doc", F.explode("hashes").alias("hash"))


def dropped_keys(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(hash, doc) for every key that a document loses, found batch by batch in ascending id."""
    bounds = docs.select(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    lo, hi = bounds["lo"] or 0, bounds["hi"] or 0
    width = max(1, -(-(hi - lo + 1) // batches))
    part = F.least(F.floor((F.col("doc") - F.lit(lo)) / F.lit(width)), F.lit(batches - 1)).cast("int")
    keys = stored(line_keys(docs).withColumn("batch", F.when(F.col("doc") == _LAST, batches - 1).otherwise(part)), "line-keys")
    index, lost = LineIndex(docs.sparkSession), None
    for batch in range(batches):
        found = index.add(keys.where(F.col("batch") == batch).select("hash", "doc"))
        lost = found if lost is None else lost.union(found)
    return lost


def dedup_lines(docs: DataFrame, batches: int = BATCHES, tally: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """``docs`` with the lost lines taken out of ``text``, and the columns named in ``tally``.

    Null text becomes empty. Columns of ``docs`` that have a name of ``tally`` are replaced.
    """
    lost = dropped_keys(docs, batches).groupBy("doc").agg(F.collect_list("hash").alias("lost"))
    docs = docs.drop(*tally)
    key, gone = free_name(docs, "_doc"), free_name(docs, "_lost")
    lost = lost.select(F.col("doc").alias(key), F.col("lost").alias(gone))
    joined = docs.withColumn(key, _doc(F.col("doc_id"))).join(lost, key, "left").drop(key)

    def work(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(found, "text"):
            at = batch.schema.get_field_index("text")
            texts, counts, drops = [], [], []
            for text, lost in zip(bytes_of(batch.column(at)), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                stay = lines
                if lost:
                    away = set(lost)
                    stay = [x for x in lines if line_hash(x) not in away]
                texts.append(b"\n".join(stay))
                counts.append(len(lines))
                drops.append(len(lines) - len(stay))
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts, pa.int64()), pa.array(drops, pa.int64())], [*batch.schema.names[:-1], *tally]
            )

    schema = T.StructType([*docs.schema.fields, *(T.StructField(x, T.LongType()) for x in tally)])
    return joined.mapInArrow(work, schema)

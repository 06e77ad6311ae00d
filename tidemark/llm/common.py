"""What the operators share: reading a table, storing a step, cutting Arrow batches, mixing hashes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import new_folder

#: Text bytes that a Python step works on at once, whatever the size of an Arrow batch.
SLICE_BYTES = 1 << 20

#: How many ways a key's rows are spread where one key may hold much of a table.
SALTS = 8

_U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends at files that all executors see."""
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (column names ignore case)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def spread_join(rows: DataFrame, keyed: DataFrame, key: str, spread: Column, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``keyed`` (one row a key) on ``key``, with each key's rows spread over SALTS tasks.

    ``spread`` is any column of ``rows`` that varies inside a key. ``keyed`` is repeated SALTS times,
    which costs its size times SALTS and never depends on how often a key occurs.
    """
    salted = rows.withColumn("_salt", F.pmod(F.hash(spread), F.lit(SALTS)))
    copies = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def fan_join(rows: DataFrame, keyed: DataFrame, keys: list[str], spread: Column, share: int = 1024) -> DataFrame:
    """Join ``rows`` with ``keyed`` on ``keys``, with the rows of a hot key spread over tasks.

    ``keyed`` is repeated only for keys that have more than ``share`` rows, once for each ``share`` of them;
    so a key's rows meet in ever more tasks as it grows, and other keys cost nothing. ``spread`` is any
    column of ``rows`` that varies inside a key.
    """
    heat = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / share).cast("int").alias("_parts")).where("_parts > 1")
    copies = heat.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.hash(spread), F.lit(SALTS)))
    parts = F.coalesce("_parts", F.lit(1))
    marked = salted.join(copies, [*keys, "_salt"], "left").drop("_salt")
    marked = marked.withColumn("_part", F.pmod(F.xxhash64(spread), parts).cast("int")).drop("_parts")
    fanned = keyed.join(heat, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return marked.join(fanned, [*keys, "_part"]).drop("_part")


def hash_limit(wanted: int, total: int) -> int:
    """The 64-bit hash up to which at least ``wanted`` of ``total`` hashes lie.

    A few more than ``wanted`` do, whatever ``total`` is, and fewer with a chance below 10^-9; whoever
    wants exactly the ``wanted`` smallest ranks those that pass.
    """
    share = (wanted + 6 * math.sqrt(wanted) + 40) / max(total, 1)
    return min((1 << 63) - 1, int(share * 2.0**64) - (1 << 63))


def hash_below(value: Column, wanted: int, total: int) -> Column:
    """Whether a hash is among the smallest of ``total`` ones, as ``hash_limit`` says."""
    return value <= F.lit(hash_limit(wanted, total))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bytes_of(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column; null stays None."""
    return column.cast(pa.large_binary()).to_pylist()


def cut(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` has about ``limit`` bytes in each; a longer value stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64), element by element."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


GOLDEN = _U64(0x9E3779B97F4A7C15)

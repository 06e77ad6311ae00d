"""The training-corpus pipeline: five operators, one after the other, over ``documents``.

Each stage takes all rows that the one before it kept, is written as Parquet to the shared folder and
read again. All stages but the last return the columns of ``documents``; the last returns one row per
document with the digests of its sampled pieces and of the decoded text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, language_id, line_dedup, near_dedup, pieces
from tidemark.llm.common import free_name, stored, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text or no letters in it) go."""
    return language_id.keep_known_language(docs, language_id.fit_language_model(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; ``n_chars`` follows the text."""
    tally = (free_name(docs, "n_lines"), free_name(docs, "n_dropped"))
    kept = line_dedup.dedup_lines(docs, tally=tally).drop(*tally)
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are near copies of each other, the one with the smallest id stays."""
    return near_dedup.drop_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's sampled pieces and decoded text, as digests."""
    return pieces.round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("decontaminate", benchmark_stage),
    ("pieces", piece_stage),
]

#: Trained models, ranked retrieval and sampling have no SQL form; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Seed files: one CSV with a header per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.model import TableSpec
from tidemark.sources import files
from tidemark.sources.csv_split import read_csv_records


def read_csv(
    spark: SparkSession, path: str, spec: TableSpec, multi_line: bool = True, split: bool = False
) -> DataFrame | None:
    """The file's columns as text, or None when the file is missing.

    Every column is read as a string, so zip prefixes keep their leading zeros; empty fields
    are NULL. Quoted fields may contain line breaks and doubled quotes. Columns are found by
    header name, and a column that the file lacks (a generated key) is left out. Every file of
    a folder must have the same header, and every line as many fields; the read fails otherwise.

    A file with ``multi_line`` is read by one task, because a line break may be inside quotes.
    Large files are split with ``split``, which reads them twice and shuffles their lines once
    (see ``csv_split``), or, where no field has a line break, with ``multi_line`` turned off.
    """
    if not files.exists(spark, path):
        return None
    fields = {"quote": '"', "escape": '"', "nullValue": ""}
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .options(**fields)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("mode", "FAILFAST")
    )
    header = reader.option("inferSchema", False).csv(path).columns
    kept = [c for c in spec.columns if c in header]
    if split:
        return read_csv_records(spark, path, header, fields).select(kept)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return reader.schema(schema).csv(path).select(kept)


def load_csv(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    landing: str,
    mode: str = "append",
    multi_line: bool = True,
    split: bool = False,
) -> int | None:
    """Land a seed file as Parquet; returns the stored row count, or None for a missing file."""
    rows = read_csv(spark, path, spec, multi_line, split)
    if rows is None:
        return None
    rows.write.mode(mode).parquet(landing)
    return spark.read.parquet(landing).count()

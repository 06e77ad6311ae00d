"""Typed tables from bronze text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.typed import cast_failures, fits, silver_type, typed
from tidemark.model import TableSpec


def silver(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows whose every value fits its type and its NOT NULL, typed."""
    return bronze.where(fits(spec)).select(
        *[typed(F.col(c), silver_type(spec, c)).alias(c) for c in spec.columns],
        *[c for c in bronze.columns if c not in spec.columns],
    )


def silver_rejects(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """The other rows, as text, with the names of the columns that do not fit."""
    return bronze.where(~fits(spec)).withColumn("cast_failures", cast_failures(spec))

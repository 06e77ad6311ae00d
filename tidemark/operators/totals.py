"""Counts per table and totals per run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# Columns of the run log. The status is SUCCESS, SKIPPED or ERROR.
RUN_LOG = (
    "table STRING, status STRING, kafka_messages BIGINT, final_records BIGINT, "
    "lost_messages BIGINT, processing_time DOUBLE, error STRING"
)


def run_totals(run_log: DataFrame) -> DataFrame:
    """Tables, messages, records and seconds for each status; a skipped table is not a failure."""
    return run_log.groupBy("status").agg(
        F.count("*").alias("tables"),
        F.coalesce(F.sum("kafka_messages"), F.lit(0)).alias("messages"),
        F.coalesce(F.sum("final_records"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("processing_time"), F.lit(0.0)).alias("seconds"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table. Each count is an aggregate of its own, so only one row per task moves."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)

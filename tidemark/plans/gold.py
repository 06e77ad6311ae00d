"""Aggregated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources import files

_SUMS = ("n_rows", "n_values", "total")


def totals_by_window(
    df: DataFrame, moment: str, measure: str, by: Sequence[str] = (), width: str = "1 day"
) -> DataFrame:
    """Count, sum and average of ``measure`` per tumbling window and group."""
    grouped = df.groupBy(F.window(moment, width).alias("_window"), *by).agg(
        F.count(measure).alias("n_values"), F.sum(measure).alias("total")
    )
    return grouped.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *by,
        "n_values",
        "total",
        (F.col("total").cast("double") / F.col("n_values")).alias("average"),
    )


# -- kept up to date by changes ----------------------------------------------------------------


def window_sums(
    df: DataFrame, moment: str, measure: str, by: Sequence[str] = (), width: str = "1 day"
) -> DataFrame:
    """What a kept total needs of its rows: ``window_start``, ``by``, ``n_rows``, ``n_values``, ``total``.

    Sums that can be taken back: use a decimal or integer measure, as doubles do not cancel.
    """
    grouped = df.groupBy(F.window(moment, width)["start"].alias("window_start"), *by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(measure).alias("n_values"), F.sum(measure).alias("total")
    )
    return grouped.withColumn("total", F.coalesce("total", F.lit(0)))


def window_changes(
    before: DataFrame, after: DataFrame, moment: str, measure: str, by: Sequence[str] = (), width: str = "1 day"
) -> DataFrame:
    """The sums to add to each window: those of the new images less those of the old ones.

    ``before`` has the rows that changes replaced or removed, as they were; ``after`` the rows that
    changes left. A row whose window or group changed is in two windows.
    """
    gone = window_sums(before, moment, measure, by, width)
    gone = gone.select("window_start", *by, *[(-F.col(c)).alias(c) for c in _SUMS])
    both = window_sums(after, moment, measure, by, width).union(gone)
    return _added(both, by)


def _added(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    return sums.groupBy("window_start", *by).agg(*[F.sum(c).alias(c) for c in _SUMS])


def maintain_windows(
    spark: SparkSession, path: str, changes: DataFrame, batch: int, by: Sequence[str] = ()
) -> None:
    """Add ``window_changes`` to the kept sums below ``path``, and rewrite only the windows they touch.

    The table is Parquet, partitioned by window, and Spark replaces the partitions that the result
    has. Old sums of other windows are neither read nor written. A window whose last row went keeps a
    partition with a row count of 0; ``window_totals`` leaves it out.

    ``batch`` rises from run to run, and each window remembers the last one: a run that is repeated
    after a crash adds nothing to the windows that it had written already.
    """
    changes = changes.withColumn("window", F.date_format("window_start", "'w'yyyyMMddHHmmss"))
    types = dict(changes.dtypes)
    if files.exists(spark, path):
        kept = spark.read.parquet(path)
        done = kept.where(F.col("batch") >= batch).select("window").distinct()
        changes = changes.join(done, "window", "left_anti")
        touched = changes.select("window").distinct()
        old = kept.drop("batch").join(touched, "window", "left_semi")
        changes = changes.unionByName(old)
    sums = [F.sum(c).cast(types[c]).alias(c) for c in _SUMS]
    merged = changes.groupBy("window_start", *by, "window").agg(*sums).withColumn("batch", F.lit(batch).cast("bigint"))
    writer = merged.hint("rebalance", F.col("window")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("window").parquet(path)


def window_totals(kept: DataFrame, by: Sequence[str] = (), width: str = "1 day") -> DataFrame:
    """The kept sums in the form of ``totals_by_window``."""
    return kept.where("n_rows > 0").select(
        "window_start",
        (F.col("window_start") + F.expr(f"INTERVAL {width}")).alias("window_end"),
        *by,
        "n_values",
        F.when(F.col("n_values") > 0, F.col("total")).alias("total"),
        F.when(F.col("n_values") > 0, F.col("total").cast("double") / F.col("n_values")).alias("average"),
    )


def images(state: DataFrame, changes: DataFrame, merged: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of ``state``, rows of ``merged``) of the keys that ``changes`` names: the images before and after."""
    named = changes.select(*keys)
    return tuple(side.join(named, list(keys), "left_semi") for side in (state, merged))

"""The latest version of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

# Newest first; NULL versions are the oldest. The partition settles equal offsets.
VERSION = ("cdc_timestamp_ms", "kafka_offset", "kafka_partition")


def latest_per_key(
    changes: DataFrame,
    keys: Sequence[str],
    version: Sequence[str] = VERSION,
    method: str = "window",
) -> DataFrame:
    """One row per key, deletes included: whoever applies the rows needs the delete flag.

    Both methods keep one row per key and map task before the shuffle, so a key that holds a
    third of the log sends as many rows through the shuffle as there are map tasks.

    ``window``: row_number = 1, which the planner turns into a group limit on both sides of
    the exchange. ``aggregate``: ``max_by`` over the row, with partial aggregation.
    NULL keys form one group.
    """
    if method == "window":
        newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in version])
        return (
            changes.withColumn("_position", F.row_number().over(newest_first))
            .where(F.col("_position") == 1)
            .drop("_position")
        )
    if method == "aggregate":
        rest = [c for c in changes.columns if c not in keys]
        newest = changes.groupBy(*keys).agg(
            F.max_by(F.struct(*rest), F.struct(*version)).alias("_newest")
        )
        return newest.select(*keys, "_newest.*").select(*changes.columns)
    raise ValueError(f"method {method!r} is neither 'window' nor 'aggregate'")

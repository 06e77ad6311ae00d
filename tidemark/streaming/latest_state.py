"""The latest version of each key, kept by the stream itself in its state store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.model import TableSpec
from tidemark.operators.decode import decode_changes
from tidemark.operators.latest import latest_per_key
from tidemark.sources import files

_BATCH = "batch"


def start_latest(
    messages: DataFrame,
    spec: TableSpec,
    checkpoint: str,
    path: str,
    image_policy: str = "coalesce",
    interval: str | None = "600 seconds",
) -> StreamingQuery:
    """Keep the newest change of every key in the state store and write the keys that changed.

    The stream aggregates by key in update mode. A change that comes late, or again, loses against
    the version in the state, in whichever micro-batch either arrives; deletes are versions like
    others, so an older change does not bring a deleted row back. Nothing is read from the output.

    Each micro-batch writes its own folder below ``path`` and overwrites it when it is repeated;
    ``latest_rows`` reads them. Rows without a key are left out.

    The state has one row per key that was ever seen, deleted or not, and never shrinks: there is no
    watermark, as any key may change at any time. At size use the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``), or ``start_changes``, which keeps the versions
    in the table. The number of state partitions is that of the first start.
    """
    changes = decode_changes(messages, spec.columns, image_policy).drop("processed_at")
    changes = changes.where(" AND ".join(f"`{k}` IS NOT NULL" for k in spec.keys))
    newest = latest_per_key(changes, spec.keys, method="aggregate")

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(files.join(path, f"{_BATCH}={batch}"))

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        newest.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def latest_rows(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The rows that are there now: of each key what its last micro-batch wrote, without deletes."""
    written = spark.read.parquet(path)
    last = Window.partitionBy(*spec.keys).orderBy(F.col(_BATCH).desc())
    newest = written.withColumn("_place", F.row_number().over(last)).where(F.col("_place") == 1)
    return newest.where(~F.col("is_deleted")).drop("_place", _BATCH, "is_deleted")

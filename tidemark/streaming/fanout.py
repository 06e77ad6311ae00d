"""One stream over all topics, applied table by table in each micro-batch."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.model import TableSpec, lookup
from tidemark.operators.topics import of_topic, topics_of
from tidemark.plans.jobs import Bronze, apply_messages
from tidemark.session import new_folder
from tidemark.sources import files
from tidemark.sources.message_log import ROW_GROUP_BYTES


class MicroBatchFailed(RuntimeError):
    """At least one table of a micro-batch failed; the others were applied."""


def apply_micro_batch(
    messages: DataFrame,
    batch_id: int,
    bronze: Bronze,
    tables: Mapping[str, TableSpec],
    at_once: int = 4,
    stage: bool = True,
) -> None:
    """Apply one micro-batch to every table that it has messages for.

    The batch is read from the source once, into a folder of the shared storage: each table then reads
    the row groups of its own topic, not the whole batch. Without ``stage`` each table reads the source: for
    one that finds a topic's messages without reading the others, as ``MessageLog`` does. A failing table does not stop the others, but it
    fails the micro-batch, so the stream does not move past it; on the retry the tables that
    were applied recognise the batch and skip it.
    """
    spark = messages.sparkSession
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    batch = (stream, batch_id) if stream else None
    staged_at = new_folder(spark, "batch") if stage else None
    try:
        if staged_at:
            messages.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(staged_at)
            messages = spark.read.schema(messages.schema).parquet(staged_at)
        topics = sorted(r["topic"] for r in topics_of(messages).collect())  # one row per topic

        def apply(topic: str) -> str | None:
            try:
                spec = lookup(topic, dict(tables))
                apply_messages(spark, of_topic(messages, topic), spec, bronze, batch)
            except Exception as error:  # noqa: BLE001 - reported below, after the other tables
                return f"{topic}: {type(error).__name__}: {error}"
            return None

        with ThreadPoolExecutor(max_workers=at_once) as pool:
            failures = [f for f in pool.map(inheritable_thread_target(spark)(apply), topics) if f]
    finally:
        if staged_at:
            files.delete(spark, staged_at)
    if failures:
        raise MicroBatchFailed(f"micro-batch {batch_id}: " + "; ".join(failures))


def start_changes(
    messages: DataFrame,
    checkpoint: str,
    bronze: Bronze,
    tables: Mapping[str, TableSpec],
    interval: str | None = "600 seconds",
    stage: bool = True,
) -> StreamingQuery:
    """Start the stream. ``interval`` None processes what is there and stops.

    Order and lateness need no watermark: the version of each row is kept in the table, and
    an older change does not replace a newer row.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        messages.writeStream.foreachBatch(
            lambda df, batch_id: apply_micro_batch(df, batch_id, bronze, tables, stage=stage)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )

"""Messages kept as Parquet: the same columns and the same bounds as a Kafka topic."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.offsets import Bounds, next_offsets
from tidemark.sources import files
from tidemark.sources.kafka import MESSAGE

# Decoding costs far more than reading, so row groups are small: a file is then split over
# several tasks.
ROW_GROUP_BYTES = 2 << 20

SCHEMA = "topic STRING, partition INT, offset BIGINT, value STRING"


@dataclass(frozen=True)
class MessageLog:
    """A folder of Parquet files, one subfolder per topic."""

    path: str

    def write(self, messages: DataFrame, mode: str = "append") -> None:
        rows = messages.select(*MESSAGE[:3], F.col("value").cast("string"))
        # Payloads hardly repeat: a dictionary of them would be built for each row group and given up.
        writer = rows.write.mode(mode).option("parquet.block.size", ROW_GROUP_BYTES)
        writer.option("parquet.enable.dictionary#value", "false").partitionBy("topic").parquet(self.path)

    def append(self, events: DataFrame) -> None:
        """Add events behind those that their partitions hold.

        Every offset is raised by the next position of its partition, so offsets that are unique
        among the events stay unique in the log, and rise with every append. What is joined has one
        row per topic and partition; the events are not shuffled.
        """
        spark = events.sparkSession
        if files.exists(spark, self.path):
            held = next_offsets(spark.read.schema(SCHEMA).parquet(self.path)).drop("messages")
            events = events.join(F.broadcast(held), ["topic", "partition"], "left").withColumn(
                "offset", F.col("offset") + F.coalesce("next_offset", F.lit(0))
            )
        self.write(events)

    def bounds(self, spark: SparkSession, topic: str) -> Bounds:
        """First and next offset of each partition that has messages."""
        rows = spark.read.schema(SCHEMA).parquet(self.path).where(F.col("topic") == F.lit(topic))
        held = rows.groupBy("partition").agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
        return {r["partition"]: (r["first"], r["last"] + 1) for r in held.collect()}  # one row per partition

    def read(
        self,
        spark: SparkSession,
        topic: str,
        start: dict[int, int] | None = None,
        end: dict[int, int] | None = None,
    ) -> DataFrame:
        """Messages of ``topic`` from ``start`` up to but not including ``end``.

        A partition that ``start`` does not name is read from its beginning. With ``end``, only
        the partitions it names are read, so that nothing is read that is not recorded. The
        bounds of each partition reach the scan as a filter.
        """
        rows = spark.read.schema(SCHEMA).parquet(self.path).where(F.col("topic") == F.lit(topic))
        return within(rows, start, end).select(*MESSAGE)

    def stream(
        self, spark: SparkSession, topics: Sequence[str], max_files: int | None = None
    ) -> DataFrame:
        reader = spark.readStream.schema(SCHEMA)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        rows = reader.parquet(self.path)
        return rows.where(F.col("topic").isin(list(topics))).select(*MESSAGE)


def within(
    messages: DataFrame,
    start: dict[int, int] | None,
    end: dict[int, int] | None,
) -> DataFrame:
    """Keep ``start <= offset < end`` for each partition."""
    if not start and not end:
        return messages
    start = start or {}
    slices = []
    for p in sorted(end or start):
        inside = (F.col("partition") == p) & (F.col("offset") >= start.get(p, 0))
        slices.append(inside & (F.col("offset") < end[p]) if end else inside)
    if not end:
        slices.append(~F.col("partition").isin(sorted(start)))
    while len(slices) > 1:  # a balanced tree: topics may have thousands of partitions
        slices = [reduce(or_, slices[i : i + 2]) for i in range(0, len(slices), 2)]
    return messages.where(slices[0])

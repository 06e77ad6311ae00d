"""Append-only log of source positions: ``(topic, offsets, timestamp)``, offsets as JSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.sources import files

SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("offsets", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
    ]
)


def newest_per_topic(log: DataFrame) -> DataFrame:
    """The last saved positions of every topic."""
    newest = F.max_by("offsets", F.struct("timestamp", "offsets"))
    return log.groupBy("topic").agg(newest.alias("offsets"))


class OffsetLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        """Empty only if nothing was saved yet; any other failure to read is an error."""
        if not files.exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def last(self, topic: str) -> dict[int, int] | None:
        """Next offset per partition, or None if the topic was never read."""
        newest = (
            self.read()
            .where(F.col("topic") == F.lit(topic))
            .orderBy(F.col("timestamp").desc(), F.col("offsets").desc())
            .limit(1)
            .collect()
        )
        if not newest:
            return None
        saved = json.loads(newest[0].offsets)[topic]
        return {int(partition): offset for partition, offset in saved.items()}

    def save(self, topic: str, offsets: dict[int, int]) -> None:
        document = json.dumps({topic: {str(p): offsets[p] for p in sorted(offsets)}})
        saved = self.spark.range(1, numPartitions=1).select(
            F.lit(document).alias("offsets"), F.current_timestamp().alias("timestamp")
        )
        # A folder per topic: tables that are loaded at the same time do not share an output.
        saved.write.mode("append").parquet(files.join(self.path, f"topic={topic}"))

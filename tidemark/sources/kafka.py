"""Kafka topics, bounded and unbounded. Needs the Spark Kafka connector on the class path."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.offsets import Bounds

MESSAGE = ("topic", "partition", "offset", "value")


def broker_bounds(spark: SparkSession, options: Mapping[str, str], topic: str) -> Bounds:
    """Every partition of ``topic`` with its first and its next offset, as the broker says; no message is read.

    ``options`` are those of the reader; the ones that begin with ``kafka.`` go to the client.
    """
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for name, value in options.items():
        if name.startswith("kafka."):
            settings.put(name.removeprefix("kafka."), value)
    for side in ("key", "value"):
        settings.put(f"{side}.deserializer", "org.apache.kafka.common.serialization.ByteArrayDeserializer")
    client = jvm.org.apache.kafka.clients.consumer.KafkaConsumer(settings)
    try:
        places = jvm.java.util.ArrayList()
        for info in client.partitionsFor(topic):
            places.add(jvm.org.apache.kafka.common.TopicPartition(topic, info.partition()))
        first, after = client.beginningOffsets(places), client.endOffsets(places)
        return {place.partition(): (first.get(place), after.get(place)) for place in places}
    finally:
        client.close()


@dataclass(frozen=True)
class KafkaSource:
    """``find_bounds`` asks for the partitions of a topic and what they hold; by default the broker.

    ``min_partitions`` splits long topic partitions over several tasks; by default one
    Spark task reads one topic partition, so a partition with a third of all messages would
    be one long task."""

    servers: str
    min_partitions: int | None = None
    options: dict[str, str] = field(default_factory=dict)
    find_bounds: Callable[[SparkSession, Mapping[str, str], str], Bounds] = broker_bounds

    def bounds(self, spark: SparkSession, topic: str) -> Bounds:
        return self.find_bounds(spark, self._common([topic]), topic)

    def _common(self, topics: Sequence[str]) -> dict[str, str]:
        common = {"kafka.bootstrap.servers": self.servers, "subscribe": ",".join(topics)}
        if self.min_partitions:
            common["minPartitions"] = str(self.min_partitions)
        return {**common, **self.options}

    def batch_options(
        self, topic: str, start: dict[int, int] | None = None, end: dict[int, int] | None = None
    ) -> dict[str, str]:
        """From ``start`` (or the beginning) up to but not including ``end`` (or now)."""
        return {
            **self._common([topic]),
            "startingOffsets": _positions(topic, start) if start else "earliest",
            "endingOffsets": _positions(topic, end) if end else "latest",
        }

    def stream_options(
        self,
        topics: Sequence[str],
        starting: str = "earliest",
        max_offsets: int | None = None,
        fail_on_data_loss: bool = True,
    ) -> dict[str, str]:
        options = {
            **self._common(topics),
            "startingOffsets": starting,
            "failOnDataLoss": str(fail_on_data_loss).lower(),
        }
        if max_offsets:
            options["maxOffsetsPerTrigger"] = str(max_offsets)
        return options

    def read(
        self,
        spark: SparkSession,
        topic: str,
        start: dict[int, int] | None = None,
        end: dict[int, int] | None = None,
    ) -> DataFrame:
        reader = spark.read.format("kafka").options(**self.batch_options(topic, start, end))
        return reader.load().select(*MESSAGE)

    def stream(self, spark: SparkSession, topics: Sequence[str], **limits) -> DataFrame:
        reader = spark.readStream.format("kafka").options(**self.stream_options(topics, **limits))
        return reader.load().select(*MESSAGE)


def _positions(topic: str, offsets: dict[int, int]) -> str:
    return json.dumps({topic: {str(p): offsets[p] for p in sorted(offsets)}})

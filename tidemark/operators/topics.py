"""Choose and rename the topics of a mixed stream of messages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.routing import table_of_topic


def route_topics(messages: DataFrame) -> DataFrame:
    return messages.withColumn("topic", table_of_topic(F.col("topic")))


def allow_tables(messages: DataFrame, tables: Iterable[str]) -> DataFrame:
    return messages.where(F.col("topic").isin(list(tables)))


def of_topic(messages: DataFrame, topic: str) -> DataFrame:
    return messages.where(F.col("topic") == F.lit(topic))


def topics_of(messages: DataFrame) -> DataFrame:
    return messages.select("topic").distinct()

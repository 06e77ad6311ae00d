"""Change messages to flat change rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.envelope import (
    UNKNOWN,
    delete_flag,
    envelope_schema,
    has_payload,
    operation_name,
    row_image,
)
from tidemark.functions.keys import any_null


def decode_changes(
    messages: DataFrame,
    columns: Sequence[str],
    image_policy: str = "coalesce",
    keep_value: bool | str = False,
) -> DataFrame:
    """Decode ``(topic, partition, offset, value)`` into business columns plus lineage.

    Tombstones disappear. Malformed text stays as a row of NULLs with operation UNKNOWN; see
    ``split_dead_letters``. ``keep_value`` keeps the payload text for dead letters, as ``value`` or under a name of the
    caller's, where the table has a column of that name.

    Each payload is decoded once, also under a later filter: Catalyst would move such a filter
    below a projection and decode again there, and a generator in between stops it.
    """
    text = F.col("value").cast("string")
    event = F.from_json("value", envelope_schema(columns))
    kept = ["topic", "partition", "offset", *(["value"] if keep_value else [])]
    messages = messages.where(has_payload(text)).withColumn("value", text)
    decoded = messages.select(*kept, F.inline(F.array(event)))
    return decoded.select(
        *[row_image(c, image_policy).alias(c) for c in columns],
        operation_name(F.col("op")).alias("operation_type"),
        F.col("op").alias("cdc_operation"),
        F.col("ts_ms").alias("cdc_timestamp_ms"),
        F.current_timestamp().alias("processed_at"),
        delete_flag(F.col("op")).alias("is_deleted"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        *([F.col("value").alias(keep_value if isinstance(keep_value, str) else "value")] if keep_value else []),
    )


def dead_letter_reason(keys: Sequence[str]):
    """Why a change row cannot be applied, or NULL if it can."""
    return F.when(any_null(keys), "missing_key").when(
        F.col("operation_type") == UNKNOWN, "unknown_operation"
    )


def split_dead_letters(changes: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that can be applied, rows that cannot, with their ``reason``)."""
    reason = dead_letter_reason(keys)
    return (
        changes.where(reason.isNull()),
        changes.withColumn("reason", reason).where(F.col("reason").isNotNull()),
    )

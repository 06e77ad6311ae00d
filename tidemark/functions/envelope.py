"""The change envelope: schema, row image, operation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

# Operation codes of the envelope and the names they decode to.
OPERATIONS = {"r": "READ", "c": "CREATE", "u": "UPDATE", "d": "DELETE"}
UNKNOWN = "UNKNOWN"

# Fields of the envelope's source block.
SOURCE_DDL = (
    "version STRING, connector STRING, name STRING, ts_ms BIGINT, snapshot STRING, "
    "db STRING, schema STRING, table STRING, txId BIGINT, lsn BIGINT, xmin BIGINT"
)

IMAGE_POLICIES = ("coalesce", "strict")


def envelope_schema(columns: Sequence[str], with_source: bool = False) -> T.StructType:
    """Schema of one change event. Every business column is text; values are typed later.

    The source block is left out unless asked for: nothing downstream reads it, and the JSON
    reader skips fields that the schema does not name.
    """
    image = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    schema = T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )
    return schema.add("source", T.StructType.fromDDL(SOURCE_DDL)) if with_source else schema


def has_payload(text: Column) -> Column:
    """False for a tombstone: NULL, empty or blank text.

    This is the same test as "the decoded struct is not NULL", but it does not decode: a
    filter on the decoded struct would be pushed below the projection and decode every
    payload a second time. Only the left end is trimmed, which stops at the first other character;
    trimming the right end walks through the whole text.
    """
    return F.ltrim(text, F.lit(" \t\r\n")) != ""


def row_image(column: str, policy: str = "coalesce") -> Column:
    """The current value of ``column``.

    ``coalesce`` takes the new image's value, or the old one's where the new one is NULL.
    ``strict`` takes the old image for a delete and the new image otherwise, so that an
    update to NULL stays NULL.
    """
    before, after = F.col("before").getField(column), F.col("after").getField(column)
    if policy == "coalesce":
        return F.coalesce(after, before)
    if policy == "strict":
        return F.when(F.col("op") == "d", before).otherwise(after)
    raise ValueError(f"image policy {policy!r} is not one of {IMAGE_POLICIES}")


def operation_name(op: Column) -> Column:
    name = F.lit(UNKNOWN)
    for code, meaning in OPERATIONS.items():
        name = F.when(op == code, meaning).otherwise(name)
    return name


def delete_flag(op: Column) -> Column:
    return F.coalesce(op == "d", F.lit(False))

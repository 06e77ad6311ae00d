"""Column expressions; all of them are built-in JVM functions."""

from tidemark.functions.encode import encoded
from tidemark.functions.envelope import (
    delete_flag,
    envelope_schema,
    has_payload,
    operation_name,
    row_image,
)
from tidemark.functions.keys import all_equal, any_null, bucket_of
from tidemark.functions.moments import micros_of, millis_of, moment_of
from tidemark.functions.routing import table_of_topic
from tidemark.functions.typed import cast_failures, fits, typed

__all__ = [
    "all_equal",
    "any_null",
    "bucket_of",
    "cast_failures",
    "delete_flag",
    "encoded",
    "envelope_schema",
    "fits",
    "has_payload",
    "micros_of",
    "millis_of",
    "moment_of",
    "operation_name",
    "row_image",
    "table_of_topic",
    "typed",
]

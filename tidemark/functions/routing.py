"""Topic names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A captured topic is prefix.schema.table and is routed to its table name.
ROUTE_PATTERN = r"^([^.]+)\.([^.]+)\.([^.]+)$"
ROUTE_REPLACEMENT = "$3"


def table_of_topic(topic: Column) -> Column:
    """``cdc_.public.orders`` becomes ``orders``; any other shape stays as it is."""
    return F.regexp_replace(topic, ROUTE_PATTERN, ROUTE_REPLACEMENT)

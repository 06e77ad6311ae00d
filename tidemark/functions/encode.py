"""How a typed source value is written into a change envelope."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from tidemark.functions.moments import micros_of


def encoded(value: Column, data_type: T.DataType) -> Column:
    """Decimals as text, which loses nothing; timestamps as microseconds; the rest as it is."""
    if isinstance(data_type, T.DecimalType):
        return value.cast("string")
    if isinstance(data_type, T.TimestampNTZType):
        return micros_of(value)
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(data_type, T.DateType):
        return F.unix_date(value)
    return value

"""Bronze text to typed values. Dirty text becomes NULL; it never aborts the job."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F, types as T

from tidemark.functions.moments import moment_of
from tidemark.model import TableSpec


def typed(text: Column, data_type: T.DataType) -> Column:
    """``text`` as ``data_type``, or NULL. Timestamps arrive as digits of microseconds."""
    if isinstance(data_type, T.TimestampNTZType):
        return moment_of(text.try_cast("bigint"))
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(text.try_cast("bigint"))
    if isinstance(data_type, T.DateType):
        return F.date_from_unix_date(text.try_cast("int"))
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return text
    return text.try_cast(data_type)


def silver_type(spec: TableSpec, column: str) -> T.DataType:
    """The type a column has after cleaning; numbers that the source keeps as text are doubles."""
    override = spec.silver_types.get(column)
    return T.DataType.fromDDL(override) if override else spec.schema[column].dataType


def _broken(spec: TableSpec) -> dict[str, Column]:
    """For each column that may not fit: is its text unreadable, or missing in spite of NOT NULL?"""
    broken = {}
    for name in spec.columns:
        value = typed(F.col(name), silver_type(spec, name))
        if not spec.schema[name].nullable:
            broken[name] = value.isNull()
        elif not isinstance(silver_type(spec, name), (T.StringType, T.VarcharType, T.CharType)):
            broken[name] = F.col(name).isNotNull() & value.isNull()
    return broken


def fits(spec: TableSpec) -> Column:
    """Can every column of the row be read as its type, and is every NOT NULL column there?"""
    return reduce(and_, [~b for b in _broken(spec).values()], F.lit(True))


def cast_failures(spec: TableSpec) -> Column:
    """Names of the columns whose text cannot be read as their type, or is missing in spite of NOT NULL."""
    names = [F.when(broken, F.lit(name)) for name, broken in _broken(spec).items()]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")

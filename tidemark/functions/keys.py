"""Expressions over a table's key columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def all_equal(columns: Sequence[str], left: str, right: str) -> Column:
    """Equality of all ``columns`` between two aliased frames; NULL matches nothing."""
    return reduce(and_, [F.col(f"{left}.{c}") == F.col(f"{right}.{c}") for c in columns])


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Storage bucket of a row.

    ``hash`` is the function Spark shuffles with. After a shuffle on ``keys`` a task
    therefore holds few buckets when the shuffle width and ``buckets`` divide each other.
    """
    return F.pmod(F.hash(*keys), F.lit(buckets))

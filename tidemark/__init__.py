"""Change-data-capture tables on Spark: decode, deduplicate, merge, check, type and aggregate."""

from tidemark.model import TABLES, TableSpec, lookup

__all__ = ["TABLES", "TableSpec", "lookup"]

"""Current-state tables in a catalog whose format supports MERGE (Delta, Iceberg)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.keys import all_equal


class RowLevelTable:
    """The same interface as ``StateTable``, with the MERGE left to the table format.

    ``batch`` is not recorded: a micro-batch that is applied twice gives the same rows, by the
    version test.
    """

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], provider: str = "delta"):
        self.spark = spark
        self.name = name
        self.keys = list(keys)
        self.provider = provider

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def count(self) -> int:
        return self.read().count()

    def overwrite(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> None:
        rows.writeTo(self.name).using(self.provider).createOrReplace()

    def apply(
        self,
        changes: DataFrame,
        mode: str = "upsert",
        guard_deletes: bool = False,
        batch: tuple[str, int] | None = None,
    ) -> bool:
        if not self.exists():
            rows = changes.where(~F.col("is_deleted")).drop("is_deleted")
            rows.writeTo(self.name).using(self.provider).create()
            return True
        if mode == "upsert":
            changes = changes.where(~F.col("is_deleted"))
        newer = F.col("new.cdc_timestamp_ms") >= F.col(f"{self.name}.cdc_timestamp_ms")
        deleted = F.col("new.is_deleted")
        columns = {c: F.col(f"new.{c}") for c in changes.columns if c != "is_deleted"}
        (
            changes.alias("new")
            .mergeInto(self.name, all_equal(self.keys, self.name, "new"))
            .whenMatched(deleted & newer if guard_deletes else deleted)
            .delete()
            .whenMatched(~deleted & newer)
            .update(columns)
            .whenNotMatched(~deleted)
            .insert(columns)
            .merge()
        )
        return True

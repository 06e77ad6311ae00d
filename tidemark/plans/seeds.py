"""The seed load: one CSV per table, in the order that references ask for, with counts compared."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.model import TABLES, TableSpec
from tidemark.operators.quality import surrogate_key
from tidemark.session import new_folder, small_frame
from tidemark.sources import files
from tidemark.sources.csv import read_csv


@dataclass(frozen=True)
class Seed:
    """A table's file. ``generated`` names a key column that the file lacks; rows are numbered 1, 2, 3 …

    ``split`` lets many tasks read a large file; its rows are then numbered in another order than theirs.
    """

    table: str
    file: str
    generated: str | None = None
    split: bool = False


# The public data set's file of each table. Tables that others refer to come first.
SEEDS = (
    Seed("product_category_name_translation", "product_category_name_translation.csv"),
    Seed("customers", "olist_customers_dataset.csv"),
    Seed("sellers", "olist_sellers_dataset.csv"),
    Seed("products", "olist_products_dataset.csv"),
    Seed("orders", "olist_orders_dataset.csv"),
    Seed("order_items", "olist_order_items_dataset.csv"),
    Seed("order_payments", "olist_order_payments_dataset.csv"),
    Seed("order_reviews", "olist_order_reviews_dataset.csv"),
    Seed("geolocation", "olist_geolocation_dataset.csv", generated="geolocation_id"),
)

REPORT = "load_order INT, table_name STRING, status STRING, file_rows BIGINT, stored_rows BIGINT, error STRING"


def check_order(seeds: Sequence[Seed], tables: Mapping[str, TableSpec]) -> None:
    """A table must come after every table of the list that it refers to."""
    seen: set[str] = set()
    listed = {s.table for s in seeds}
    for seed in seeds:
        early = {r.parent for r in tables[seed.table].references} & listed - seen
        if early:
            raise ValueError(f"{seed.table} comes before {sorted(early)}, to which it refers")
        seen.add(seed.table)


def load_seed(spark: SparkSession, seed: Seed, spec: TableSpec, folder: str, landing: str) -> dict:
    """Land one file as text; rows are counted as they leave the file, and once more where they were stored."""
    rows = read_csv(spark, files.join(folder, seed.file), spec, split=seed.split)
    if rows is None:
        return {"status": "MISSING"}
    counted = Observation()
    rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    target = files.join(landing, seed.table)
    if seed.generated:
        # Numbers follow the place in the stored file, so they need the rows to be stored first.
        staged = new_folder(spark, f"seed-{seed.table}")
        rows.write.parquet(staged)
        numbered = surrogate_key(spark, staged, seed.generated)
        text = numbered.withColumn(seed.generated, F.col(seed.generated).cast("string"))
        text.select([c for c in spec.columns if c in text.columns]).write.mode("overwrite").parquet(target)
        files.delete(spark, staged)
    else:
        rows.write.mode("overwrite").parquet(target)
    stored = spark.read.parquet(target).count()
    read = counted.get["rows"]
    return {"status": "LOADED" if read == stored else "DIFFERENT", "file_rows": read, "stored_rows": stored}


def load_seeds(
    spark: SparkSession,
    folder: str,
    landing: str,
    seeds: Sequence[Seed] = SEEDS,
    tables: Mapping[str, TableSpec] = TABLES,
) -> DataFrame:
    """Land all files below ``landing``, a folder for each table, and report on every one.

    A missing or unreadable file is a row of the report and does not stop the others. Loading again
    replaces what was landed.
    """
    check_order(seeds, tables)
    report = []
    for number, seed in enumerate(seeds, 1):
        row = {"load_order": number, "table_name": seed.table, "file_rows": None, "stored_rows": None, "error": None}
        try:
            row |= load_seed(spark, seed, tables[seed.table], folder, landing)
        except Exception as error:  # noqa: BLE001 - the message goes into the report
            row |= {"status": "ERROR", "error": f"{type(error).__name__}: {error}"[:500]}
        report.append(row)
    return small_frame(spark, report, T.StructType.fromDDL(REPORT))

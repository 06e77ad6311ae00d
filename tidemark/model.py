"""Table registry: names, keys, source types and constraints that drive every column list."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, types as T

# Columns that every bronze row has after the business columns.
LINEAGE = (
    "operation_type",
    "cdc_operation",
    "cdc_timestamp_ms",
    "processed_at",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
)


@dataclass(frozen=True)
class Reference:
    """A foreign key: ``columns`` of this table point at ``parent_columns`` of ``parent``."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    """One captured table. ``ddl`` carries names, source types and NOT NULL in Spark DDL."""

    name: str
    keys: tuple[str, ...]
    ddl: str
    checks: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    references: tuple[Reference, ...] = ()
    silver_types: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if not self.keys:
            raise ValueError(f"table {self.name!r} has no key")

    @cached_property
    def schema(self) -> T.StructType:
        schema = T.StructType.fromDDL(self.ddl)
        missing = set(self.keys) - set(schema.names)
        if missing:
            raise ValueError(f"table {self.name!r}: keys {sorted(missing)} are not columns")
        return schema

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def bronze_columns(self) -> list[str]:
        return [*self.columns, *LINEAGE]


def _spec(name: str, keys: str, ddl: str, **more) -> TableSpec:
    return TableSpec(name, tuple(keys.split()), ddl, **more)


# Table names, keys, columns, types and checks of the nine captured
# e-commerce tables. Column spelling is that of the source database. order_reviews has
# no primary key in the source; its key is the one used for deduplication.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        _spec(
            "customers",
            "customer_id",
            """customer_id VARCHAR(100) NOT NULL, customer_unique_id VARCHAR(100) NOT NULL,
               customer_zip_code_prefix VARCHAR(50), customer_city VARCHAR(100),
               customer_state VARCHAR(2)""",
        ),
        _spec(
            "sellers",
            "seller_id",
            """seller_id VARCHAR(100) NOT NULL, seller_zip_code_prefix VARCHAR(50),
               seller_city VARCHAR(100), seller_state VARCHAR(2)""",
        ),
        _spec(
            "products",
            "product_id",
            """product_id VARCHAR(100) NOT NULL, product_category_name VARCHAR(100),
               product_name_lenght VARCHAR(50), product_description_lenght VARCHAR(50),
               product_photos_qty VARCHAR(50), product_weight_g VARCHAR(50),
               product_length_cm VARCHAR(50), product_height_cm VARCHAR(50),
               product_width_cm VARCHAR(50)""",
            references=(
                Reference(
                    ("product_category_name",),
                    "product_category_name_translation",
                    ("product_category_name",),
                ),
            ),
            silver_types={
                "product_name_lenght": "double",
                "product_description_lenght": "double",
                "product_photos_qty": "double",
                "product_weight_g": "double",
                "product_length_cm": "double",
                "product_height_cm": "double",
                "product_width_cm": "double",
            },
        ),
        _spec(
            "orders",
            "order_id",
            """order_id VARCHAR(100) NOT NULL, customer_id VARCHAR(100) NOT NULL,
               order_status VARCHAR(50) NOT NULL, order_purchase_timestamp TIMESTAMP_NTZ NOT NULL,
               order_approved_at TIMESTAMP_NTZ, order_delivered_carrier_date TIMESTAMP_NTZ,
               order_delivered_customer_date TIMESTAMP_NTZ,
               order_estimated_delivery_date TIMESTAMP_NTZ""",
            references=(Reference(("customer_id",), "customers", ("customer_id",)),),
        ),
        _spec(
            "order_items",
            "order_id order_item_id",
            """order_id VARCHAR(100) NOT NULL, order_item_id INT NOT NULL,
               product_id VARCHAR(100) NOT NULL, seller_id VARCHAR(100) NOT NULL,
               shipping_limit_date TIMESTAMP_NTZ NOT NULL, price DECIMAL(10,2) NOT NULL,
               freight_value DECIMAL(10,2) NOT NULL""",
            references=(
                Reference(("order_id",), "orders", ("order_id",)),
                Reference(("product_id",), "products", ("product_id",)),
                Reference(("seller_id",), "sellers", ("seller_id",)),
            ),
        ),
        _spec(
            "order_payments",
            "order_id payment_sequential",
            """order_id VARCHAR(100) NOT NULL, payment_sequential BIGINT NOT NULL,
               payment_type VARCHAR(50) NOT NULL, payment_installments BIGINT NOT NULL,
               payment_value DECIMAL(10,2) NOT NULL""",
            references=(Reference(("order_id",), "orders", ("order_id",)),),
        ),
        _spec(
            "order_reviews",
            "review_id",
            """review_id VARCHAR(100) NOT NULL, order_id VARCHAR(100) NOT NULL,
               review_score INT NOT NULL, review_comment_title STRING,
               review_comment_message STRING, review_creation_date TIMESTAMP_NTZ NOT NULL,
               review_answer_timestamp TIMESTAMP_NTZ""",
            checks={"review_score": lambda score: score.between(1, 5)},
            references=(Reference(("order_id",), "orders", ("order_id",)),),
        ),
        _spec(
            "geolocation",
            "geolocation_id",
            """geolocation_id INT NOT NULL, geolocation_zip_code_prefix VARCHAR(50) NOT NULL,
               geolocation_lat VARCHAR(20) NOT NULL, geolocation_lng VARCHAR(20) NOT NULL,
               geolocation_city VARCHAR(100), geolocation_state VARCHAR(2)""",
            silver_types={"geolocation_lat": "double", "geolocation_lng": "double"},
        ),
        _spec(
            "product_category_name_translation",
            "product_category_name",
            """product_category_name VARCHAR(100) NOT NULL,
               product_category_name_english VARCHAR(100) NOT NULL""",
        ),
    )
}


def lookup(name: str, tables: dict[str, TableSpec] | None = None) -> TableSpec:
    """The spec of ``name``; an unknown table is an error."""
    known = TABLES if tables is None else tables
    if name not in known:
        raise ValueError(f"table {name!r} is not configured; known tables: {', '.join(known)}")
    return known[name]

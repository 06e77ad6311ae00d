"""Change logs derived from the star-schema and event tables, for the registered queries."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.encode import encoded
from tidemark.functions.moments import millis_of
from tidemark.model import TABLES, Reference, TableSpec
from tidemark.operators.capture import snapshot_events
from tidemark.session import new_folder
from tidemark.sources import files
from tidemark.sources.message_log import ROW_GROUP_BYTES, MessageLog

# The second run of the two-run queries starts here.
CUT = "2024-01-30 12:00:00"

USERS = TableSpec(
    "events", ("user_id",), "user_id BIGINT NOT NULL, event_type STRING NOT NULL, value DOUBLE NOT NULL"
)
ORDERS = TableSpec(
    "orders",
    ("o_orderkey",),
    """o_orderkey BIGINT NOT NULL, o_custkey BIGINT NOT NULL, o_orderstatus VARCHAR(1) NOT NULL,
       o_totalprice DECIMAL(10,2) NOT NULL, o_orderdate TIMESTAMP_NTZ NOT NULL,
       o_orderpriority VARCHAR(15)""",
    references=(Reference(("o_custkey",), "customer", ("c_custkey",)),),
)
CUSTOMER = TableSpec(
    "customer",
    ("c_custkey",),
    """c_custkey BIGINT NOT NULL, c_name VARCHAR(18) NOT NULL, c_nationkey INT,
       c_acctbal DECIMAL(10,2), c_mktsegment VARCHAR(9)""",
)
PART = TableSpec(
    "part",
    ("p_partkey",),
    """p_partkey BIGINT NOT NULL, p_name STRING NOT NULL, p_brand STRING, p_type STRING,
       p_size INT, p_retailprice DECIMAL(10,2)""",
)
SUPPLIER = TableSpec(
    "supplier",
    ("s_suppkey",),
    "s_suppkey BIGINT NOT NULL, s_name STRING NOT NULL, s_nationkey INT, s_acctbal DECIMAL(10,2)",
)
LINEITEM = TableSpec(
    "lineitem",
    ("l_orderkey", "l_linenumber"),
    """l_orderkey BIGINT NOT NULL, l_linenumber INT NOT NULL, l_partkey BIGINT NOT NULL,
       l_suppkey BIGINT NOT NULL, l_quantity DECIMAL(10,2) NOT NULL,
       l_extendedprice DECIMAL(10,2) NOT NULL, l_discount DECIMAL(10,2), l_tax DECIMAL(10,2),
       l_returnflag VARCHAR(1), l_linestatus VARCHAR(1), l_shipdate TIMESTAMP_NTZ""",
    checks={"l_quantity": lambda quantity: quantity.between(1, 40)},
    references=(
        Reference(("l_orderkey",), "orders", ("o_orderkey",)),
        Reference(("l_partkey",), "part", ("p_partkey",)),
        Reference(("l_suppkey",), "supplier", ("s_suppkey",)),
    ),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def typed_rows(spark: SparkSession, sf_dir: str, spec: TableSpec) -> DataFrame:
    """A driver table with the column types of its spec."""
    rows = table(spark, sf_dir, spec.name)
    return rows.select(
        *[F.col(f.name).cast(_storage(f.dataType)).alias(f.name) for f in spec.schema.fields]
    )


# Change logs written by this process: (application, tables, name) -> folder.
_WRITTEN: dict[tuple[str, str, str], str] = {}


def _topic(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A change log as a consumer meets it: stored messages, not the plan that made them.

    It is written once per application, to the shared folder, and stands for a topic.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN or not files.exists(spark, _WRITTEN[key]):
        folder = new_folder(spark, f"topic-{name}")
        build().write.option("parquet.block.size", ROW_GROUP_BYTES).option("compression", "zstd").parquet(folder)
        _WRITTEN[key] = folder
    return spark.read.parquet(_WRITTEN[key])


def event_messages(
    spark: SparkSession, sf_dir: str, topic: Column | None = None, value: Column | None = None
) -> DataFrame:
    """The events as changes to one row per user.

    A signup creates, a view reads, an error deletes and the rest update. Every seventh
    update sets the value to NULL. Four partitions by user; the event number is the offset.
    ``topic`` and ``value`` may replace the stored ones; ``event_type``, ``user_id`` and
    ``payload`` are at their disposal.
    """
    stored = _topic(spark, sf_dir, "events", lambda: _event_changes(table(spark, sf_dir, "events")))
    return stored.select(
        (F.lit("events") if topic is None else topic).alias("topic"),
        "partition",
        "offset",
        (F.col("payload") if value is None else value).alias("value"),
        (F.col("ts") < F.lit(CUT).cast("timestamp_ntz")).alias("first_run"),
    )


def _event_changes(events: DataFrame) -> DataFrame:
    op = (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "view", "r")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
    )
    image = F.struct("user_id", "event_type", "value")
    cleared = F.struct("user_id", "event_type", F.lit(None).cast("double").alias("value"))
    after = F.when((op == "u") & (F.col("event_id") % 7 == 0), cleared).when(op != "d", image)
    return events.select(
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        "ts",
        "event_type",
        "user_id",
        _envelope(F.when(op.isin("u", "d"), image), after, op, millis_of(F.col("ts"))).alias("payload"),
    )


def _envelope(before: Column, after: Column, op: Column, ts_ms: Column) -> Column:
    fields = F.struct(
        before.alias("before"), after.alias("after"), op.alias("op"), ts_ms.alias("ts_ms")
    )
    return F.to_json(fields, {"ignoreNullFields": "false"})


def lineitem_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a change to its (order, line); later ship dates are newer versions."""

    def changes() -> DataFrame:
        rows = typed_rows(spark, sf_dir, LINEITEM)
        image = F.struct(*[encoded(F.col(f.name), f.dataType).alias(f.name) for f in rows.schema])
        op = F.when(F.col("l_returnflag") == "R", "d").otherwise("u")
        version = millis_of(F.col("l_shipdate"))
        return rows.select(
            F.lit("lineitem").alias("topic"),
            (F.col("l_suppkey") % 4).cast("int").alias("partition"),
            F.col("l_partkey").alias("offset"),
            _envelope(image, F.when(op != "d", image), op, version).alias("value"),
            "l_shipdate",
        )

    return _topic(spark, sf_dir, "lineitem", changes)


def _log(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], Iterable[DataFrame]]
) -> MessageLog:
    """Several topics in one stored log, written once per application like ``_topic``."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN or not files.exists(spark, _WRITTEN[key]):
        log = MessageLog(new_folder(spark, f"log-{name}"))
        for messages in build():
            log.write(messages)
        _WRITTEN[key] = log.path
    return MessageLog(_WRITTEN[key])


SNAPSHOTS = (ORDERS, CUSTOMER, PART, SUPPLIER)


def snapshot_log(spark: SparkSession, sf_dir: str) -> MessageLog:
    """The initial snapshots of four driver tables, a topic each."""

    def build() -> Iterable[DataFrame]:
        for spec in SNAPSHOTS:
            rows = typed_rows(spark, sf_dir, spec)
            yield snapshot_events(rows, spec.keys, spec.name, ts_ms=F.lit(1))

    return _log(spark, sf_dir, "snapshots", build)


def shop_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine captured e-commerce tables, filled from the driver's tables.

    Line items repeat some (order, line) pairs: the later shipping date is the newer version.
    """
    epoch = "TIMESTAMP_NTZ '2020-01-01 00:00:00'"
    sql = {
        "customers": (
            "customer",
            """c_custkey, c_name, lpad(c_nationkey, 5, '0'), c_mktsegment, lpad(c_nationkey, 2, '0')""",
        ),
        "sellers": (
            "supplier",
            """s_suppkey, lpad(s_nationkey, 5, '0'), s_name, lpad(s_nationkey, 2, '0')""",
        ),
        "products": (
            "part",
            """p_partkey, p_type, length(p_name), length(p_brand), p_size,
               CAST(p_retailprice AS DECIMAL(10,2)), p_size, p_size + 1, p_size + 2""",
        ),
        "orders": (
            "orders",
            """o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderdate + INTERVAL 1 HOUR,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 2 DAY END,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 9 DAY END,
               o_orderdate + INTERVAL 14 DAY""",
        ),
        "order_items": (
            "lineitem",
            """l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity""",
        ),
        "order_payments": ("orders", "o_orderkey, 1, o_orderpriority, 1, o_totalprice"),
        "order_reviews": (
            "documents",
            f"""doc_id, doc_id, 1 + n_chars % 5, source, text, {epoch}, NULL""",
        ),
        "geolocation": (
            "events",
            """event_id, lpad(user_id, 5, '0'), CAST(value AS DECIMAL(10,2)), user_id, event_type, NULL""",
        ),
        "product_category_name_translation": ("region", "r_name, lower(r_name)"),
    }
    shop = {}
    for name, (source, columns) in sql.items():
        fields = TABLES[name].schema.fields
        picked = spark.sql(f"SELECT {columns} FROM {{src}}", src=table(spark, sf_dir, source))
        named = picked.toDF(*[f.name for f in fields])
        shop[name] = named.select(
            *[F.col(f.name).cast(_storage(f.dataType)).alias(f.name) for f in fields]
        )
    return shop


def _storage(data_type: T.DataType) -> T.DataType:
    """VARCHAR is a declaration; rows hold strings."""
    return T.StringType() if isinstance(data_type, T.VarcharType) else data_type


def shop_log(spark: SparkSession, sf_dir: str) -> MessageLog:
    """The initial snapshots of the nine shop tables, a topic each."""

    def build() -> Iterable[DataFrame]:
        for name, rows in shop_tables(spark, sf_dir).items():
            version, offset = F.lit(1), None
            if name == "order_items":
                version = millis_of(F.col("shipping_limit_date"))
                offset = F.col("product_id").cast("bigint")
            yield snapshot_events(rows, TABLES[name].keys, name, ts_ms=version, offset=offset)

    return _log(spark, sf_dir, "shop", build)

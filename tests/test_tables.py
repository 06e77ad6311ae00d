import pytest
from conftest import values
from pyspark.sql import functions as F

from tidemark.functions.typed import typed
from tidemark.model import LINEAGE, TABLES, TableSpec, lookup
from tidemark.plans.gold import totals_by_window
from tidemark.plans.silver import silver, silver_rejects
from tidemark.session import new_folder, shared_folder
from tidemark.sources.catalog import register
from tidemark.sources.csv import load_csv, read_csv
from tidemark.sources.jdbc import jdbc_options
from tidemark.sources.kafka import KafkaSource
from tidemark.sources.row_level import RowLevelTable


def test_registry(spark):
    assert len(TABLES) == 9
    assert lookup("order_items").keys == ("order_id", "order_item_id")
    assert TABLES["customers"].bronze_columns[-len(LINEAGE) :] == list(LINEAGE)
    for spec in TABLES.values():
        assert set(spec.keys) <= set(spec.columns)
    with pytest.raises(ValueError, match="suppliers"):
        lookup("suppliers")
    with pytest.raises(ValueError):
        TableSpec("t", ("x",), "id INT").schema
    with pytest.raises(ValueError):
        TableSpec("t", (), "id INT")


def test_text_becomes_typed_or_null(spark):
    types = TableSpec("t", ("i",), "i INT, n BIGINT, d DECIMAL(10,2), x DOUBLE, t TIMESTAMP_NTZ").schema
    df = spark.createDataFrame(
        [("5", "6", "12.345", "40.0", "1506933600000000"), ("40.0", "x", "1e9", "", "2017-10-02")],
        "i STRING, n STRING, d STRING, x STRING, t STRING",
    )
    rows = df.select(*[typed(F.col(f.name), f.dataType).cast("string").alias(f.name) for f in types]).collect()
    assert tuple(rows[0]) == ("5", "6", "12.35", "40.0", "2017-10-02 08:40:00")
    assert tuple(rows[1]) == (None,) * 5


def test_largest_timestamp_does_not_abort(spark):
    df = spark.createDataFrame([(str(2**63 - 1),), (str(-(2**63)),), ("9" * 30,)], "t STRING")
    spec = TableSpec("t", ("t",), "t TIMESTAMP_NTZ")
    got = df.select(typed(F.col("t"), spec.schema["t"].dataType).isNotNull()).collect()
    assert [r[0] for r in got][2] is False


def test_silver_separates_rows_that_do_not_fit(spark):
    spec = TABLES["products"]
    rows = [("p1", "toys", "40.0"), ("p2", "toys", "heavy"), ("p3", None, None)]
    df = spark.createDataFrame(rows, "product_id STRING, product_category_name STRING, product_weight_g STRING")
    for c in spec.columns:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    assert values(silver(df, spec), "product_id", "product_weight_g") == [("p1", 40.0), ("p3", None)]
    rejects = silver_rejects(df, spec).collect()
    assert [(r.product_id, r.cast_failures) for r in rejects] == [("p2", ["product_weight_g"])]


def test_totals_by_window(spark):
    df = spark.sql(
        """SELECT CAST(at AS TIMESTAMP_NTZ) AS at, g, CAST(x AS DECIMAL(10,2)) AS x FROM VALUES
           ('2024-01-01 00:00:00', 'a', 1), ('2024-01-01 23:59:59', 'a', 2),
           ('2024-01-02 00:00:00', 'a', 5), ('2024-01-01 10:00:00', 'b', NULL) AS t(at, g, x)"""
    )
    got = totals_by_window(df, "at", "x", by=["g"]).selectExpr(
        "CAST(window_start AS STRING)", "g", "n_values", "CAST(total AS DOUBLE)", "average"
    )
    assert values(got) == [
        ("2024-01-01 00:00:00", "a", 2, 3.0, 1.5),
        ("2024-01-01 00:00:00", "b", 0, None, None),
        ("2024-01-02 00:00:00", "a", 1, 5.0, 5.0),
    ]


def test_csv(spark, tmp_path):
    spec = TABLES["customers"]
    path = tmp_path / "customers.csv"
    path.write_text(
        '"customer_id","customer_unique_id","customer_zip_code_prefix","customer_city","customer_state"\n'
        'c1,u1,01310,"são paulo, centro",SP\n'
        'c2,u2,,"line\nbreak and ""quotes""",\n',
        encoding="utf-8",
    )
    rows = values(read_csv(spark, str(path), spec))
    assert rows == [
        ("c1", "u1", "01310", "são paulo, centro", "SP"),
        ("c2", "u2", None, 'line\nbreak and "quotes"', None),
    ]
    landing = str(tmp_path / "landing")
    assert load_csv(spark, str(path), spec, landing) == 2
    assert load_csv(spark, str(path), spec, landing) == 4
    assert load_csv(spark, str(tmp_path / "missing.csv"), spec, landing) is None


def test_csv_without_the_generated_key(spark, tmp_path):
    path = tmp_path / "geo.csv"
    path.write_text("geolocation_zip_code_prefix,geolocation_lat\n01037,-23.5\n")
    df = read_csv(spark, str(path), TABLES["geolocation"])
    assert df.columns == ["geolocation_zip_code_prefix", "geolocation_lat"]


def test_register_creates_then_refreshes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    register(spark, "shelf", "t", path)
    spark.range(3, 5).write.mode("append").parquet(path)
    register(spark, "shelf", "t", path)
    assert spark.sql("SELECT count(*) FROM shelf.t").first()[0] == 5


def test_kafka_options():
    source = KafkaSource("broker:9092", min_partitions=64)
    options = source.batch_options("orders", {1: 5, 0: 3}, {0: 9, 1: 9})
    assert options["startingOffsets"] == '{"orders": {"0": 3, "1": 5}}'
    assert options["endingOffsets"] == '{"orders": {"0": 9, "1": 9}}'
    assert options["minPartitions"] == "64"
    assert source.batch_options("orders")["startingOffsets"] == "earliest"
    stream = source.stream_options(["a", "b"], max_offsets=500, fail_on_data_loss=False)
    assert stream["subscribe"] == "a,b"
    assert (stream["maxOffsetsPerTrigger"], stream["failOnDataLoss"]) == ("500", "false")


def test_jdbc_options():
    options = jdbc_options("jdbc:postgresql://db/shop", "orders", user="u")
    assert options == {"url": "jdbc:postgresql://db/shop", "dbtable": "orders", "batchsize": "1000", "user": "u"}


def test_working_folder_is_the_shared_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_merge_of_a_row_level_table_is_left_to_its_format(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shelf")
    table = RowLevelTable(spark, "shelf.plain", ["id"], provider="parquet")
    df = spark.sql("SELECT 'a' AS id, 1L AS cdc_timestamp_ms, false AS is_deleted")
    assert table.apply(df)
    assert table.exists() and table.count() == 1
    # Parquet has no MERGE; the statement is complete up to that point.
    with pytest.raises(Exception, match="(?i)merge"):
        table.apply(df, "upsert_delete", guard_deletes=True)


class _Session:
    """Only what the folder lookup asks for."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: folder)})()


def test_only_a_local_session_may_use_a_temporary_folder():
    assert shared_folder(_Session("spark://host", "hdfs://shared")) == "hdfs://shared"
    assert shared_folder(_Session("local[2]")) == shared_folder(_Session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn"))


def test_typing_stays_in_generated_code(spark, tmp_path):
    spec = TABLES["order_items"]
    df = spark.createDataFrame([], ", ".join(f"{c} STRING" for c in spec.columns))
    df.write.parquet(str(tmp_path / "t"))
    plan = silver(spark.read.parquet(str(tmp_path / "t")), spec)._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in plan.splitlines() if "Project [" in line or "Filter (" in line]
    assert steps and all("*(" in line for line in steps)

import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def envelope(op, before=None, after=None, ts_ms=1):
    return json.dumps({"before": before, "after": after, "op": op, "ts_ms": ts_ms})


@pytest.fixture
def messages(spark):
    """Build messages from (topic, partition, offset, value) tuples."""

    def build(rows):
        return spark.createDataFrame(
            rows, "topic STRING, partition INT, offset BIGINT, value STRING"
        )

    return build


@pytest.fixture
def changes(spark):
    """Build decoded changes from (id, v, ts, offset, is_deleted) tuples."""

    def build(rows):
        df = spark.createDataFrame(
            rows,
            "id STRING, v STRING, cdc_timestamp_ms BIGINT, kafka_offset BIGINT, is_deleted BOOLEAN",
        )
        return df.selectExpr("*", "0 AS kafka_partition")

    return build


def values(df, *columns):
    """Rows as a sorted list of tuples."""
    rows = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()

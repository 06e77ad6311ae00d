"""Make tables visible to SQL users of the session's catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.sources import files
from tidemark.sources.state_table import BUCKET, StateTable


def _quoted(*names: str) -> str:
    return ".".join(f"`{n}`" for n in names)


def register(
    spark: SparkSession, database: str, table: str, path: str, provider: str = "parquet"
) -> None:
    """An external table over ``path``.

    One that is already there is refreshed; if ``path`` or the columns written there are others by
    now, it is declared again.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    name = _quoted(database, table)
    if spark.catalog.tableExists(name):
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
        if files.same(spark, described["data_type"], path):
            spark.sql(f"REFRESH TABLE {name}")
            declared = {(f.name.lower(), f.dataType) for f in spark.table(name).schema}
            if declared == {(f.name.lower(), f.dataType) for f in spark.read.format(provider).load(path).schema}:
                return
        spark.sql(f"DROP TABLE {name}")  # external: the files stay
    spark.sql(f"CREATE TABLE {name} USING {provider} LOCATION '{path}'")


def publish(spark: SparkSession, database: str, table: str, state: StateTable) -> None:
    """Show a state table's newest snapshot as the view ``table``.

    Each snapshot gets an external table of its own over the files as they lie, with all buckets
    named in one statement; the view then moves to it at once, with whatever columns it has. So a
    reader sees one commit, the old one or the new one. The table of the commit before stays for
    readers that have begun; older ones are dropped, without their files.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    snapshot = state.snapshot()
    name, prefix = _quoted(database, table), f"{table}_at_"
    version = _quoted(database, f"{prefix}{snapshot.number}")
    spark.sql(f"DROP TABLE IF EXISTS {version}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in snapshot.schema)
    spark.sql(
        f"CREATE TABLE {version} ({columns}, `{BUCKET}` INT) USING parquet "
        f"PARTITIONED BY (`{BUCKET}`) LOCATION '{files.join(state.path, 'published')}'"
    )
    places = " ".join(f"PARTITION (`{BUCKET}`={b}) LOCATION '{p}'" for b, p in state.locations(snapshot.number).items())
    if places:
        spark.sql(f"ALTER TABLE {version} ADD {places}")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # external, by its own name
    listed = ", ".join(f"`{c}`" for c in snapshot.schema.names)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} FROM {version}")
    shown = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {_quoted(database)} LIKE '{prefix}*'").collect()]
    numbers = sorted(int(n[len(prefix) :]) for n in shown if n[len(prefix) :].isdigit())
    for number in numbers[: max(0, numbers.index(snapshot.number) - 1)]:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(database, f'{prefix}{number}')}")

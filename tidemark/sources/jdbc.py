"""Write rows to a database over JDBC, in batches. Needs the database's driver."""

from __future__ import annotations

from pyspark.sql import DataFrame

BATCH_ROWS = 1000


def jdbc_options(url: str, table: str, batch_rows: int = BATCH_ROWS, **more: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows), **more}


def write_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = BATCH_ROWS, **more: str) -> None:
    """Each task inserts its partition in batches and commits once, so a failed task leaves nothing."""
    df.write.format("jdbc").options(**jdbc_options(url, table, batch_rows, **more)).mode("append").save()

"""Session defaults and the shared working folder."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.sources import files

SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Turn on adaptive execution in the caller's session; sizes and parallelism stay the caller's."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors see")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return files.join(shared_folder(spark), "tidemark", f"{purpose}-{uuid.uuid4().hex}")


def small_frame(spark: SparkSession, rows: Sequence[dict], schema: T.StructType) -> DataFrame:
    """A few driver-side rows as a DataFrame, without starting a Python worker for them."""
    text = F.lit(json.dumps(list(rows)))
    return spark.range(1).select(F.inline(F.from_json(text, T.ArrayType(schema))))

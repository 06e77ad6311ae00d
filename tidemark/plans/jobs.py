"""Full and incremental loads of captured tables into their current state."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.model import TableSpec
from tidemark.operators.decode import decode_changes, split_dead_letters
from tidemark.operators.latest import latest_per_key
from tidemark.operators.offsets import plan_slice
from tidemark.operators.totals import RUN_LOG
from tidemark.session import new_folder, small_frame
from tidemark.sources import files
from tidemark.sources.catalog import publish
from tidemark.sources.offset_log import OffsetLog
from tidemark.sources.row_level import RowLevelTable
from tidemark.sources.state_table import StateTable


class DataLoss(RuntimeError):
    """The source no longer holds messages that come after the saved position."""


@dataclass(frozen=True)
class Bronze:
    """Where bronze tables live and how changes are applied.

    The defaults give the plain behaviour of a load: images merged per column, deletes of a
    later run not applied, malformed payloads kept. ``dead_letters`` names a folder that
    receives rows without key or with an unknown operation instead (read it with ``dead_letters``). ``database`` publishes each table there.

    ``fail_on_data_loss`` fails a run whose next messages expired unread; otherwise the run log
    says how many they were.

    ``keep_snapshots`` expires older ones after each run; None keeps all.

    ``row_level`` names a ``catalog.database`` whose tables, of format ``provider``, support
    MERGE; they then take the place of the state tables below ``root``.
    """

    root: str
    buckets: int | None = None
    mode: str = "upsert"
    image_policy: str = "coalesce"
    guard_deletes: bool = False
    dead_letters: str | None = None
    database: str | None = None
    row_level: str | None = None
    provider: str = "delta"
    keep_snapshots: int | None = None
    fail_on_data_loss: bool = True

    @property
    def offsets_path(self) -> str:
        return files.join(self.root, "_offsets")

    def table(self, spark: SparkSession, spec: TableSpec) -> StateTable | RowLevelTable:
        if self.row_level:
            name = f"{self.row_level}.{spec.name}"
            return RowLevelTable(spark, name, spec.keys, self.provider)
        return StateTable(spark, files.join(self.root, spec.name), spec.keys, self.buckets)


# The payload next to a table's own columns, one of which may be called ``value``.
_PAYLOAD = "_payload"
_POSITION = ["kafka_topic", "kafka_partition", "kafka_offset"]


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """The messages that could not be applied, each once, with their payload and the reason.

    Slices of a table may overlap after a reset, so a position counts once.
    """
    return spark.read.parquet(path).dropDuplicates(["table", *_POSITION])


def _part_name(changes: DataFrame, batch: tuple[str, int] | None) -> str:
    """The name under which a slice keeps its dead letters: the same for the same slice."""
    if batch:
        return f"{batch[0]}-{batch[1]}"
    ends = changes.groupBy("kafka_partition").agg(F.min("kafka_offset").alias("lo"), F.max("kafka_offset").alias("hi"))
    span = [(r["kafka_partition"], r["lo"], r["hi"]) for r in ends.collect()]  # one row per partition
    return f"slice-{hashlib.sha256(repr(sorted(span)).encode()).hexdigest()[:16]}"


def _without_dead_letters(
    spark: SparkSession, changes: DataFrame, spec: TableSpec, path: str, batch: tuple[str, int] | None
) -> tuple[DataFrame, str]:
    """The changes that can be applied, and the folder they are staged in.

    The slice is decoded once, into the folder; both outputs read that. The dead letters go to a
    folder of the slice's own name, which a repetition overwrites; what others left is not read.
    """
    staged_at = new_folder(spark, "decoded")
    changes.write.parquet(staged_at)
    staged = spark.read.schema(changes.schema).parquet(staged_at)
    good, dead = split_dead_letters(staged, spec.keys)
    target = files.join(path, f"table={spec.name}", f"slice={_part_name(staged, batch)}")
    dead.select(*_POSITION, F.col(_PAYLOAD).alias("value"), "reason").write.mode("overwrite").parquet(target)
    return good.drop(_PAYLOAD), staged_at


def apply_messages(
    spark: SparkSession,
    messages: DataFrame,
    spec: TableSpec,
    bronze: Bronze,
    batch: tuple[str, int] | None = None,
) -> StateTable | RowLevelTable:
    """Decode, keep the latest change per key, and apply it to the table."""
    table = bronze.table(spark, spec)
    split = bronze.dead_letters is not None
    changes = decode_changes(messages, spec.columns, bronze.image_policy, keep_value=_PAYLOAD if split else False)
    staged_at = None
    if split:
        changes, staged_at = _without_dead_letters(spark, changes, spec, bronze.dead_letters, batch)
    try:
        table.apply(
            latest_per_key(changes, spec.keys), bronze.mode, bronze.guard_deletes, batch=batch
        )
    finally:
        if staged_at:
            files.delete(spark, staged_at)
    if isinstance(table, StateTable):
        if bronze.database:
            publish(spark, bronze.database, spec.name, table)
        if bronze.keep_snapshots:
            table.expire(bronze.keep_snapshots)
    return table


def _load(
    spark: SparkSession, spec: TableSpec, source, bronze: Bronze, start: dict[int, int] | None
) -> dict:
    """One run over one table, from ``start`` to the end of the topic as of now.

    Start and end of every partition come from the source's own bounds before any message is
    read; the one scan that follows counts the messages as they pass. The position is saved
    last: a crash before that repeats the slice, which the version test of the merge absorbs.
    """
    piece = plan_slice(source.bounds(spark, spec.name), start)
    if piece.lost and bronze.fail_on_data_loss:
        raise DataLoss(f"{spec.name}: never read and gone (partition, from, to): {piece.lost}")
    if piece.empty:
        return {"status": "SKIPPED", "kafka_messages": 0, "final_records": 0, "lost_messages": piece.lost_messages}
    passed = Observation()
    messages = source.read(spark, spec.name, start=piece.start, end=piece.end)
    messages = messages.observe(passed, F.count(F.lit(1)).alias("messages"))
    table = apply_messages(spark, messages, spec, bronze)
    OffsetLog(spark, bronze.offsets_path).save(spec.name, piece.end)
    return {
        "status": "SUCCESS",
        "kafka_messages": passed.get["messages"],
        "final_records": table.count(),
        "lost_messages": piece.lost_messages,
    }


def run_full(spark: SparkSession, spec: TableSpec, source, bronze: Bronze) -> dict:
    """Read the whole topic."""
    return _logged(spec, lambda: _load(spark, spec, source, bronze, start=None))


def run_incremental(
    spark: SparkSession, spec: TableSpec, source, bronze: Bronze, reset: bool = False
) -> dict:
    """Read what is new since the last saved position; ``reset`` starts from the beginning."""

    def load() -> dict:
        start = None if reset else OffsetLog(spark, bronze.offsets_path).last(spec.name)
        return _load(spark, spec, source, bronze, start)

    return _logged(spec, load)


def _logged(spec: TableSpec, load: Callable[[], dict]) -> dict:
    """A run log row. An error is recorded, so that the other tables still run."""
    began = time.monotonic()
    row = {"kafka_messages": None, "final_records": None, "lost_messages": None, "error": None}
    try:
        row.update(load())
    except Exception as error:  # noqa: BLE001 - the message goes into the run log
        row.update(status="ERROR", error=f"{type(error).__name__}: {error}")
    return {"table": spec.name, **row, "processing_time": time.monotonic() - began}


def run_tables(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    run: Callable[[TableSpec], dict],
    at_once: int = 4,
) -> DataFrame:
    """Run several tables and return the run log. Small tables fill the gaps of large ones."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(run), specs))
    return run_log(spark, rows)


def run_log(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    return small_frame(spark, rows, T.StructType.fromDDL(RUN_LOG))

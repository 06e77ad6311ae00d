"""Current-state tables on plain Parquet, for sessions without a row-level table format.

Rows are spread over hash buckets of their key. A commit writes the buckets it touches to a
new folder and then publishes one small snapshot file that says which folder holds each
bucket. Readers follow the newest snapshot, so they see a commit as a whole or not at all,
and a failed job leaves folders that nothing points at. Old snapshots stay until ``expire``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.keys import bucket_of
from tidemark.operators.merge import merge
from tidemark.session import new_folder
from tidemark.sources import files

BUCKET = "bucket"


class CommitConflict(RuntimeError):
    """Another writer committed since the table was read."""


@dataclass(frozen=True)
class Snapshot:
    number: int
    keys: list[str]
    buckets: int
    schema: T.StructType
    folders: dict[int, str]  # bucket -> commit folder
    batches: dict[str, int]  # stream -> last micro-batch applied


def _widened(schema: T.StructType, changes: T.StructType) -> T.StructType:
    """The table's columns, then those that the changes bring along."""
    added = [f for f in changes.fields if f.name not in schema.names and f.name != "is_deleted"]
    return T.StructType([*schema.fields, *added])


class StateTable:
    """One row per key.

    ``buckets`` counts when the table is created, and stays: about table size divided by the
    amount that a merge may rewrite per touched key, at most a few ten thousand. By default it
    is the session's shuffle width.

    ``form`` is the merge's. By default it is ``split`` for changes that Catalyst may broadcast, so
    that no row of the table is shuffled, and ``outer`` for larger ones, so that each side is
    shuffled once; the rows are the same.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        buckets: int | None = None,
        form: str | None = None,
    ):
        self.spark = spark
        self.path = path
        self.keys = list(keys)
        self.buckets = buckets
        self.form = form

    # -- reading -------------------------------------------------------------------------

    def snapshot(self) -> Snapshot | None:
        names = self._names()
        if not names:
            return None
        newest = self._load(names[-1])
        if newest.keys != self.keys:
            raise ValueError(f"{self.path} has the key {newest.keys}, not {self.keys}")
        return newest

    def _names(self) -> list[str]:
        return [n for n in files.names(self.spark, self._snapshots) if not n.startswith(".")]

    @staticmethod
    def _name(number: int) -> str:
        return f"{number:09d}.json"

    def _load(self, name: str) -> Snapshot:
        content = json.loads(files.read_text(self.spark, files.join(self._snapshots, name)))
        return Snapshot(
            number=content["number"],
            keys=content["keys"],
            buckets=content["buckets"],
            schema=T.StructType.fromJson(content["schema"]),
            folders={int(b): folder for b, folder in content["folders"].items()},
            batches=content["batches"],
        )

    def exists(self) -> bool:
        return self.snapshot() is not None

    def read(self) -> DataFrame:
        return self._read(self._current())

    def count(self) -> int:
        """Read from the Parquet footers; no column is scanned."""
        return self.read().count()

    def locations(self, number: int | None = None) -> dict[int, str]:
        """Folder of each bucket in the newest snapshot, or in an older one that still exists."""
        if number is None:
            folders = self._current().folders
        else:
            name = self._name(number)
            folders = self._load(name).folders if name in self._names() else {}
        return {b: self._folder(f, b) for b, f in folders.items()}

    def _current(self) -> Snapshot:
        current = self.snapshot()
        if current is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return current

    def _read(
        self, snapshot: Snapshot, buckets: set[int] | None = None, schema: T.StructType | None = None
    ) -> DataFrame:
        """``schema`` may add columns; rows written before them read as NULL there."""
        schema = schema or snapshot.schema
        paths = [
            self._folder(folder, bucket)
            for bucket, folder in sorted(snapshot.folders.items())
            if buckets is None or bucket in buckets
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # -- writing -------------------------------------------------------------------------

    def overwrite(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> None:
        """Replace the whole content."""
        current = self.snapshot()
        buckets = current.buckets if current else self.buckets or self._shuffle_width()
        everything = set(range(buckets))
        if buckets % self._shuffle_width() == 0:
            # Buckets are cut from the hash of a shuffle on the key, so each is in one task after it. Rows
            # that were shuffled so, as ``latest_per_key`` leaves them, are not shuffled again.
            placed = rows.repartition(*self.keys)
        else:
            placed = self._by_bucket(rows, buckets)
        self._commit(placed, buckets, everything, current, batch)

    def apply(
        self,
        changes: DataFrame,
        mode: str = "upsert",
        guard_deletes: bool = False,
        batch: tuple[str, int] | None = None,
        staged_at: str | None = None,
    ) -> bool:
        """Merge the latest change of each key (rows carry ``is_deleted``), or create the table.

        ``batch`` is (stream, micro-batch number): a micro-batch that was already committed
        is not applied again. ``staged_at`` names the Parquet folder that ``changes`` were read from, if
        the caller has staged them; it stays. Returns whether anything was applied.
        """
        current = self.snapshot()
        if current is None:
            self.overwrite(changes.where(~F.col("is_deleted")).drop("is_deleted"), batch)
            return True
        if batch and current.batches.get(batch[0], -1) >= batch[1]:
            return False
        # The merge needs the changes several times. A written table survives the loss of an
        # executor, and its size lets Catalyst choose the join.
        own = None if staged_at else new_folder(self.spark, "changes")
        try:
            if own:
                changes.write.parquet(own)
            staged = self.spark.read.schema(changes.schema).parquet(own) if own else changes
            buckets = current.buckets
            in_bucket = bucket_of(self.keys, buckets)
            touched = {r[0] for r in staged.select(in_bucket).distinct().collect()}  # <= buckets
            target = self._read(current, touched, _widened(current.schema, changes.schema))
            form = self.form or ("split" if self._broadcasts(own or staged_at) else "outer")
            merged = merge(target, staged, self.keys, mode, guard_deletes, form)
            self._commit(self._by_bucket(merged, buckets), buckets, touched, current, batch)
        finally:
            if own:
                files.delete(self.spark, own)
        return True

    def expire(self, keep: int = 2) -> None:
        """Drop all but the ``keep`` newest snapshots, and the folders only those used.

        Folders that no snapshot names may belong to a running commit and stay.
        """
        names = self._names()
        old, kept = names[:-keep], names[-keep:]
        used = {item for n in kept for item in self._load(n).folders.items()}
        unused = {item for n in old for item in self._load(n).folders.items()} - used
        for bucket, folder in unused:
            files.delete(self.spark, self._folder(folder, bucket))
        for name in old:
            files.delete(self.spark, files.join(self._snapshots, name))

    def _by_bucket(self, rows: DataFrame, buckets: int) -> DataFrame:
        """A bucket's rows meet in one task, so a small bucket is one file; a large one is split."""
        return rows.withColumn(BUCKET, bucket_of(self.keys, buckets)).hint("rebalance", F.col(BUCKET)).drop(BUCKET)

    def _commit(
        self,
        rows: DataFrame,
        buckets: int,
        touched: set[int],
        current: Snapshot | None,
        batch: tuple[str, int] | None,
    ) -> None:
        number = current.number + 1 if current else 0
        folder = f"{number:09d}-{uuid.uuid4().hex}"
        target = files.join(self.path, "data", folder)
        rows.withColumn(BUCKET, bucket_of(self.keys, buckets)).write.partitionBy(BUCKET).parquet(target)
        written = {
            int(name.split("=")[1])
            for name in files.names(self.spark, target)
            if name.startswith(f"{BUCKET}=")
        }
        kept = current.folders if current else {}
        content = {
            "number": number,
            "keys": self.keys,
            "buckets": buckets,
            "schema": json.loads(rows.schema.json()),
            "folders": {
                **{str(b): f for b, f in kept.items() if b not in touched},
                **{str(b): folder for b in written},
            },
            "batches": {**(current.batches if current else {}), **(dict([batch]) if batch else {})},
        }
        path = files.join(self._snapshots, self._name(number))
        if not files.publish_text(self.spark, path, json.dumps(content)):
            raise CommitConflict(f"snapshot {number} of {self.path} already exists")

    def _broadcasts(self, path: str) -> bool:
        limit = self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        return files.size(self.spark, path) <= limit

    def _shuffle_width(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    @property
    def _snapshots(self) -> str:
        return files.join(self.path, "snapshots")

    def _folder(self, commit: str, bucket: int) -> str:
        return files.join(self.path, "data", commit, f"{BUCKET}={bucket}")

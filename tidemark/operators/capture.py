"""Change events from table contents: an initial snapshot, or the difference of two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.encode import encoded
from tidemark.functions.keys import all_equal, bucket_of


def _image(df: DataFrame, alias: str | None = None) -> Column:
    prefix = f"{alias}." if alias else ""
    return F.struct(
        *[encoded(F.col(prefix + f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def _events(
    df: DataFrame, topic: str, keys: Sequence[Column], partitions: int, ts_ms: Column, offset: Column
) -> DataFrame:
    """``df`` has ``before``, ``after`` and ``op``; wrap them as messages of ``topic``."""
    envelope = F.struct("before", "after", "op", ts_ms.cast("bigint").alias("ts_ms"))
    return df.select(
        F.lit(topic).alias("topic"),
        F.pmod(F.hash(*keys), F.lit(partitions)).alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"),
    )


def snapshot_events(
    df: DataFrame,
    keys: Sequence[str],
    topic: str,
    ts_ms: Column,
    offset: Column | None = None,
    partitions: int = 4,
) -> DataFrame:
    """A read event for every row. A projection only: nothing is shuffled.

    Without ``offset`` the events get numbers that are unique among them, with gaps;
    ``MessageLog.append`` moves them behind the events that a log holds already.
    """
    image = _image(df)
    rows = df.select(
        "*",
        F.lit(None).cast(df.select(image.alias("i")).schema["i"].dataType).alias("before"),
        image.alias("after"),
        F.lit("r").alias("op"),
    )
    position = F.monotonically_increasing_id() if offset is None else offset
    return _events(rows, topic, [F.col(k) for k in keys], partitions, ts_ms, position)


def diff_events(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    topic: str,
    ts_ms: Column,
    offset: Column | None = None,
    partitions: int = 4,
) -> DataFrame:
    """Create, update and delete events, with both images, that turn ``old`` into ``new``.

    The keys are unique on both sides (``duplicate_keys`` checks that), so the outer join
    pairs each row with at most one other and no key is hot. Unchanged rows give no event.
    Offsets are as in ``snapshot_events``.
    """
    columns = new.columns
    left = old.select(columns).withColumn("_there", F.lit(True)).alias("old")
    right = new.withColumn("_there", F.lit(True)).alias("new")
    pairs = left.join(right, all_equal(keys, "old", "new"), "full_outer")
    created, deleted = F.col("old._there").isNull(), F.col("new._there").isNull()
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    changed = pairs.where(created | deleted | ~same).select(
        *[F.coalesce(f"new.{k}", f"old.{k}").alias(k) for k in keys],
        F.when(~created, _image(new, "old")).alias("before"),
        F.when(~deleted, _image(new, "new")).alias("after"),
        F.when(created, "c").when(deleted, "d").otherwise("u").alias("op"),
    )
    position = F.monotonically_increasing_id() if offset is None else offset
    return _events(changed, topic, [F.col(k) for k in keys], partitions, ts_ms, position)


def bucket_hashes(df: DataFrame, keys: Sequence[str], buckets: int = 4096) -> DataFrame:
    """``bucket``, ``n_rows`` and two hashes of all rows of a bucket of the key, in whatever order they lie.

    One row per bucket: what is shuffled does not grow with the rows. The hashes of a snapshot may
    be stored with it, so that the next comparison need not read it.
    """
    # A hash passes over NULLs, so the flags tell which columns they are in.
    row = [F.col(c) for c in df.columns] + [F.col(c).isNull() for c in df.columns]
    return df.groupBy(bucket_of(keys, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bit_xor(F.xxhash64(*row)).alias("hash_1"),
        F.bit_xor(F.xxhash64(F.lit("second"), *row)).alias("hash_2"),
    )


def unequal_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """``bucket`` of each bucket that two sets of ``bucket_hashes`` disagree on, or only one has."""
    both = old.withColumn("_side", F.lit(1)).union(new.withColumn("_side", F.lit(2)))
    sides = both.groupBy("bucket", "n_rows", "hash_1", "hash_2").agg(F.count(F.lit(1)).alias("_sides"))
    return sides.where("_sides = 1").select("bucket").distinct()


def diff_events_pruned(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    topic: str,
    ts_ms: Column,
    offset: Column | None = None,
    partitions: int = 4,
    buckets: int = 4096,
    old_hashes: DataFrame | None = None,
) -> DataFrame:
    """The events of ``diff_events``, by joining only the key buckets whose rows differ.

    Both sides are hashed where they lie, and only a row for each bucket moves; rows of equal
    buckets never reach the join. That pays while changes touch few buckets: with ``c`` changes
    the share that is joined is about ``1 - exp(-c / buckets)``, so choose ``buckets`` well above
    the number of changed keys. Two different buckets pass as equal with a probability of 2^-128.
    """
    columns = new.columns
    old = old.select(columns)
    hashes = bucket_hashes(old, keys, buckets) if old_hashes is None else old_hashes
    changed = unequal_buckets(hashes, bucket_hashes(new, keys, buckets))
    left, right = (
        side.withColumn("bucket", bucket_of(keys, buckets)).join(changed, "bucket", "left_semi").select(columns)
        for side in (old, new)
    )
    return diff_events(left, right, keys, topic, ts_ms, offset, partitions)

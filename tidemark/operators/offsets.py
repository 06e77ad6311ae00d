"""Source positions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

# topic -> partition -> next offset, as the source connector spells it in JSON.
DOCUMENT = "map<string,map<string,bigint>>"


def next_offsets(messages: DataFrame) -> DataFrame:
    """Per topic and partition: the offset to read next, and how many messages were seen."""
    return messages.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset"), F.count("*").alias("messages")
    )


def carry_forward(previous: Column, current: Column) -> Column:
    """Overlay partition maps: a partition that was quiet in this run keeps its old position."""
    return F.map_zip_with(previous, current, lambda _, old, new: F.coalesce(new, old))


def offsets_map(positions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per topic (and ``by``) with ``partitions``, a map from partition to position.

    A group has as many rows as the topic has partitions.
    """
    entries = F.sort_array(F.collect_list(F.struct("partition", "next_offset")))
    by_partition = F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e["partition"].cast("string"), e["next_offset"]))
    )
    return positions.groupBy("topic", *by).agg(by_partition.alias("partitions"))


def offsets_document(positions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same as JSON text: topic, then partition, then position; partitions in order."""
    document = F.to_json(F.create_map("topic", "partitions"))
    return offsets_map(positions, by).select("topic", *by, document.alias("offsets"))


def document_positions(documents: DataFrame) -> DataFrame:
    """The inverse of ``offsets_document``: one row per topic and partition."""
    parsed = documents.select(
        F.col("topic").alias("_topic"), F.from_json("offsets", DOCUMENT).alias("document")
    )
    return (
        parsed.select("_topic", F.explode("document").alias("topic", "partitions"))
        .where(F.col("_topic") == F.col("topic"))
        .select("topic", F.explode("partitions").alias("partition", "next_offset"))
        .withColumn("partition", F.col("partition").cast("int"))
    )


# -- slices of a topic -----------------------------------------------------------------------

# partition -> (first offset that the source still holds, offset of the next message to come)
Bounds = Mapping[int, tuple[int, int]]


@dataclass(frozen=True)
class Slice:
    """What one run reads: every partition of the topic, empty ones too, as the connector wants it.

    ``lost`` has ``(partition, from, to)`` for messages that were never read and are gone.
    """

    start: dict[int, int]
    end: dict[int, int]
    lost: tuple[tuple[int, int, int], ...] = ()

    @property
    def empty(self) -> bool:
        return self.start == self.end

    @property
    def lost_messages(self) -> int:
        return sum(to - begin for _, begin, to in self.lost)


def plan_slice(bounds: Bounds, saved: Mapping[int, int] | None = None) -> Slice:
    """From the saved positions to what the source holds now; no message is read for it.

    A partition without a saved position is new, or this is the first run: it starts where the
    source starts. A saved position before that start means that messages expired unread, and a
    partition that the source no longer has took them along. A saved position behind the end
    belongs to a topic that was made anew: the partition is read from its start, and the
    version test of the merge absorbs what is not new.
    """
    saved = dict(saved or {})
    start, lost = {}, []
    for p, (first, after) in sorted(bounds.items()):
        at = saved.pop(p, first)
        if at < first:
            lost.append((p, at, first))
        start[p] = at if first <= at <= after else first
    # How much a vanished partition held is not known; the position itself is gone.
    lost += [(p, at, at + 1) for p, at in sorted(saved.items())]
    return Slice(start, {p: after for p, (_, after) in sorted(bounds.items())}, tuple(lost))


# Offsets of one group of the window below. A partition may hold a third of all messages.
_BLOCK = 1 << 20


def lost_ranges(
    messages: DataFrame, saved: DataFrame, until: DataFrame | None = None, block: int = _BLOCK
) -> DataFrame:
    """Ranges of offsets that no message has: ``topic, partition, first_lost, last_lost, messages_lost``.

    ``saved`` has the position (``topic, partition, next_offset``) from which ``messages`` were to be
    read, ``until`` the ones up to which; a partition that only ``messages`` name begins with its
    first message. For topics without compaction and transactions, which leave holes of their own.

    Gaps are found inside blocks of offsets, and then between the ends of neighbouring blocks, so
    that no task holds a whole partition. Repeated offsets make no gap.
    """
    key = ["topic", "partition"]
    placed = messages.select(*key, "offset", F.floor(F.col("offset") / block).alias("_block"))
    inside = _gaps(placed, Window.partitionBy(*key, "_block").orderBy("offset"), F.col("offset"), F.col("offset"))
    ends = placed.groupBy(*key, "_block").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))
    ends = ends.select(*key, "lo", "hi")
    # A position stands for the message before it, or for the one that would come there.
    ends = ends.union(saved.select(*key, (F.col("next_offset") - 1).alias("lo"), (F.col("next_offset") - 1).alias("hi")))
    if until is not None:
        ends = ends.union(until.select(*key, F.col("next_offset").alias("lo"), F.col("next_offset").alias("hi")))
    between = _gaps(ends, Window.partitionBy(*key).orderBy("lo", "hi"), F.col("lo"), F.col("hi"))
    return inside.union(between)


def _gaps(rows: DataFrame, order: WindowSpec, low: Column, high: Column) -> DataFrame:
    before = F.max(high).over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = rows.select("topic", "partition", (before + 1).alias("first_lost"), (low - 1).alias("last_lost"))
    return found.where("first_lost <= last_lost").withColumn(
        "messages_lost", F.col("last_lost") - F.col("first_lost") + 1
    )

"""Deleted keys that keep their version, the pruned difference, and the stream's own state."""

import random

from conftest import envelope, physical_plan, values
from pyspark.sql import functions as F

from tidemark.model import TableSpec
from tidemark.operators import bucket_hashes, diff_events, diff_events_pruned, live, merge_keeping_deletes
from tidemark.operators.capture import unequal_buckets
from tidemark.sources.message_log import MessageLog
from tidemark.streaming import latest_rows, start_latest

SPEC = TableSpec("accounts", ("id",), "id STRING NOT NULL, v STRING")


def rows(df):
    return values(live(df), "id", "v")


def test_a_replay_does_not_bring_a_deleted_row_back(changes):
    first = changes([("a", "1", 1, 1, False), ("b", "1", 1, 2, False)])
    second = changes([("a", "2", 5, 3, True), ("b", "2", 6, 4, False), ("x", "0", 2, 9, True)])
    state = merge_keeping_deletes(first, second, ["id"])
    assert rows(state) == [("b", "2")]
    state = merge_keeping_deletes(state, first, ["id"])
    assert rows(state) == [("b", "2")]
    # The deleted keys are remembered, one that was never there too.
    assert values(state, "id", "is_deleted") == [("a", True), ("b", False), ("x", True)]
    state = merge_keeping_deletes(state, changes([("a", "3", 7, 5, False), ("b", "0", 3, 1, True)]), ["id"])
    assert rows(state) == [("a", "3"), ("b", "2")]


def test_equal_times_are_settled_by_the_offset_and_null_versions_are_oldest(changes):
    state = changes([("a", "1", 5, 7, True), ("b", "1", None, 1, False)])
    later = changes([("a", "2", 5, 8, False), ("b", "2", None, 1, True)])
    assert rows(merge_keeping_deletes(state, later, ["id"])) == [("a", "2"), ("b", "1")]
    same = merge_keeping_deletes(state, state, ["id"])
    assert values(same, "id", "v", "is_deleted") == values(state, "id", "v", "is_deleted")
    assert rows(merge_keeping_deletes(state, changes([("b", "3", 0, 0, False)]), ["id"])) == [("b", "3")]


def test_old_deletes_are_forgotten(changes):
    state = changes([("a", "1", 5, 1, True), ("b", "1", 9, 1, True), ("c", "1", 1, 1, False)])
    kept = merge_keeping_deletes(state, changes([("c", "2", 2, 2, True)]), ["id"], forget_before_ms=6)
    assert values(kept, "id") == [("b",)]


def test_null_keys_match_nothing(changes):
    state = changes([(None, "1", 5, 1, False)])
    assert len(rows(merge_keeping_deletes(state, changes([(None, "2", 6, 2, False)]), ["id"]))) == 2


def test_tombstones_of_random_replays_equal_the_newest_version(changes):
    """Any order of batches, some twice, ends in the newest version of each key."""
    draw = random.Random(1)
    events = [(f"k{draw.randrange(12)}", str(i), draw.randrange(20), i, draw.random() < 0.4) for i in range(80)]
    batches = [events[i : i + 10] for i in range(0, 80, 10)] * 2
    draw.shuffle(batches)
    newest = lambda batch: list({e[0]: e for e in sorted(batch, key=lambda e: (e[2], e[3]))}.values())
    state = changes(newest(batches[0]))
    for batch in batches[1:]:
        state = changes([tuple(r)[:5] for r in merge_keeping_deletes(state, changes(newest(batch)), ["id"]).collect()])
    assert rows(state) == sorted((e[0], e[1]) for e in newest(events) if not e[4])


def versions(spark):
    old = spark.range(2000).selectExpr("id", "IF(id % 7 = 0, NULL, 'v') AS a", "IF(id % 7 = 1, NULL, 'v') AS b")
    new = old.where("id != 3").withColumn("a", F.expr("CASE WHEN id = 9 THEN 'x' ELSE a END"))
    return old, new.union(spark.range(5000, 5002).selectExpr("id", "'n'", "NULL"))


def test_pruned_difference_has_the_same_events(spark):
    old, new = versions(spark)
    whole = diff_events(old, new, ["id"], "t", F.lit(1), offset=F.col("id"))
    assert whole.count() == 4
    for buckets in (1, 16, 4096):
        for hashes in (None, bucket_hashes(old, ["id"], buckets)):
            pruned = diff_events_pruned(old, new, ["id"], "t", F.lit(1), F.col("id"), buckets=buckets, old_hashes=hashes)
            assert values(pruned) == values(whole)


def test_only_unequal_buckets_are_joined(spark):
    old, new = versions(spark)
    hashes = [bucket_hashes(side, ["id"], 512) for side in (old, new)]
    assert unequal_buckets(*hashes).count() == 4
    assert unequal_buckets(hashes[0], bucket_hashes(old.repartition(5), ["id"], 512)).count() == 0
    pruned = diff_events_pruned(old, new, ["id"], "t", F.lit(1), buckets=512)
    pruned.collect()
    plan = physical_plan(pruned)
    assert plan.index("FullOuter") < plan.index("LeftSemi")  # the outer join stands above the pruning ones


def test_hashes_tell_where_a_null_is(spark):
    one = spark.sql("SELECT 1 AS id, NULL AS a, 'x' AS b")
    other = spark.sql("SELECT 1 AS id, 'x' AS a, NULL AS b")
    assert unequal_buckets(bucket_hashes(one, ["id"]), bucket_hashes(other, ["id"])).count() == 1


def test_stream_keeps_the_newest_over_a_restart(spark, tmp_path, messages):
    log, rows_at = MessageLog(str(tmp_path / "log")), str(tmp_path / "rows")

    def run(*events):
        log.write(messages([("accounts", 0, o, envelope(kind, **{side: {"id": i, "v": v}}, ts_ms=ts)) for o, kind, side, i, v, ts in events] + [("accounts", 1, events[0][0], "{bad")]))
        query = start_latest(log.stream(spark, ["accounts"]), SPEC, str(tmp_path / "check"), rows_at, interval=None)
        query.awaitTermination()
        return values(latest_rows(spark, rows_at, SPEC), "id", "v")

    assert run((0, "c", "after", "a", "1", 5), (1, "c", "after", "b", "1", 5)) == [("a", "1"), ("b", "1")]
    assert run((2, "d", "before", "a", "1", 9), (3, "u", "after", "b", "0", 3)) == [("b", "1")]
    assert run((4, "u", "after", "a", "late", 7), (5, "u", "after", "b", "2", 6)) == [("b", "2")]
    assert run((6, "c", "after", "a", "new", 10)) == [("a", "new"), ("b", "2")]

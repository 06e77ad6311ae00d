"""Slices of a topic from its bounds, and messages that were lost."""

import json

import pytest
from conftest import envelope, physical_plan, values

from tidemark.model import TableSpec
from tidemark.operators.offsets import lost_ranges, plan_slice
from tidemark.plans.jobs import Bronze, run_incremental, run_log
from tidemark.sources.kafka import KafkaSource
from tidemark.sources.message_log import MessageLog
from tidemark.sources.offset_log import OffsetLog

ACCOUNTS = TableSpec("accounts", ("id",), "id STRING NOT NULL, v STRING")


def test_first_slice_names_every_partition_also_empty_ones():
    first = plan_slice({0: (0, 5), 1: (0, 0), 2: (7, 9)})
    assert (first.start, first.end) == ({0: 0, 1: 0, 2: 7}, {0: 5, 1: 0, 2: 9})
    assert not first.empty and first.lost == ()
    assert plan_slice({0: (3, 3)}).empty and plan_slice({}).empty


def test_later_slice_takes_added_partitions_and_sees_expired_messages():
    later = plan_slice({0: (4, 8), 1: (0, 0), 3: (0, 2)}, {0: 2, 1: 0})
    assert (later.start, later.end) == ({0: 4, 1: 0, 3: 0}, {0: 8, 1: 0, 3: 2})
    assert later.lost == ((0, 2, 4),) and later.lost_messages == 2
    anew = plan_slice({0: (0, 3)}, {0: 100})
    assert anew.start == {0: 0} and anew.lost == ()
    assert plan_slice({0: (0, 3)}, {0: 3, 5: 9}).lost == ((5, 9, 10),)


def test_options_of_a_topic_with_an_empty_and_an_added_partition(spark):
    asked = []

    def bounds(session, options, topic):
        asked.append((options["kafka.bootstrap.servers"], topic))
        return {0: (0, 5), 1: (0, 0), 2: (0, 4)}

    source = KafkaSource("broker:9092", options={"kafka.security.protocol": "SSL"}, find_bounds=bounds)
    piece = plan_slice(source.bounds(spark, "accounts"), {0: 3, 1: 0})
    options = source.batch_options("accounts", piece.start, piece.end)
    assert json.loads(options["startingOffsets"]) == {"accounts": {"0": 3, "1": 0, "2": 0}}
    assert json.loads(options["endingOffsets"]) == {"accounts": {"0": 5, "1": 0, "2": 4}}
    assert asked == [("broker:9092", "accounts")]


class Counting:
    """A log that says how often its messages were asked for."""

    def __init__(self, log, bounds=None):
        self.log, self.reads, self.fixed = log, [], bounds

    def bounds(self, spark, topic):
        return self.fixed or self.log.bounds(spark, topic)

    def read(self, spark, topic, start=None, end=None):
        self.reads.append((start, end))
        return self.log.read(spark, topic, start, end)


@pytest.fixture
def log(tmp_path, messages):
    log = MessageLog(str(tmp_path / "log"))
    log.write(messages([("accounts", 0, o, envelope("c", after={"id": f"a{o}", "v": "1"}, ts_ms=o)) for o in range(4, 9)]))
    return log


def test_a_run_reads_its_messages_once_and_counts_them(spark, tmp_path, log):
    source = Counting(log, {0: (4, 9), 1: (0, 0)})
    bronze = Bronze(str(tmp_path / "bronze"), buckets=2)
    row = run_incremental(spark, ACCOUNTS, source, bronze)
    assert (row["status"], row["kafka_messages"], row["lost_messages"]) == ("SUCCESS", 5, 0)
    assert source.reads == [({0: 4, 1: 0}, {0: 9, 1: 0})]
    assert OffsetLog(spark, bronze.offsets_path).last("accounts") == {0: 9, 1: 0}
    assert run_incremental(spark, ACCOUNTS, source, bronze)["status"] == "SKIPPED"
    assert len(source.reads) == 1


def test_expired_messages_fail_a_run_or_are_reported(spark, tmp_path, log):
    strict = Bronze(str(tmp_path / "strict"), buckets=2)
    lenient = Bronze(str(tmp_path / "lenient"), buckets=2, fail_on_data_loss=False)
    for bronze in (strict, lenient):
        OffsetLog(spark, bronze.offsets_path).save("accounts", {0: 1})
    failed = run_incremental(spark, ACCOUNTS, log, strict)
    assert failed["status"] == "ERROR" and "DataLoss" in failed["error"] and "(0, 1, 4)" in failed["error"]
    assert OffsetLog(spark, strict.offsets_path).last("accounts") == {0: 1}
    passed = run_incremental(spark, ACCOUNTS, log, lenient)
    assert (passed["status"], passed["lost_messages"], passed["final_records"]) == ("SUCCESS", 3, 5)
    assert values(run_log(spark, [failed, passed]), "status", "lost_messages") == [("ERROR", None), ("SUCCESS", 3)]


def brute(offsets, first, after):
    """Runs of missing offsets."""
    missing = [o for o in range(first, after) if o not in offsets]
    ranges = []
    for o in missing:
        if ranges and ranges[-1][1] == o - 1:
            ranges[-1][1] = o
        else:
            ranges.append([o, o])
    return [(a, b, b - a + 1) for a, b in ranges]


@pytest.mark.parametrize("block", [1, 3, 1 << 20])
def test_lost_ranges_in_and_between_blocks(spark, messages, block):
    held = {0: {0, 1, 5, 6, 7, 19}, 1: {3}, 2: set()}
    rows = [("t", p, o, None) for p, offsets in held.items() for o in offsets] + [("t", 0, 5, "again")]
    saved = spark.createDataFrame([("t", p, 0) for p in held], "topic STRING, partition INT, next_offset BIGINT")
    until = spark.createDataFrame([("t", 0, 20), ("t", 1, 9), ("t", 2, 4)], saved.schema)
    found = lost_ranges(messages(rows), saved, until, block)
    wanted = [("t", p, *x) for p, n in ((0, 20), (1, 9), (2, 4)) for x in brute(held[p], 0, n)]
    assert values(found) == sorted(wanted, key=repr)
    none = lost_ranges(messages([]), saved.limit(0), until.limit(0), block)
    assert values(none) == []


def test_no_window_over_messages_spans_a_whole_partition(messages, spark):
    saved = spark.createDataFrame([], "topic STRING, partition INT, next_offset BIGINT")
    plan = physical_plan(lost_ranges(messages([("t", 0, 1, None)]), saved))
    assert "_block" in plan[plan.index("Window") :].split("\n")[0]

import pytest
from conftest import envelope, values

from tidemark.model import TableSpec
from tidemark.operators import next_offsets, run_totals
from tidemark.plans.jobs import Bronze, run_full, run_incremental, run_tables
from tidemark.sources.message_log import MessageLog, within
from tidemark.sources.offset_log import OffsetLog

ACCOUNTS = TableSpec("accounts", ("id",), "id STRING NOT NULL, v STRING")
FIRST = [
    ("accounts", 0, 0, envelope("c", after={"id": "a", "v": "1"}, ts_ms=1)),
    ("accounts", 1, 0, envelope("c", after={"id": "b", "v": "1"}, ts_ms=1)),
    ("accounts", 1, 1, None),
]
SECOND = [
    ("accounts", 1, 2, envelope("d", before={"id": "b", "v": "1"}, ts_ms=2)),
    ("accounts", 1, 3, envelope("c", after={"id": "c", "v": "1"}, ts_ms=3)),
    ("accounts", 1, 4, "{bad"),
]


@pytest.fixture
def log(tmp_path, messages):
    log = MessageLog(str(tmp_path / "log"))
    log.write(messages(FIRST))
    return log


def bronze(tmp_path, **options):
    return Bronze(str(tmp_path / "bronze"), buckets=4, **options)


def state(spark, target):
    return values(target.table(spark, ACCOUNTS).read(), "id", "v")


def test_incremental_runs_resume_and_carry_quiet_partitions(spark, tmp_path, log, messages):
    target = bronze(tmp_path, mode="upsert_delete", dead_letters=str(tmp_path / "dead"))
    first = run_incremental(spark, ACCOUNTS, log, target)
    assert (first["status"], first["kafka_messages"], first["final_records"]) == ("SUCCESS", 3, 2)
    positions = OffsetLog(spark, target.offsets_path)
    assert positions.last("accounts") == {0: 1, 1: 2}

    assert run_incremental(spark, ACCOUNTS, log, target)["status"] == "SKIPPED"

    log.write(messages(SECOND))
    second = run_incremental(spark, ACCOUNTS, log, target)
    assert (second["status"], second["kafka_messages"], second["final_records"]) == ("SUCCESS", 3, 2)
    assert state(spark, target) == [("a", "1"), ("c", "1")]
    assert positions.last("accounts") == {0: 1, 1: 5}
    assert positions.read().count() == 2
    dead = spark.read.parquet(str(tmp_path / "dead"))
    assert values(dead, "kafka_offset", "value", "reason") == [(4, "{bad", "missing_key")]


def test_plain_load_keeps_malformed_rows_and_ignores_later_deletes(spark, tmp_path, log, messages):
    target = bronze(tmp_path)
    run_full(spark, ACCOUNTS, log, target)
    log.write(messages(SECOND))
    run_incremental(spark, ACCOUNTS, log, target)
    assert state(spark, target) == sorted(
        [("a", "1"), ("b", "1"), ("c", "1"), (None, None)], key=repr
    )


def test_reset_reads_from_the_beginning(spark, tmp_path, log, messages):
    target = bronze(tmp_path, mode="upsert_delete", dead_letters=str(tmp_path / "dead"))
    run_incremental(spark, ACCOUNTS, log, target)
    log.write(messages(SECOND))
    again = run_incremental(spark, ACCOUNTS, log, target, reset=True)
    assert again["kafka_messages"] == 6
    assert state(spark, target) == [("a", "1"), ("c", "1")]


def test_full_load_registers_the_table(spark, tmp_path, log):
    target = bronze(tmp_path, database="loaded")
    run_full(spark, ACCOUNTS, log, target)
    assert values(spark.sql("SELECT id FROM loaded.accounts")) == [("a",), ("b",)]


def test_one_failing_table_does_not_stop_the_others(spark, tmp_path, log):
    class Broken:
        def bounds(self, spark, topic):
            return {0: (0, 1)} if topic == "broken" else log.bounds(spark, topic)

        def read(self, spark, topic, start=None, end=None):
            if topic == "broken":
                raise OSError("unreachable")
            return log.read(spark, topic, start, end)

    specs = [
        TableSpec("broken", ("id",), "id STRING"),
        ACCOUNTS,
        TableSpec("quiet", ("id",), "id STRING"),
    ]
    target = bronze(tmp_path)
    runs = run_tables(spark, specs, lambda s: run_full(spark, s, Broken(), target))
    assert values(runs, "table", "status") == [
        ("accounts", "SUCCESS"), ("broken", "ERROR"), ("quiet", "SKIPPED")
    ]
    assert "unreachable" in runs.where("status = 'ERROR'").first().error
    totals = {r.status: (r.tables, r.messages, r.records) for r in run_totals(runs).collect()}
    assert totals == {"SUCCESS": (1, 3, 2), "ERROR": (1, 0, 0), "SKIPPED": (1, 0, 0)}


def test_bounds(spark, messages):
    df = messages([("t", p, o, None) for p in range(3) for o in range(4)])
    got = within(df, {0: 3}, None)
    assert values(got, "partition", "offset") == [(0, 3)] + [(p, o) for p in (1, 2) for o in range(4)]
    got = within(df, {0: 1}, {0: 3, 1: 1})
    assert values(got, "partition", "offset") == [(0, 1), (0, 2), (1, 0)]


def test_bounds_reach_the_scan(spark, tmp_path, log):
    plan = log.read(spark, "accounts", {0: 1, 1: 2}, {0: 1, 1: 5})._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,1)" in plan
    assert "topic" in plan[plan.index("PartitionFilters") :]


def test_next_offsets(messages):
    df = messages([("t", 0, 4, None), ("t", 0, 9, None), ("u", 0, 2, None)])
    assert values(next_offsets(df), "topic", "partition", "next_offset", "messages") == [
        ("t", 0, 10, 2), ("u", 0, 3, 1)
    ]


def test_offset_log_reports_real_failures(spark, tmp_path):
    assert OffsetLog(spark, str(tmp_path / "none")).last("t") is None
    broken = tmp_path / "broken" / "topic=t"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        OffsetLog(spark, str(tmp_path / "broken")).last("t")


def test_old_snapshots_expire_after_a_run(spark, tmp_path, log, messages):
    target = bronze(tmp_path, mode="upsert_delete", keep_snapshots=1, database="kept")
    run_incremental(spark, ACCOUNTS, log, target)
    log.write(messages(SECOND[:2]))
    run_incremental(spark, ACCOUNTS, log, target)
    assert target.table(spark, ACCOUNTS)._names() == ["000000001.json"]
    assert state(spark, target) == [("a", "1"), ("c", "1")]
    assert values(spark.sql("SELECT id, v FROM kept.accounts")) == [("a", "1"), ("c", "1")]
    log.write(messages([("accounts", 0, 1, envelope("c", after={"id": "z", "v": "9"}, ts_ms=9))]))
    run_incremental(spark, ACCOUNTS, log, target)
    assert values(spark.sql("SELECT id FROM kept.accounts")) == [("a",), ("c",), ("z",)]

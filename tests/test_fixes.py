"""Cases that once lost rows, stopped a job or returned something else than asked."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.moments import millis_of
from tidemark.model import Reference, TableSpec
from tidemark.operators import decode_changes, diff_events, snapshot_events
from tidemark.operators.quality import reference_violations
from tidemark.plans.jobs import Bronze, apply_messages, run_incremental
from tidemark.plans.silver import silver, silver_rejects
from tidemark.sources import files
from tidemark.sources.catalog import register
from tidemark.sources.csv import read_csv
from tidemark.sources.message_log import MessageLog, within
from tidemark.sources.state_table import StateTable

from conftest import envelope

SPEC = TableSpec("accounts", ("id",), "id STRING NOT NULL, v STRING")


def change(i, ts, v="x"):
    return (str(i), v, ts, ts, False)


def test_merge_without_broadcasts(spark, changes, tmp_path):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = StateTable(spark, str(tmp_path / "t"), ["id"], 4)
        table.apply(changes([change(i, 1) for i in range(20)]))
        table.apply(changes([change(i, 2, "y") for i in range(10, 30)]))
        assert sorted((int(r.id), r.v) for r in table.read().collect()) == [(i, "x" if i < 10 else "y") for i in range(30)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("buckets", [3, 4, 15])
def test_a_small_bucket_stays_one_file(spark, changes, tmp_path, buckets):
    table = StateTable(spark, str(tmp_path / "t"), ["id"], buckets)
    for step in range(3):
        table.apply(changes([change(i, step + 1) for i in range(step * 20, step * 20 + 60)]))
        for folder in table.locations().values():
            assert sum(n.endswith(".parquet") for n in files.names(spark, folder)) == 1


def test_milliseconds_of_far_dates(spark):
    text = "9999-12-31 23:59:59.{:03d}"
    rows = spark.range(1000).select(F.format_string("9999-12-31 23:59:59.%03d", "id").cast("timestamp_ntz").alias("t"), "id")
    assert rows.where(F.pmod(millis_of(F.col("t")), F.lit(1000)) != F.col("id")).count() == 0, text


def test_csv_files_must_agree(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text("id,v\n1,x\n")
    (tmp_path / "a" / "2.csv").write_text("v,id\ny,2\n")
    (tmp_path / "b.csv").write_text("id,v\n1,x,surplus\n")
    for path in ("a", "b.csv"):
        for multi_line in (True, False):
            with pytest.raises(Exception):  # noqa: B017 - any reader error
                read_csv(spark, str(tmp_path / path), SPEC, multi_line).collect()


def test_register_follows_a_moved_table(spark, tmp_path):
    for n in (1, 2):
        spark.range(n).write.parquet(str(tmp_path / f"v{n}"))
        register(spark, "shelf", "moved", str(tmp_path / f"v{n}"))
        assert spark.table("shelf.moved").count() == n
    spark.sql("DROP TABLE shelf.moved")


def test_dead_letters_are_kept_once(spark, messages, tmp_path):
    bronze = Bronze(str(tmp_path / "bronze"), buckets=2, dead_letters=str(tmp_path / "dead"))
    rows = messages([("accounts", 0, 0, "{bad"), ("accounts", 0, 1, envelope("c", after={"id": "a", "v": "1"}))])
    for _ in range(2):
        apply_messages(spark, rows, SPEC, bronze)
    assert [r.kafka_offset for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == [0]


def test_a_missing_parent_is_not_a_passed_check(spark):
    child = TableSpec("child", ("id",), "id INT NOT NULL, p INT", references=(Reference(("p",), "parent", ("id",)),))
    with pytest.raises(ValueError, match="parent"):
        reference_violations({"child": spark.range(1)}, [child])


def test_bounds_reach_the_scan(spark, messages, tmp_path):
    path = str(tmp_path / "log")
    messages([("t", p, o, "v") for p in range(3) for o in range(5)]).write.parquet(path)
    log = spark.read.parquet(path)
    rows = within(log, {0: 3, 1: 5}, None)
    assert sorted((r.partition, r.offset) for r in rows.collect()) == [(0, 3), (0, 4), *((2, o) for o in range(5))]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(offset,3)" in pushed and "Join" not in plan


def test_appended_events_come_behind_the_stored_ones(spark, tmp_path):
    log = MessageLog(str(tmp_path / "log"))
    spec = TableSpec("items", ("id",), "id INT NOT NULL, v STRING")
    rows = lambda n, v: spark.range(n).selectExpr("CAST(id AS INT) AS id", f"'{v}' AS v").repartition(3)
    bronze = Bronze(str(tmp_path / "bronze"), buckets=2, mode="upsert_delete")
    log.append(snapshot_events(rows(30, "a"), spec.keys, "items", ts_ms=F.lit(1)))
    assert run_incremental(spark, spec, log, bronze)["kafka_messages"] == 30
    log.append(diff_events(rows(30, "a"), rows(40, "a").withColumn("v", F.expr("IF(id < 5, 'b', v)")), spec.keys, "items", ts_ms=F.lit(2)))
    assert run_incremental(spark, spec, log, bronze)["kafka_messages"] == 15
    found = {int(r.id): r.v for r in bronze.table(spark, spec).read().collect()}
    assert found == {i: "b" if i < 5 else "a" for i in range(40)}
    stored = log.read(spark, "items")
    assert stored.select("partition", "offset").distinct().count() == 45


def test_silver_wants_what_the_source_wants(spark, messages):
    spec = TableSpec("items", ("id",), "id INT NOT NULL, name STRING NOT NULL, n INT")
    rows = [("items", 0, 0, "{bad"), ("items", 0, 1, envelope("c", after={"id": "1", "name": "a", "n": None})), ("items", 0, 2, envelope("c", after={"id": "2", "n": "x"}))]
    bronze = decode_changes(messages(rows), spec.columns)
    assert [(r.id, r.name, r.n) for r in silver(bronze, spec).collect()] == [(1, "a", None)]
    rejects = {r.kafka_offset: r.cast_failures for r in silver_rejects(bronze, spec).collect()}
    assert rejects == {0: ["id", "name"], 2: ["name", "n"]}


def test_line_item_log_is_compressed_well(spark):
    """The log is most of what the two-run merge writes."""
    from tidemark.plans import samples

    log = samples.lineitem_messages(spark, "/root/testdata/sf0.001")
    assert all(f.endswith(".zstd.parquet") for f in log.inputFiles())

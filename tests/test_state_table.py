import pytest
from pyspark.sql import functions as F
from conftest import values

from tidemark.sources import files
from tidemark.sources.catalog import publish
from tidemark.sources.state_table import CommitConflict, StateTable


@pytest.fixture
def table(spark, tmp_path):
    return StateTable(spark, str(tmp_path / "t"), ["id"], buckets=4)


def rows(table):
    return values(table.read(), "id", "v")


def test_create_merge_and_delete(table, changes):
    assert not table.exists()
    table.apply(changes([("a", "1", 1, 1, False), ("b", "1", 1, 1, False), ("x", "1", 1, 1, True)]))
    assert rows(table) == [("a", "1"), ("b", "1")]
    table.apply(changes([("a", "2", 2, 2, False), ("b", "2", 2, 2, True), ("c", "2", 2, 2, False)]), "upsert_delete")
    assert rows(table) == [("a", "2"), ("c", "2")]
    assert table.count() == 2


def test_large_changes_take_the_shuffled_form(spark, table, changes):
    table.apply(changes([(f"k{i}", "1", 1, i, False) for i in range(200)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10b")
    try:
        table.apply(changes([(f"k{i}", "2", 2, i, i % 2 == 0) for i in range(100, 300)]), "upsert_delete")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = {f"k{i}": "1" for i in range(100)} | {f"k{i}": "2" for i in range(101, 300, 2)}
    assert rows(table) == sorted(expected.items())


def test_bucket_count_that_does_not_divide_the_shuffle_width(spark, tmp_path, changes):
    table = StateTable(spark, str(tmp_path / "odd"), ["id"], buckets=5)
    table.apply(changes([(f"k{i}", "1", 1, i, False) for i in range(50)]))
    table.apply(changes([("k7", "2", 2, 99, False)]))
    assert dict(rows(table)) == {f"k{i}": "1" for i in range(50)} | {"k7": "2"}


def test_only_touched_buckets_are_rewritten(table, changes):
    table.apply(changes([(f"k{i}", "1", 1, i, False) for i in range(40)]))
    before = table.locations()
    table.apply(changes([("k0", "2", 2, 1, False)]))
    after = table.locations()
    assert set(before) == set(after) == {0, 1, 2, 3}
    assert sum(before[b] != after[b] for b in before) == 1


def test_emptied_bucket_disappears(table, changes):
    keys = [f"k{i}" for i in range(40)]
    table.apply(changes([(k, "1", 1, 1, False) for k in keys]))
    table.apply(changes([(k, "2", 2, 2, True) for k in keys]), "upsert_delete")
    assert table.locations() == {}
    assert rows(table) == []
    table.apply(changes([("k1", "3", 3, 3, False)]), "upsert_delete")
    assert rows(table) == [("k1", "3")]


def test_a_committed_batch_is_not_applied_again(table, changes):
    assert table.apply(changes([("a", "1", 1, 1, False)]), batch=("stream", 0))
    assert table.apply(changes([("a", "2", 2, 2, False)]), batch=("stream", 1))
    assert not table.apply(changes([("a", "3", 3, 3, False)]), batch=("stream", 1))
    assert table.apply(changes([("b", "1", 1, 1, False)]), batch=("other", 0))
    assert rows(table) == [("a", "2"), ("b", "1")]


def test_readers_ignore_what_was_not_published(spark, table, changes):
    table.apply(changes([("a", "1", 1, 1, False)]))
    changes([("z", "9", 9, 9, False)]).write.parquet(f"{table.path}/data/000000009-crashed/bucket=0")
    assert rows(table) == [("a", "1")]


def test_two_writers_cannot_publish_the_same_snapshot(spark, table, changes):
    table.apply(changes([("a", "1", 1, 1, False)]))
    stale = table.snapshot()
    table.apply(changes([("a", "2", 2, 2, False)]))
    with pytest.raises(CommitConflict):
        table._commit(table.read(), 4, {0, 1, 2, 3}, stale, None)
    assert rows(table) == [("a", "2")]


def test_missing_table_is_an_error(table):
    with pytest.raises(FileNotFoundError):
        table.read()


def test_published_table_follows_the_commits(spark, table, changes):
    for version in ("1", "2"):
        table.apply(changes([(f"k{i}", version, int(version), i, version == "2" and i < 10) for i in range(20)]), "upsert_delete")
        publish(spark, "shelf", "k", table)
        assert values(spark.table("shelf.k"), "id", "v") == rows(table)
    assert spark.table("shelf.k").count() == 10


def test_published_table_shows_new_columns_and_keeps_two_versions(spark, table, changes):
    spark.sql("CREATE DATABASE IF NOT EXISTS shelf")
    spark.sql(f"CREATE TABLE shelf.grown (x INT) USING parquet LOCATION '{table.path}-before'")  # a table of that name
    for version in range(1, 5):
        rows_ = changes([(f"k{i}", str(version), version, i, False) for i in range(8)])
        table.apply(rows_ if version < 3 else rows_.withColumn("more", F.lit(version)))
        begun = spark.table("shelf.grown") if version > 1 else None
        publish(spark, "shelf", "grown", table)
        if begun is not None:  # a reader of the commit before goes on
            assert {r["v"] for r in begun.collect()} == {str(version - 1)}
    assert values(spark.table("shelf.grown"), "id", "v", "more") == [(f"k{i}", "4", 4) for i in range(8)]
    assert "bucket" not in spark.table("shelf.grown").columns
    left = {t.name for t in spark.catalog.listTables("shelf") if t.name.startswith("grown_at_")}
    assert left == {"grown_at_2", "grown_at_3"}


@pytest.mark.parametrize("form", ["outer", "split", None])
def test_every_merge_form_gives_the_same_rows(spark, tmp_path, changes, form):
    table = StateTable(spark, str(tmp_path / "t"), ["id"], 4, form)
    table.apply(changes([(f"k{i}", "1", 1, i, False) for i in range(20)]))
    table.apply(changes([(f"k{i}", "2", 2, i, i % 2 == 0) for i in range(10, 30)]), "upsert_delete")
    expected = {f"k{i}": "1" for i in range(10)} | {f"k{i}": "2" for i in range(11, 30, 2)}
    assert rows(table) == sorted(expected.items())


def test_publish_text_is_written_once(spark, tmp_path):
    path = str(tmp_path / "x" / "1.json")
    assert files.publish_text(spark, path, "é")
    assert not files.publish_text(spark, path, "other")
    assert files.read_text(spark, path) == "é"
    assert files.names(spark, str(tmp_path / "x")) == ["1.json"]


def test_expired_snapshots_free_their_folders(spark, table, changes):
    for version in range(1, 5):
        table.apply(changes([("a", str(version), version, version, False)]))
    table.expire(keep=2)
    assert files.names(spark, f"{table.path}/snapshots") == ["000000002.json", "000000003.json"]
    folders = [f for f in files.names(spark, f"{table.path}/data") if files.size(spark, f"{table.path}/data/{f}/") > 100]
    assert len(folders) == 2
    assert rows(table) == [("a", "4")]


def test_staged_changes_are_removed(spark, table, changes):
    from tidemark.session import shared_folder

    def staged():
        return {n for n in files.names(spark, f"{shared_folder(spark)}/tidemark") if n.startswith("changes-")}

    before = staged()
    for version in (1, 2):
        table.apply(changes([("a", "x", version, version, False)]))
    assert staged() == before


def test_a_new_column_reads_as_null_in_old_rows(table, changes):
    table.apply(changes([("a", "1", 1, 1, False), ("b", "1", 1, 1, False)]))
    table.apply(changes([("b", "2", 2, 2, False)]).selectExpr("*", "'x' AS added"))
    assert values(table.read(), "id", "v", "added") == [("a", "1", None), ("b", "2", "x")]
    table.apply(changes([("a", "3", 3, 3, False)]).selectExpr("*", "'y' AS added"))
    assert values(table.read(), "id", "v", "added") == [("a", "3", "y"), ("b", "2", "x")]


def test_buckets_follow_the_shuffle(spark, tmp_path):
    """After a shuffle on the key, a task holds one bucket, and a bucket one or few files."""
    from pyspark.sql import functions as F

    from tidemark.functions import bucket_of
    from tidemark.operators import latest_per_key

    df = spark.range(0, 20_000, 1, 8).selectExpr(
        "CAST(id % 5000 AS STRING) AS id", "CAST(id AS STRING) AS v", "id AS cdc_timestamp_ms",
        "id AS kafka_offset", "0 AS kafka_partition", "false AS is_deleted",
    )
    shuffled = df.repartition(8, "id").select(F.spark_partition_id().alias("task"), bucket_of(["id"], 8).alias("b"))
    assert shuffled.where("task <> b").isEmpty()
    table = StateTable(spark, str(tmp_path / "aligned"), ["id"], buckets=8)
    table.apply(latest_per_key(df, ["id"]))
    assert table.count() == 5000
    for folder in table.locations().values():
        assert len([n for n in files.names(spark, folder) if n.endswith(".parquet")]) == 1


@pytest.mark.parametrize("buckets, shuffles", [(8, 1), (16, 1), (5, 2)])
def test_a_new_table_is_not_shuffled_again(spark, tmp_path, changes, buckets, shuffles):
    """The latest changes come from a shuffle on the key; buckets that it keeps whole need no other."""
    from tidemark.operators import latest_per_key

    newest = latest_per_key(changes([(f"k{i % 40}", str(i), i, i, False) for i in range(200)]), ["id"])
    table = StateTable(spark, str(tmp_path / "new"), ["id"], buckets=buckets)
    next_shuffle = spark.sparkContext._jsc.sc().newShuffleId
    before = next_shuffle()
    table.apply(newest)
    assert next_shuffle() - before - 1 == shuffles
    assert rows(table) == sorted((f"k{i % 40}", str(i)) for i in range(160, 200))
    for folder in table.locations().values():
        assert len([n for n in files.names(spark, folder) if n.endswith(".parquet")]) == 1


def test_bucket_count_and_key_are_those_of_the_table(spark, table, changes):
    table.apply(changes([(f"k{i}", "1", 1, i, False) for i in range(20)]))
    again = StateTable(spark, table.path, ["id"], buckets=7)
    again.apply(changes([(f"k{i}", "2", 2, i, False) for i in range(20)]))
    assert again.snapshot().buckets == 4
    assert rows(again) == sorted((f"k{i}", "2") for i in range(20))
    with pytest.raises(ValueError, match="key"):
        StateTable(spark, table.path, ["v"]).read()


def test_default_bucket_count_is_the_shuffle_width(spark, tmp_path, changes):
    table = StateTable(spark, str(tmp_path / "d"), ["id"])
    table.apply(changes([("a", "1", 1, 1, False)]))
    assert table.snapshot().buckets == 8

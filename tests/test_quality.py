from conftest import physical_plan, values

from tidemark.model import TABLES, TableSpec, lookup
from tidemark.operators import duplicate_keys, key_violations, orphans, row_violations, surrogate_key

REVIEWS = TABLES["order_reviews"]


def report(df):
    return {(r.rule, r.column_name): r.violations for r in df.collect() if r.violations}


def test_row_rules_on_bronze_text(spark):
    good = {"review_id": "r", "order_id": "o", "review_score": "5", "review_creation_date": "1506933600000000"}
    rows = [
        good,
        {**good, "review_score": "6"},
        {**good, "review_score": "five"},
        {**good, "review_score": None},
        {**good, "order_id": "x" * 101},
        {**good, "review_creation_date": "2017-10-02"},
    ]
    df = spark.createDataFrame(
        [tuple(r.get(c) for c in REVIEWS.columns) for r in rows],
        ", ".join(f"{c} STRING" for c in REVIEWS.columns),
    )
    assert report(row_violations(df, REVIEWS)) == {
        ("check", "review_score"): 1,
        ("type", "review_score"): 1,
        ("not_null", "review_score"): 1,
        ("length", "order_id"): 1,
        ("type", "review_creation_date"): 1,
    }


def test_decimal_must_fit(spark):
    spec = TableSpec("p", ("id",), "id STRING, price DECIMAL(10,2)")
    df = spark.createDataFrame(
        [("1", "12.345"), ("2", "123456789.01"), ("3", "99999999.99"), ("4", "1e3"), ("5", "x")],
        "id STRING, price STRING",
    )
    assert report(row_violations(df, spec)) == {("type", "price"): 2}


def test_all_rules_share_one_pass(spark, tmp_path):
    spark.createDataFrame([("r",) * 7], ", ".join(f"{c} STRING" for c in REVIEWS.columns)).write.parquet(str(tmp_path / "r"))
    plan = physical_plan(row_violations(spark.read.parquet(str(tmp_path / "r")), REVIEWS))
    assert plan.count("FileScan") == 1


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "b"), (None, "c")], "id INT, v STRING")
    assert values(duplicate_keys(df, ["id"])) == [(1, 3)]
    assert report(key_violations(df, ["id"], "t")) == {("key_unique", "id"): 2, ("key_not_null", "id"): 1}


def test_orphans_are_counted_per_value(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (2,), (None,)], "parent INT")
    parent = spark.createDataFrame([(1,)], "id INT")
    got = orphans(child, ["parent"], parent, ["id"])
    assert values(got) == [(2, 3)]
    # A value that many rows share is reduced to one row before anything is shuffled.
    plan = physical_plan(got)
    assert "partial_count" in plan


def test_references_of_all_tables_exist():
    for spec in TABLES.values():
        for reference in spec.references:
            parent = lookup(reference.parent)
            assert set(reference.columns) <= set(spec.columns)
            assert set(reference.parent_columns) <= set(parent.columns)


def test_surrogate_key_follows_the_load_order(spark, tmp_path):
    path = str(tmp_path / "rows")
    for start in (0, 100):
        spark.range(start, start + 100, 1, 3).write.mode("append").parquet(path)
    numbered = surrogate_key(spark, path, "key")
    rows = numbered.collect()
    assert sorted(r.key for r in rows) == list(range(1, 201))
    assert values(surrogate_key(spark, path, "key")) == sorted((tuple(r) for r in rows), key=repr)
    files = {f: i for i, f in enumerate(sorted(spark.read.parquet(path).inputFiles()))}
    placed = spark.read.parquet(path).selectExpr("id", "_metadata.file_path AS f", "_metadata.row_index AS r").collect()
    order = [r.id for r in sorted(placed, key=lambda r: (sorted(p.f for p in placed).index(r.f), r.r))]
    assert [r.id for r in sorted(rows, key=lambda r: r.key)] == order
    assert len(files) == 6
    # Only the per-file counts move.
    assert "SortMergeJoin" not in physical_plan(numbered)


def test_no_file_of_a_numbered_table_meets_in_one_task(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 300, 1, 3).write.parquet(path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the table were large
    try:
        numbered = surrogate_key(spark, path, "key")
        assert "SortMergeJoin" not in physical_plan(numbered) and "BroadcastHashJoin" in physical_plan(numbered)
        assert sorted(r.key for r in numbered.collect()) == list(range(1, 301))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)

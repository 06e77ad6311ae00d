"""Seed loads, kept totals, reference checks of a slice, and dead letters in one pass."""

import datetime
import random
from decimal import Decimal

import pytest
from conftest import envelope, physical_plan, values
from pyspark.sql import functions as F

from tidemark.model import Reference, TableSpec
from tidemark.operators import reference_deltas
from tidemark.plans import jobs
from tidemark.plans.gold import maintain_windows, totals_by_window, window_changes, window_totals
from tidemark.plans.jobs import Bronze, apply_messages, dead_letters
from tidemark.plans.seeds import SEEDS, Seed, check_order, load_seeds
from tidemark.model import TABLES

PARENT = TableSpec("parent", ("id",), "id INT NOT NULL, name STRING")
CHILD = TableSpec("child", ("id",), "id INT NOT NULL, p INT", references=(Reference(("p",), "parent", ("id",)),))
SPECS = {"parent": PARENT, "child": CHILD}


# -- seeds


def test_seeds_load_in_order_and_report_every_file(spark, tmp_path):
    (tmp_path / "parent.csv").write_text('name\n"a, ""b""\nc"\n\n007\n')
    (tmp_path / "child.csv").write_text("id,p\n1,1,9\n")
    seeds = (Seed("parent", "parent.csv", generated="id"), Seed("child", "child.csv"))
    landed = str(tmp_path / "landed")
    for _ in range(2):  # loading again replaces
        report = load_seeds(spark, str(tmp_path), landed, seeds, SPECS)
        rows = {r["table_name"]: r for r in report.collect()}
        assert (rows["parent"]["status"], rows["parent"]["load_order"]) == ("LOADED", 1)
        assert rows["parent"]["file_rows"] == rows["parent"]["stored_rows"] == 2
        assert rows["child"]["status"] == "ERROR" and rows["child"]["error"]
    assert values(spark.read.parquet(f"{landed}/parent"), "id", "name") == [("1", 'a, "b"\nc'), ("2", "007")]
    (tmp_path / "child.csv").unlink()
    report = load_seeds(spark, str(tmp_path), landed, seeds, SPECS)
    assert values(report, "table_name", "status", "file_rows") == [("child", "MISSING", None), ("parent", "LOADED", 2)]


def test_seeds_cover_the_nine_tables_parents_first():
    assert {s.table for s in SEEDS} == set(TABLES)
    check_order(SEEDS, TABLES)
    with pytest.raises(ValueError, match="order_items comes before"):
        check_order((Seed("order_items", "x"), Seed("orders", "y")), TABLES)


# -- kept totals


def test_kept_totals_equal_a_rebuild_after_every_batch(spark, tmp_path):
    draw = random.Random(2)
    path, state = str(tmp_path / "gold"), {}
    schema = "id INT, day TIMESTAMP_NTZ, kind STRING, amount DECIMAL(10,2)"
    frame = lambda rows: spark.createDataFrame(list(rows), schema)
    for batch in range(4):
        before, after = [], []
        for i in draw.sample(range(40), 15):
            if i in state:
                before.append(state.pop(i))
            if draw.random() < 0.7:
                amount = None if draw.random() < 0.2 else Decimal(draw.randint(1, 999))
                state[i] = (i, datetime.datetime(2024, 1, draw.randint(1, 6), 5), draw.choice("ab"), amount)
                after.append(state[i])
        sums = window_changes(frame(before), frame(after), "day", "amount", ["kind"])
        for _ in range(2):  # a repeated run adds nothing
            maintain_windows(spark, path, sums, batch, ["kind"])
        kept = window_totals(spark.read.parquet(path), ["kind"])
        rebuilt = totals_by_window(frame(state.values()), "day", "amount", ["kind"])
        assert values(kept, *rebuilt.columns) == values(rebuilt)


def test_only_touched_windows_are_rewritten(spark, tmp_path):
    path = tmp_path / "gold"
    rows = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01' + make_interval(0, 0, 0, CAST(id AS INT)) AS day, 5L AS amount FROM range(5)")
    maintain_windows(spark, str(path), window_changes(rows.limit(0), rows, "day", "amount"), 0)
    files = lambda: {f.parent.name: f.name for f in path.glob("window=*/*.parquet")}
    first = files()
    gone = rows.where("day = '2024-01-03'")
    maintain_windows(spark, str(path), window_changes(gone, gone.limit(0), "day", "amount"), 1)
    assert len(first) == 5 and {w for w in first if files()[w] != first[w]} == {"window=w20240103000000"}
    assert window_totals(spark.read.parquet(str(path))).count() == 4


# -- references of a slice


def test_reference_deltas_find_what_the_slice_broke(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "id INT, name STRING")
    children = spark.createDataFrame([(10, 1), (11, 3), (12, 9), (13, None), (14, 3), (15, 4)], "id INT, p INT")
    changed = children.where("id IN (11, 12, 13)")
    deleted = spark.createDataFrame([(3, "c"), (4, "old"), (5, "e")], parents.schema)  # 4 came back
    found = reference_deltas({"parent": parents, "child": children}, {"child": changed}, {"parent": deleted}, [CHILD])
    assert values(found, "cause", "violations") == [("changed", 2), ("deleted", 1)]
    only = reference_deltas({"parent": parents, "child": children}, {"child": changed}, {}, [CHILD])
    assert values(only, "cause", "violations") == [("changed", 2)]
    with pytest.raises(ValueError, match="neither"):
        reference_deltas({"parent": parents, "child": children}, {}, {}, [CHILD])
    with pytest.raises(ValueError, match="not given"):
        reference_deltas({"child": children}, {"child": changed}, {}, [CHILD])


# -- dead letters


def test_dead_letters_of_two_runs_and_a_repeated_batch(spark, messages, tmp_path, monkeypatch):
    spec = TableSpec("accounts", ("id",), "id STRING NOT NULL, value STRING")  # named like the payload
    bronze = Bronze(str(tmp_path / "bronze"), buckets=2, dead_letters=str(tmp_path / "dead"))
    good = lambda i: envelope("c", after={"id": i, "value": "1"})
    first = messages([("accounts", 0, 0, "{bad"), ("accounts", 0, 1, good("a")), ("accounts", 1, 0, "[]")])
    second = messages([("accounts", 0, 2, "null"), ("accounts", 1, 1, good("b"))])
    plans = []
    split = jobs.split_dead_letters

    def watched(changes, keys):
        plans.append(physical_plan(changes))
        return split(changes, keys)

    monkeypatch.setattr(jobs, "split_dead_letters", watched)
    for batch, rows in ((("s", 0), first), (("s", 0), first), (("s", 1), second), (None, first.union(second))):
        apply_messages(spark, rows, spec, bronze, batch)
    dead = dead_letters(spark, bronze.dead_letters)
    assert values(dead, "kafka_partition", "kafka_offset", "value") == [(0, 0, "{bad"), (0, 2, "null"), (1, 0, "[]")]
    assert values(bronze.table(spark, spec).read(), "id", "value") == [("a", "1"), ("b", "1")]
    # Both outputs read the staged slice; the payload is decoded before, once.
    assert len(plans) == 4 and not any("from_json" in p or "JsonToStructs" in p for p in plans)
    assert sorted(p.name for p in (tmp_path / "dead" / "table=accounts").glob("slice=s-*")) == ["slice=s-0", "slice=s-1"]


def test_gold_decodes_each_run_once(spark, monkeypatch):
    from conftest import physical_plan
    from tidemark.plans import queries

    plans, images = [], queries.images
    monkeypatch.setattr(queries, "images", lambda old, changes, *rest: (plans.append(physical_plan(changes)), images(old, changes, *rest))[1])
    assert queries.gold_incremental(spark, "/root/testdata/sf0.001").count() > 0
    assert len(plans) == 2 and all("from_json" not in p and "FileScan" in p for p in plans)


def test_changes_staged_by_the_caller_are_not_staged_again(spark, changes, tmp_path):
    from tidemark.sources import state_table

    table = state_table.StateTable(spark, str(tmp_path / "t"), ["id"], 2)
    table.apply(changes([("a", "1", 1, 1, False), ("b", "1", 1, 2, False)]), "upsert_delete")
    path = str(tmp_path / "staged")
    changes([("a", "2", 2, 3, False), ("b", None, 2, 4, True)]).write.parquet(path)
    asked = []
    original, state_table.new_folder = state_table.new_folder, lambda *a: asked.append(a) or original(*a)
    try:
        assert table.apply(spark.read.parquet(path), "upsert_delete", staged_at=path)
    finally:
        state_table.new_folder = original
    assert not asked and spark.read.parquet(path).count() == 2
    assert [(r["id"], r["v"]) for r in table.read().collect()] == [("a", "2")]

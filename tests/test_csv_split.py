"""CSV files cut at any byte give the records that one task reads."""

import csv
import io
import random

import pytest

from conftest import values
from tidemark.model import TableSpec
from tidemark.plans.seeds import Seed, load_seeds
from tidemark.sources.csv import load_csv, read_csv
from tidemark.sources.csv_split import csv_records

SPEC = TableSpec("notes", ("id",), "id BIGINT NOT NULL, note STRING, more STRING")


def text_of(rows, end="\n"):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerows(rows)
    return out.getvalue()


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def cut(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 0)

    yield cut
    for name, value in old.items():
        spark.conf.set(name, value)


def note(draw):
    parts = ['"', '""', ",", "\n", "\n\n", " ", "a", "word", "é中", '\n"\n', "x" * 30]
    return "".join(draw.choices(parts, k=draw.choice([0, 1, 3, 8, 25]))).strip()


@pytest.mark.parametrize("size", [7, 40, 400, 100_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_rows_match_a_plain_reader(spark, small_blocks, tmp_path, size, end):
    draw = random.Random(size)
    rows = [(str(i), note(draw), note(draw)) for i in range(60)]
    rows.append(("60", "\n".join(["long", ""] * 300), 'ends "quoted"'))
    rows.append(("61", "last", ""))
    path = tmp_path / "notes.csv"
    body = text_of([("id", "note", "more"), *rows], end)
    path.write_text(body[: -len(end)] if size == 40 else body, encoding="utf-8", newline="")
    small_blocks(size)
    read = read_csv(spark, str(path), SPEC, split=True)
    assert sorted(values(read)) == sorted((i, a or None, b or None) for i, a, b in rows)


def test_several_files_and_blank_lines(spark, small_blocks, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text('\n\n"id",note,more\n\n1,"a\n\n""b""",\n\n\n2,,x\n\n')
    (tmp_path / "in" / "2.csv").write_text("id,note,more\n3,c,d")
    (tmp_path / "in" / "3.csv").write_text("id,note,more\n")
    (tmp_path / "in" / "4.csv").write_text("")
    for size in (3, 1000):
        small_blocks(size)
        rows = read_csv(spark, str(tmp_path / "in"), SPEC, split=True)
        assert sorted(values(rows)) == [("1", 'a\n\n"b"', None), ("2", None, "x"), ("3", "c", "d")]
    landing = str(tmp_path / "landing")
    assert load_csv(spark, str(tmp_path / "in"), SPEC, landing, split=True) == 3
    assert load_csv(spark, str(tmp_path / "missing"), SPEC, landing, split=True) is None


def test_files_that_disagree_fail(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text("id,note\n1,x\n")
    (tmp_path / "a" / "2.csv").write_text("note,id\ny,2\n")
    (tmp_path / "b.csv").write_text("id,note\n1,x,surplus\n")
    for path in ("a", "b.csv"):
        with pytest.raises(Exception):  # noqa: B017 - any reader error
            read_csv(spark, str(tmp_path / path), SPEC, split=True).collect()


def test_one_file_is_read_by_several_tasks_with_one_shuffle_of_lines(spark, small_blocks, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_text(text_of([("id", "note", "more"), *((str(i), f"a\n{i}", "") for i in range(2000))]))
    small_blocks(2000)
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 5
    plan = csv_records(spark, str(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    assert read_csv(spark, str(path), SPEC, split=True).count() == 2000


def test_seed_files_may_be_split(spark, small_blocks, tmp_path):
    spec = TableSpec("notes", ("id",), "id INT NOT NULL, name STRING")
    names = [f'"{k}"\n\n{k}' for k in range(50)]
    (tmp_path / "notes.csv").write_text(text_of([("name",), *((n,) for n in names)]))
    small_blocks(100)
    landed = str(tmp_path / "landed")
    seeds = (Seed("notes", "notes.csv", generated="id", split=True),)
    (row,) = load_seeds(spark, str(tmp_path), landed, seeds, {"notes": spec}).collect()
    assert (row["status"], row["file_rows"], row["stored_rows"]) == ("LOADED", 50, 50)
    stored = spark.read.parquet(f"{landed}/notes").collect()
    assert sorted(r["name"] for r in stored) == sorted(names)
    assert sorted(int(r["id"]) for r in stored) == list(range(1, 51))

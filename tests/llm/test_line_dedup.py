import random
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm import line_dedup as D

from .conftest import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\v\f\r"


def key(line):
    return line.strip(SPACE).translate(LOWER)


def brute(rows):
    """(doc_id, lines, dropped, text) of every row."""
    place = lambda i: float("inf") if i is None else i
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(place(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= 10 and min(holders[key(x)]) != place(i))]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def found(docs, **options):
    rows = D.dedup_lines(docs, **options).select("doc_id", "n_lines", "n_dropped", "text").collect()
    return sorted(map(tuple, rows), key=str)


def test_matches_brute_force_for_any_number_of_batches(documents):
    draw = random.Random(2)
    pool = [sentence(draw, draw.randint(1, 6)) for _ in range(40)] + ["é" * 9, "é" * 10, "short"]
    pad = lambda x: draw.choice(["", " ", "\t"]) + (x.upper() if draw.random() < 0.2 else x) + draw.choice(["", " \r"])
    rows = [(i, "\n".join(pad(draw.choice(pool)) for _ in range(draw.randint(0, 12)))) for i in range(0, 120, 3)]
    rows += [(i, "the one line that many documents hold\n" + sentence(draw, 5)) for i in range(1, 120, 3)]
    draw.shuffle(rows)
    for batches in (1, 3, 5):
        assert found(documents(rows), batches=batches) == brute(rows)


def test_odd_rows_and_empty_table(documents, odd_rows):
    assert found(documents(odd_rows)) == brute(odd_rows)
    assert found(documents([])) == []


def test_extra_columns_stay(documents, odd_rows):
    docs = documents(odd_rows)
    out = D.dedup_lines(docs, tally=("lines_", "dropped_"))
    assert out.columns == [*docs.columns, "lines_", "dropped_"]
    assert out.where("n_lines != 'x'").count() == 0


def test_runs_are_compacted_and_hold_each_key_once(spark):
    index = D.LineIndex(spark)
    for batch in range(5):
        rows = [(bytes([batch, k]), batch * 10) for k in range(4)] + [(b"all", batch * 10 + 1)]
        lost = index.add(spark.createDataFrame(rows, "hash BINARY, doc BIGINT"))
        assert [bytes(r["hash"]) for r in lost.collect()] == ([b"all"] if batch else [])
    assert [len(level) for level in index.levels] == [1, 0, 1]
    known = index._known()
    assert known.count() == known.select("hash").distinct().count() == 21
    assert known.where(F.col("hash") == b"all").first()["owner"] == 1

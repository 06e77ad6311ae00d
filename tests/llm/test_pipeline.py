"""The pipeline against plain Python, stage by stage and as a whole."""

import hashlib
import random

import pytest

import corpus_pipeline as C
from tidemark.llm import pieces
from tidemark.llm.common import table

from .conftest import sentence
from .test_near_dedup import LOWER, brute, edited

BLANK = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(61)
    items = [(i, f"{sentence(draw, 15)}.\n{sentence(draw, 12)}.") for i in range(6)]
    shared = [sentence(draw, 8) for _ in range(4)]
    texts = []
    for _ in range(40):
        lines = [sentence(draw, draw.randint(1, 12)) for _ in range(draw.randint(1, 12))]
        for line in draw.sample(shared, draw.randint(0, 2)):
            lines.insert(draw.randint(0, len(lines)), f"  {line.upper()}\t")
        texts.append("\n".join(lines))
    base = sentence(draw, 200)
    texts += [edited(draw, base, 0.003) for _ in range(6)]
    texts += [f"{sentence(draw, 50)} {t} {sentence(draw, 50)}" for _, t in items]
    texts += [None, "", " \n ", "12 34 !!", "²", "short line\nshort line", "a\x00b é \U0001f600"]
    draw.shuffle(texts)
    rows = [(3 * i, t, "en" if i % 5 else None, "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(items, "item_id BIGINT, text STRING").write.parquet(str(path / "benchmark.parquet"))
    return str(path), rows, items


def with_letters(docs):
    return {i: t for i, t in docs.items() if any(c.isalpha() for c in t or "")}


def without_repeated_lines(docs):
    key = lambda line: line.strip(BLANK).translate(LOWER)
    holders = {}
    for i, t in docs.items():
        for line in t.split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i)
    gone = lambda i, line: len(holders.get(key(line), ())) > 1 and min(holders[key(line)]) != i
    return {i: "\n".join(x for x in t.split("\n") if not gone(i, x)) for i, t in docs.items()}


def without_near_copies(docs):
    roots = brute(sorted(docs.items()), 5)
    return {i: t for i, t in docs.items() if roots[i][1] == i}


def without_items(docs, items):
    fold = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    return {i: t for i, t in docs.items() if not any(f" {fold(item)} " in f" {fold(t)} " for _, item in items)}


def test_every_stage_and_the_whole_equal_plain_python(spark, folder):
    path, rows, items = folder
    expected = {i: t for i, t, *_ in rows}
    steps = [with_letters, without_repeated_lines, without_near_copies, lambda d: without_items(d, items)]
    docs = table(spark, path, "documents")
    for (name, stage), step in zip(C.STAGES[:-1], steps, strict=True):
        before, expected = expected, step(expected)
        docs = C.stored(stage(spark, docs, path), f"test-{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == expected, name
        assert before != expected, name
    found = {r["doc_id"]: r for r in C.run(spark, path).collect()}
    assert found.keys() == expected.keys()
    for i, text in expected.items():
        assert found[i]["lossless"] and found[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    ids = {r["doc_id"]: r["ids"] for r in pieces.encode(docs).collect()}
    packed = lambda x: hashlib.sha256(b"".join(k.to_bytes(4, "little") for k in x)).hexdigest()
    assert {i: (len(x), packed(x)) for i, x in ids.items()} == {i: (r["n_pieces"], r["ids_sha256"]) for i, r in found.items()}


def test_lengths_follow_the_text_and_other_columns_stay(spark, folder):
    path, rows, _ = folder
    docs = table(spark, path, "documents").selectExpr("*", "source AS n_lines")
    for name, stage in C.STAGES[:-1]:
        docs = C.stored(stage(spark, docs, path), f"test-{name}")
        assert docs.columns[-1] == "n_lines"
    of = {i: (lang, source) for i, _, lang, source, _ in rows}
    for r in docs.collect():
        assert r["n_chars"] == len(r["text"]) and (r["lang"], r["source"]) == of[r["doc_id"]] and r["n_lines"] == "s"


def test_empty_tables_go_through_all_stages(spark, tmp_path, folder):
    path, _, _ = folder
    for name in ("documents", "benchmark"):
        table(spark, path, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0

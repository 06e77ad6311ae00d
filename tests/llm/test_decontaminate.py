import random

import numpy as np

from tidemark.llm import decontaminate as D

from .conftest import sentence


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id BIGINT, text STRING")


def world(draw):
    common = [sentence(draw, 1) for _ in range(8)]
    speak = lambda n: " ".join(draw.choice(common) if draw.random() < 0.4 else sentence(draw, 1) for _ in range(n))
    items = [(i, f"{speak(draw.randint(6, 30))}.\n{speak(draw.randint(1, 9))}.") for i in range(40)]
    rows = []
    for i in range(120):
        text = speak(draw.randint(0, 200))
        if i % 4 == 0:
            text += " " + draw.choice(items)[1].upper() + " " + speak(30)
        if i % 9 == 0:
            text += " " + draw.choice(items)[1].split("\n")[0]  # a question alone
        rows.append((i, text))
    return items, rows


def brute(items, rows, threshold, overlap):
    """Score every passage against every item, then verify."""
    index = next(iter([D.build_index(*statistics(items))]))
    out = set()
    for i, text in rows:
        words = D.terms((text or "").encode())
        steps = range(0, max(1, len(words)), index.window)
        for at, (item, _) in enumerate(items):
            best = 0.0
            for s in steps:
                held = {index.vocabulary[w] for w in words[s : s + 2 * index.window] if w in index.vocabulary}
                best = max(best, sum(x for r in held for a, x in index.postings[r].get(at // D.BLOCK, ()) if a == at))
            parts = index.parts[at]
            shares = [len(p & D.grams(words, len(next(iter(p))))) / len(p) if p else 1.0 for p in parts]
            if best >= threshold and min(shares) >= overlap:
                out.add((i, item))
            question, answer = D.question_answer(items[at][1].encode())
            if answer and len(question) >= D.LONE and parts[0] <= D.grams(words, len(next(iter(parts[0])))):
                out.add((i, item))  # the whole question without its answer
    return out


def statistics(items):
    raw = [(i, t.encode()) for i, t in items]
    words = [D.terms(t) for _, t in raw]
    counts = {}
    for w in words:
        for x in set(w):
            counts[x] = counts.get(x, 0) + 1
    return raw, counts, len(raw), sum(map(len, words)) / len(raw)


def test_finds_what_brute_force_finds(spark, documents):
    items, rows = world(random.Random(6))
    expected = brute(items, rows, D.SCORE, D.OVERLAP)
    found = D.find_leaks(documents(rows), items_of(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected and len(expected) >= 30
    clean = D.drop_leaks(documents(rows), items_of(spark, items))
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows} - {i for i, _ in expected}


def test_shards_find_the_same(spark, documents, monkeypatch):
    items, rows = world(random.Random(7))
    docs, table = documents(rows), items_of(spark, items)
    whole = {(r["doc_id"], r["item_id"], round(r["bm25"], 9)) for r in D.find_leaks(docs, table).collect()}
    parts = list(D.item_shards(table, shard=11))
    assert len(parts) == 4 and sum(p.home.count(None) for p in parts) == 40
    split = {
        (i, part.ids[x[0]], round(x[2], 9))
        for part in parts
        for (i, _), held in zip(rows, D.leaks(part, [t.encode() for _, t in rows], D.SCORE, D.OVERLAP), strict=True)
        for x in held
    }
    assert {x[:2] for x in split} == {x[:2] for x in whole}


def test_bounds_never_lose_a_passage():
    items, rows = world(random.Random(9))
    index = D.build_index(*statistics(items))
    texts = [np.array([index.vocabulary.get(w, -1) for w in D.terms(t.encode())], np.int64) for _, t in rows]
    for threshold in (0.2, 0.6):
        best = D.retrieve(index, texts, threshold)
        for x, found in zip(texts, best, strict=True):
            for at in range(len(items)):
                score = 0.0
                for s in range(0, max(1, len(x)), index.window):
                    held = {r for r in x[s : s + 2 * index.window].tolist() if r >= 0}
                    score = max(score, sum(v for r in held for a, v in index.postings[r].get(at // D.BLOCK, ()) if a == at))
                assert (score >= threshold) == (at in found) or abs(score - threshold) < 1e-9


def test_odd_rows_and_items(spark, documents, odd_rows):
    items = items_of(spark, [(1, None), (2, ""), (3, "one two three four five six"), (4, "one two three four five six"), (5, "?!"), (None, "no id at all but some words")])
    found = D.find_leaks(documents(odd_rows), items).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in found), key=str) == [(11, 3), (11, 4), (None, None)]
    nothing = items_of(spark, [(1, None), (2, " ")])
    assert D.find_leaks(documents(odd_rows), nothing).collect() == []
    assert D.drop_leaks(documents(odd_rows), nothing).count() == len(odd_rows)
    assert D.find_leaks(documents([]), items).collect() == []


def test_edited_answers_and_lone_questions_are_found(spark, documents):
    draw = random.Random(21)
    items = [(n, f"{sentence(draw, 20)}.\n{sentence(draw, n)}.") for n in range(2, 21)]
    rows, expected = [], set()
    for n, text in items:
        question, answer = text.split("\n")
        for k in range(n):
            words = answer.split(" ")
            words[k] = "changed"
            rows.append((100 * n + k, f"{sentence(draw, 40)} {question} {' '.join(words)} {sentence(draw, 40)}"))
            expected.add((100 * n + k, n))
        rows.append((100 * n + 99, f"{sentence(draw, 60)} {question} {sentence(draw, 60)}"))
    alone = {(100 * n + 99, n) for n, _ in items}
    docs, table = documents(rows), items_of(spark, items)
    found = [(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, table).collect()]
    assert sorted(found) == sorted(expected | alone)
    assert D.drop_leaks(docs, table).count() == 0


def test_all_shards_have_one_window(spark):
    items = items_of(spark, [(i, "one two three. four five") for i in range(30)] + [(99, "word " * 70)])
    parts = list(D.item_shards(items, shard=5))
    assert len(parts) > 3 and {p.window for p in parts} == {70}

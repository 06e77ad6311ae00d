import math
import random
import re
from collections import Counter

import numpy as np

from tidemark.llm import lexical_search as S

from .conftest import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, k=50):
    """(item, rank, document, score), each document scored for each item by the formulas."""
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, w) for i, w in docs if w]
    n_docs, n_terms = len(docs), sum(w.total() for _, w in docs)
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(terms(t))
    out = []
    for item, asked in queries.items():
        df = {t: sum(t in w for _, w in docs) for t in asked}
        found = []
        for i, words in docs:
            m = 100 - 50 + (50 * words.total() * n_docs) // n_terms
            score = 0
            for t in asked:
                tf = words[t]
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                        (1000000000 * tf) // (1000 * tf + 20 * m)
                    )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def collected(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def world(draw):
    common = [sentence(draw, 1) for _ in range(30)]
    speak = lambda n: " ".join(draw.choice(common) if draw.random() < 0.7 else sentence(draw, 1) for _ in range(n))
    rows = [(i, speak(draw.randint(0, 80))) for i in range(150)]
    copy = speak(40)
    rows += [(1000 - i, copy) for i in range(120)]  # more equal scores than places
    items = [(i, f"{speak(draw.randint(1, 20))}? {speak(3).upper()}.") for i in range(20)] + [(50, copy), (51, "zzzzzzzzzz")]
    return rows, items


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id BIGINT, text STRING, score INT, rank STRING")


def test_ranks_equal_brute_force_with_more_ties_than_places(spark, documents):
    rows, items = world(random.Random(31))
    expected = brute(rows, items)
    assert collected(S.search(documents(rows).repartition(7), items_of(spark, items))) == expected
    ties = sorted(x[1:3] for x in expected if x[0] == 50)
    assert len(ties) == 50 and [d for _, d in ties] == list(range(881, 931))


def test_blocks_and_tiles_of_any_size_give_the_same(spark, documents, monkeypatch):
    rows, items = world(random.Random(32))
    monkeypatch.setattr(S, "ITEM_TILE", 3)
    monkeypatch.setattr(S, "DOC_TILE", 16)
    monkeypatch.setattr(S, "WIDTH", 2)
    found = S.search(documents(rows).repartition(3), items_of(spark, items), k=7, block_terms=40)
    assert len(list(S.item_blocks(items_of(spark, items), 40))) > 3
    assert collected(found) == brute(rows, items, 7)


def test_odd_rows_have_defined_results(spark, documents, odd_rows):
    items = [(1, None), (2, ""), (3, "?!"), (4, "some words, the TEXT of x"), (4, "123 456 é"), (None, "same id"), (5, odd_rows[6][1])]
    assert collected(S.search(documents(odd_rows), items_of(spark, items))) == brute(odd_rows, items)


def test_empty_tables(spark, documents):
    some = items_of(spark, [(1, "a b")])
    assert collected(S.search(documents([]), some)) == []
    assert collected(S.search(documents([(1, "a b")]), items_of(spark, []))) == []
    assert collected(S.search(documents([(1, None)]), some)) == []


def test_products_are_exact_at_the_bound():
    weights = np.array([30_000] * 5000, np.int64)
    tile = S.ItemTile(0, [np.arange(5000)], weights)
    assert tile.width * 30_000 * 1_000_000 < 1 << 53
    held = np.arange(5000)
    impact = np.full(5000, 999_999, np.int64)
    assert tile.scores(np.zeros(5000, np.int64), held, impact, 1)[0, 0] == 5000 * 30_000 * 999_999
    # A length whose product with the number of documents needs more than 64 bits.
    assert S.impacts(np.array([3]), np.array([10**7]), 10**12, 10**13)[0] == 3 * 10**9 // (3000 + 20 * (50 + 50 * 10**6))

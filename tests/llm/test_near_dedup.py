import itertools
import random
import re

import numpy as np

from tidemark.llm import near_dedup as N
from tidemark.llm.components import components

from .conftest import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(rows, n):
    """doc_id to (number of shingles, component)."""
    sets = {i: grams(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited(draw, text, share):
    words = text.split(" ")
    return " ".join(sentence(draw, 1) if draw.random() < share else w for w in words)


def test_components_match_brute_force(documents):
    draw = random.Random(1)
    rows = []
    for _ in range(12):
        base = sentence(draw, draw.randint(3, 200))
        rows.append(base)
        rows += [edited(draw, base, draw.choice([0, 0.01, 0.02, 0.05])) for _ in range(draw.randint(0, 6))]
    hot = sentence(draw, 150)
    rows += [edited(draw, hot, 0.012) for _ in range(60)] + [hot] * 20
    chain = sentence(draw, 100).split(" ")  # neighbours are alike, far ones are not
    rows += [" ".join(chain[k * 4 :] + [sentence(draw, k * 4)] if k else chain) for k in range(8)]
    draw.shuffle(rows)
    rows = list(enumerate(rows))
    expected = brute(rows, 4)
    found = N.near_duplicates(documents(rows), 4).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_odd_rows_have_defined_results(documents, odd_rows):
    found = N.near_duplicates(documents(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by_id[1] == by_id[2] == by_id[3] == [(0, by_id[1][0][1], True)] or by_id[2] == [(0, 2, True)]
    assert by_id[8][0][1] == 7 and not by_id[8][0][2]
    assert {x[1] for x in by_id[10]} == {10}
    assert all(x[1] is None and x[2] for x in by_id[None])
    kept = N.drop_near_duplicates(documents(odd_rows))
    assert kept.columns == documents(odd_rows).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 8 not in ids and ids.count(10) == 1 and ids.count(None) == 2


def test_rows_that_share_an_id_stay_by_their_own_text(documents, odd_rows):
    draw = random.Random(22)
    kept = [(r["doc_id"], r["text"]) for r in N.drop_near_duplicates(documents(odd_rows)).collect()]
    assert sorted(t for i, t in kept if i == 11) == ["another text of the same id", "one two three four five six"]
    old, clean, base = (sentence(draw, 200) for _ in range(3))
    near = old + " end"
    rows = [(5, old), (20, near), (20, clean), (20, clean), (30, base), (30, base + " end"), (40, None), (40, None), (40, clean + " x")]
    rows += [(50, "some words"), (50, "Some  WORDS"), (60, ""), (60, "a text beside no text")]
    kept = [(r["doc_id"], r["text"]) for r in N.drop_near_duplicates(documents(rows)).collect()]
    assert [t for i, t in kept if i == 5] == [old]
    assert [t for i, t in kept if i == 20] == [clean]
    assert len([t for i, t in kept if i == 30]) == 1
    assert [t for i, t in kept if i == 40] == [None]
    assert len([t for i, t in kept if i == 50]) == 1
    assert sorted(t for i, t in kept if i == 60) == ["", "a text beside no text"]


def test_empty_table(documents):
    assert N.near_duplicates(documents([])).collect() == []
    assert N.drop_near_duplicates(documents([])).collect() == []


def test_every_coordinate_fills_and_agreement_estimates_similarity():
    draw = np.random.default_rng(3)
    for size in (1, 2, 7, 300):
        assert (N.sketch([draw.integers(0, 2**63, size).astype(np.uint64)]) != np.iinfo(np.uint64).max).all()
    common = draw.integers(0, 2**63, 800).astype(np.uint64)
    extra = draw.integers(0, 2**63, 200).astype(np.uint64)
    a, b = N.sketch([common, np.concatenate([common, extra])])
    assert abs((a == b).mean() - 0.8) < 0.12
    alone = N.sketch([common])[0]
    assert (alone == a).all()  # a sketch does not depend on its batch


def test_components_of_chains_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (201, 202), (202, 201)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert all(found[i] == 0 for i in range(41))
    assert all(found[i] == 100 for i in range(100, 160))
    assert found[201] == found[202] == 201
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0

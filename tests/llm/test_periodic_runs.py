import random
import re
import time
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import periodic_runs as P, queries

from .conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """All runs: for each distance the maximal stretches of equal words, and the smallest period of each."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        start = 0
        for i in range(n - p + 1):
            if i == n - p or words[i] != words[i + p]:
                if i - start >= p and i - start + p >= 12:
                    found.setdefault((start, i + p), p)  # shorter periods come first
                start = i + 1
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def mutated(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def digest(doc_id, text):
    words = mutated(doc_id, text)
    runs = brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + x for s, x, q in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{x},{q}\n" for s, x, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha256(listed.encode()).hexdigest(), sha256(" ".join(kept).encode()).hexdigest())


def repeated(draw, letters, n):
    """Words with nested and overlapping repetitions."""
    words = []
    while len(words) < n:
        piece = [draw.choice(letters) for _ in range(draw.randint(1, 12))]
        if words and draw.random() < 0.4:
            begin = draw.randrange(len(words))
            piece = words[begin : begin + draw.randint(1, 40)]
        words += piece * draw.choice([1, 1, 2, 3, 7])
        words += [draw.choice(letters)] * draw.choice([0, 0, 1, 5, 15])
    return words[:n]


def test_runs_equal_brute_force():
    draw = random.Random(41)
    for round_ in range(150):
        words = repeated(draw, "ab"[: draw.randint(1, 2)] if round_ % 3 else "abcdefgh", draw.randint(0, 260))
        assert P.text_runs([w.encode() for w in words]) == brute(words)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_words_appended_one_by_one_or_in_parts_give_the_same(words, steps):
    """After every append the runs are those of the words so far."""
    one, parts, at, k = P.Catchers(), P.Catchers(), 0, 0
    for i, w in enumerate(words):
        one.append(np.array([w]))
        if i % 7 == 0:
            assert one.runs() == brute(words[: i + 1])
    while at < len(words):
        step = steps[k % len(steps)]
        parts.append(np.array(words[at : at + step], np.int64))
        at, k = at + step, k + 1
    assert one.runs() == parts.runs() == brute(words)


@pytest.mark.parametrize("period", range(1, 70))
def test_every_period_at_every_place(period):
    """The shortest run of a period, at all offsets to the blocks."""
    for offset in range(0, 40, 1 if period < 20 else 7):
        length = max(12, 2 * period)
        words = [f"x{i}" for i in range(offset)] + [f"y{i % period}" for i in range(length)] + [f"z{i}" for i in range(9)]
        assert P.text_runs([w.encode() for w in words]) == [(offset, length, period)]
        shorter = words[: offset + length - 1] + words[offset + length :]
        assert P.text_runs([w.encode() for w in shorter]) == []


def test_query_equals_brute_force(spark, documents, odd_rows, tmp_path):
    draw = random.Random(42)
    planted = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, sentence(draw, draw.randint(0, 300))) for i in planted[:60] + list(range(5000, 5040))]
    rows += [(i, " ".join(repeated(draw, "abc", 200))) for i in (9001, 9002, 9003)]
    rows += [(-5, "a \x0b b \x1f c\x85d"), (9004, "　 one two " * 8), (9005, "same " * 11), (9006, "same\n" * 12)]
    rows += [r for r in odd_rows if r[0] not in (7, 8)]  # these are too long for the brute force
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op11_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    expected = sorted((digest(i, t) for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    assert sum(x[1] > 0 for x in expected) > 50


def test_long_texts_take_time_in_proportion():
    draw = random.Random(43)
    began = time.monotonic()
    assert P.text_runs([b"word"] * 300_000) == [(0, 300_000, 1)]
    piece = [sentence(draw, 1).encode() for _ in range(5000)]
    assert (0, 200_000, 5000) in P.text_runs(piece * 40)
    assert P.text_runs([sentence(draw, 2).replace(" ", "").encode() for _ in range(200_000)]) == []
    assert time.monotonic() - began < 60


def test_empty_table_and_collapsed_texts(documents):
    assert P.find_runs(documents([])).collect() == []
    row = P.find_runs(documents([(1, "a b " + "c d e " * 5 + "f")])).first()
    assert row["collapsed"] == "a b c d e f" and [tuple(r) for r in row["runs"]] == [(2, 15, 3)] and row["n_words"] == 18

import itertools
import random

from tidemark.llm import ngram_join as N
from tidemark.llm.common import fan_join

from .conftest import sentence
from .test_near_dedup import brute, edited, grams


def joined(docs, **options):
    found = N.join_ngrams(docs, **options)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return found.collect()


def test_components_equal_brute_force(documents):
    draw = random.Random(51)
    texts = []
    for _ in range(14):
        base = sentence(draw, draw.randint(2, 220))
        texts.append(base)
        texts += [edited(draw, base, draw.choice([0, 0.005, 0.01, 0.02, 0.04])) for _ in range(draw.randint(0, 6))]
        texts.append(base + " " + sentence(draw, draw.randint(1, 60)))
        texts.append(" ".join(base.split(" ")[draw.randint(0, 30) :]))
    hot = sentence(draw, 160)
    texts += [edited(draw, hot, 0.012) for _ in range(60)] + [hot.upper()] * 20
    chain = sentence(draw, 100).split(" ")  # neighbours are alike, far ones are not
    texts += [" ".join(chain[k * 4 :] + [sentence(draw, k * 4)] if k else chain) for k in range(8)]
    passage = sentence(draw, 60)  # half of many texts, and no link
    texts += [f"{sentence(draw, 30)} {passage} {sentence(draw, 30)}" for _ in range(50)]
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    expected = brute(rows, 5)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in joined(documents(rows))} == expected
    assert len({c for _, c in expected.values()}) < len(rows) - 100


def test_links_at_the_very_threshold(documents):
    """Sets of 45 and 45 with 40 in common are linked (80 of 100), with 39 they are not."""
    draw = random.Random(52)
    rows, wanted = [], {}
    for k in range(20):
        words = sentence(draw, 49).split(" ")
        cut = 44 if k % 2 else 43  # 44 common words at the start make 40 common shingles
        other = words[:cut] + [f"w{k}{i}" for i in range(49 - cut)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        wanted[2 * k + 1] = 2 * k if k % 2 else 2 * k + 1
    found = {r["doc_id"]: r["component_id"] for r in joined(documents(rows))}
    assert {i: found[i] for i in wanted} == wanted


def test_counts_of_fragments_sum_to_the_whole(spark):
    """Every pair's partial counts, one a fragment, add up to its intersection."""
    draw = random.Random(53)
    pool = [draw.getrandbits(63) - 2**62 for _ in range(300)]
    sets = {i: sorted(draw.sample(pool, 200)) for i in range(12)}
    frame = spark.createDataFrame([(i, len(s), s) for i, s in sets.items()], "id BIGINT, n BIGINT, grams ARRAY<BIGINT>")
    ordered = N._ordered(frame, 50)
    segments = N._segments(ordered)
    assert segments.select("fragment").distinct().count() > 3
    pairs = [(a, 200, b, 200) for a, b in itertools.combinations(sets, 2)]
    pairs = spark.createDataFrame(pairs, "a BIGINT, n BIGINT, b BIGINT, m BIGINT")
    for percent in (45, 50, 55):
        found = {(r["a"], r["b"]) for r in N._links(pairs, segments, percent).collect()}
        truth = {(a, b) for a, b in itertools.combinations(sets, 2)
                 if 100 * (c := len(set(sets[a]) & set(sets[b]))) >= percent * (400 - c)}
        assert found == truth


def test_hot_keys_are_spread_and_join_the_same(spark):
    rows = spark.createDataFrame([(1, i) for i in range(300)] + [(2, i) for i in range(5)] + [(3, 1)], "k INT, v INT")
    keyed = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "k INT, name STRING")
    found = sorted((r["k"], r["v"], r["name"]) for r in fan_join(rows, keyed, ["k"], rows["v"], share=10).collect())
    assert found == sorted([(1, i, "a") for i in range(300)] + [(2, i, "b") for i in range(5)])


def test_odd_rows_and_empty_table(documents, odd_rows):
    found = joined(documents(odd_rows))
    assert len(found) == len(odd_rows)
    of = {}
    for r in found:
        of.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert of[1] == [(0, 1)] and of[2] == [(0, 2)] and of[3] == [(0, 3)]
    assert of[8] == of[7] == [(len(grams(odd_rows[6][1], 5)), 7)]
    assert {c for _, c in of[10]} == {10} and {c for _, c in of[None]} == {None}
    assert joined(documents([])) == []

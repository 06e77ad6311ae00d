import hashlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import pieces as P


@pytest.fixture(scope="module")
def vocabulary():
    return P.load_pieces()


def sampled(vocabulary, texts, seed=0):
    keys = P.mix(np.arange(len(texts), dtype=np.uint64) + np.uint64(seed))
    return P.sample(vocabulary, pa.array([t.encode() for t in texts], pa.binary()), keys)


def test_decoding_is_lossless(vocabulary):
    texts = ["", " ", "  two  spaces ", "▁literal", "\U0001f600é\x00\n\t", "a" * 1000, "é" * 333, "x" + " " * 90, "plain words here"]
    join = P.Decoder(vocabulary)
    for seed in range(5):
        assert [join(x).decode() for x in sampled(vocabulary, texts, seed)] == texts


def test_samples_follow_the_lattice(vocabulary):
    word = b"anted"
    ids = {t: i for i, t in reversed(list(enumerate(vocabulary.text))) if t and vocabulary.weights[i] and i not in set(vocabulary.byte_ids.tolist())}

    def paths(rest):
        if not rest:
            return [()]
        return [(ids[rest[:k]], *more) for k in range(1, len(rest) + 1) if rest[:k] in ids for more in paths(rest[k:])]

    weights = {p: float(np.prod(vocabulary.weights[list(p)])) for p in paths(word)}
    total, n = sum(weights.values()), 20_000
    drawn = Counter(map(tuple, sampled(vocabulary, [word.decode()] * n)))
    assert set(drawn) <= set(weights)
    for path, weight in weights.items():
        share = weight / total
        assert abs(drawn[path] / n - share) < 5 * (share * (1 - share) / n) ** 0.5 + 1e-4


def usable(vocabulary):
    """Each piece's text and id, without the byte pieces."""
    found = enumerate(vocabulary.text)
    return {t: i for i, t in reversed(list(found)) if t and vocabulary.weights[i] and i not in set(vocabulary.byte_ids.tolist())}


def last_piece_shares(vocabulary, word):
    """For each end inside ``word``, each last piece's exact share of all segmentations up to there."""
    ids = usable(vocabulary)
    longest = max(map(len, ids))
    sums, shares = [Fraction(1)], {}
    for end in range(1, len(word) + 1):
        ways = {}
        for k in range(1, min(end, longest) + 1):
            if word[end - k : end] in ids and sums[end - k]:
                piece = ids[word[end - k : end]]
                ways[piece] = sums[end - k] * Fraction(vocabulary.weights[piece])
        sums.append(sum(ways.values(), Fraction(0)))
        shares[end] = {p: float(w / sums[-1]) for p, w in ways.items()}
    return shares


@pytest.mark.parametrize("word", [b"theinternationalization" * 9, b" " * 100, b"      indented", b" plain"])
def test_shares_are_exact_for_words_of_any_length(vocabulary, word):
    first, last, heads, start, piece, upto = P._lattice(vocabulary, pa.array([word], pa.large_binary()))
    expected = last_piece_shares(vocabulary, word)
    assert (first[0], last[0]) == (0, len(word))
    for end, shares in expected.items():
        edges = range(heads[end], heads[end + 1])
        drawn = dict(zip((int(piece[e]) for e in edges), np.diff([0.0, *np.minimum(upto[list(edges)], 1.0)]), strict=True))
        assert drawn.keys() == shares.keys()
        assert all(abs(drawn[p] - shares[p]) < 1e-9 for p in shares)


def test_pieces_of_several_spaces_and_over_64_bytes_are_drawn(vocabulary):
    spaces = {i for t, i in usable(vocabulary).items() if len(t) > 1 and not t.strip(b" ")}
    drawn = {int(i) for x in sampled(vocabulary, ["        x = 1"] * 3000) for i in x}
    assert spaces & drawn
    words, counts = P.words_of(pa.array([b"a  bc " + b"x" * 300 + b"   ", b"", b"   "], pa.large_binary()))
    assert words.to_pylist() == [b"a", b"  bc", b" " + b"x" * 300, b"   ", b"   "] and counts.tolist() == [4, 0, 1]


def test_rows_are_seeded_by_key_alone(vocabulary):
    texts = ["the reproducible segmentation of this sentence"] * 50
    keys = P.mix(np.arange(50, dtype=np.uint64))
    whole = P.sample(vocabulary, pa.array([t.encode() for t in texts], pa.binary()), keys)
    part = P.sample(vocabulary, pa.array([t.encode() for t in texts[20:30]] + [b"other words"], pa.binary()), np.append(keys[20:30], keys[0]))
    assert all((a == b).all() for a, b in zip(whole[20:30], part, strict=False))
    assert len({tuple(x) for x in whole}) > 1


def test_odd_rows_in_spark(spark, documents, odd_rows):
    docs = documents(odd_rows)
    back = P.decode(P.encode(docs))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(odd_rows, key=str)
    found = P.round_trip(docs).collect()
    assert len(found) == len(odd_rows) and all(r["lossless"] for r in found)
    digests = Counter((r["doc_id"], r["decoded_sha256"]) for r in found)
    assert digests == Counter((i, None if t is None else hashlib.sha256(t.encode()).hexdigest()) for i, t in odd_rows)
    assert P.round_trip(documents([])).count() == 0
    once, again = (sorted(map(str, P.round_trip(docs.repartition(n)).collect())) for n in (1, 7))
    assert once == again

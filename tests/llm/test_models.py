import random
import zlib

import numpy as np
import pytest

from tidemark.llm import language_id as L, quality as Q

from .conftest import sentence

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ein", "zu"], "cc": ["eau", "oi", "ét", "que"]}


def text_of(draw, language, n=40):
    return " ".join("".join(draw.choices(SYLLABLES[language], k=draw.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(8)
    return [(i, text_of(draw, language), language) for i, language in enumerate(list(SYLLABLES) * 60)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")


def test_held_out_languages_are_found(spark, corpus):
    docs = frame(spark, corpus)
    model = L.fit_language_model(docs, per_language=20, landmarks=12)
    found = {r["doc_id"]: r["lang_pred"] for r in L.detect_language(docs, model).collect()}
    held = [(i, x) for i, _, x in corpus if zlib.crc32(str(i).encode()) % 3 == 1]
    assert held and all(found[i] == x for i, x in held)


def test_labels_of_held_out_rows_are_not_learned(spark, corpus):
    held = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else x) for i, t, x in corpus]
    assert "zz" not in L.fit_language_model(frame(spark, held), per_language=20, landmarks=12).languages


def test_kernel_equals_its_definition(corpus):
    texts = [t.encode() for _, t, _ in corpus[:6]] + [b"", b"12 !"]
    rows, codes = L.ngrams(texts)
    for k, text in enumerate(texts):
        folded = text.translate(L._FOLD)
        expected = {folded[i : i + n] for n in (1, 2, 3) for i in range(len(folded) - n + 1)}
        assert (rows == k).sum() == len(expected)


def explicit(texts, names, chosen, ridge, asked):
    """Nyström ridge regression straight from its definition, on sets of n-grams."""
    languages = sorted(set(names))
    grams = lambda t: {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    pure = lambda ts: [{g for g in grams(t.translate(L._FOLD)) if 0 not in g} for t in ts]
    kernel = lambda a, b: np.array([[len(x & y) / np.sqrt(max(len(x), 1) * max(len(y), 1)) for y in b] for x in a])
    marks = pure([texts[i] for i in chosen])
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    phi = lambda ts: np.hstack([kernel(pure(ts), marks) @ root, np.ones((len(ts), 1))])
    y = np.array([[1.0 if x == n else -1.0 for n in languages] for x in names])
    x = phi(texts)
    w = np.linalg.solve(x.T @ x + ridge * np.eye(x.shape[1]), x.T @ y)
    raw = phi(asked) @ w
    odds = np.exp(L._SLOPE * (raw - raw.max(1, keepdims=True)))
    return [languages[k] for k in raw.argmax(1)], (odds / odds.sum(1, keepdims=True)).max(1)


def test_scores_equal_the_explicit_kernel(corpus):
    texts, names = [t.encode() for _, t, _ in corpus[:60]], [x for _, _, x in corpus[:60]]
    asked = [t.encode() for _, t, _ in corpus[60:120]] + [b"eau ka zu", b"q", texts[0] * 30]
    chosen = [j for n in sorted(set(names)) for j in [i for i, x in enumerate(names) if x == n][:3]]
    expected, odds = explicit(texts, names, chosen, 0.1, asked)
    labels, scores = L.predict(L.fit_kernel(texts, names, landmarks=9, ridge=0.1), asked)
    assert labels == expected and np.allclose(scores, odds, atol=1e-4)


def test_spread_fit_equals_the_fit_in_one_place(spark, corpus):
    docs = frame(spark, corpus + corpus[:50] + [(5, "zzz of the same id", corpus[5][2])])
    model = L.fit_language_model(docs, per_language=20, landmarks=12)
    names, sample = L.training_sample(docs, 20)
    rows = sorted(tuple(r) for r in sample.select("lang", "rank", "text").collect())
    assert [rank for _, rank, _ in rows] == list(range(1, 21)) * 3 and names == ("aa", "bb", "cc")
    texts = dict((t, None) for _, t, _ in corpus)
    assert all(t in texts for _, _, t in rows)
    whole = L.fit_kernel([t.encode() for _, _, t in rows], [x for x, _, _ in rows], 12, 0.1)
    assert np.array_equal(model.codes, whole.codes) and np.allclose(model.weights, whole.weights, atol=1e-5)
    again = L.fit_language_model(docs.repartition(5), per_language=20, landmarks=12)
    assert np.array_equal(model.weights, again.weights)


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_LANGUAGES", 2)
    rows = [(i, f"text {i}", f"l{i % 3}") for i in range(30)]
    with pytest.raises(ValueError, match="languages"):
        L.fit_language_model(frame(spark, rows))


def test_odd_texts_and_missing_labels(spark, documents, odd_rows, corpus):
    model = L.fit_language_model(frame(spark, corpus), per_language=20, landmarks=12)
    found = L.detect_language(documents(odd_rows), model).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        if r["doc_id"] in (1, 2, 3, 4, 12):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    kept = L.keep_known_language(documents(odd_rows), model)
    assert kept.columns == documents(odd_rows).columns
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({1, 2, 3, 4, 12})
    none = L.fit_language_model(frame(spark, [(1, "text", None), (2, None, "aa")]))
    assert {r["lang_pred"] for r in L.detect_language(documents(odd_rows), none).collect()} == {"und"}
    stay = sorted((r["doc_id"], r["text"]) for r in L.keep_known_language(documents(odd_rows), none).collect() if r["doc_id"])
    assert stay == sorted((i, t) for i, t in odd_rows if i and L.has_letter((t or "").encode()))
    assert L.detect_language(documents([]), model).collect() == []


def test_pairs_rank_good_texts_first():
    draw = np.random.default_rng(1)
    good, bad = draw.normal(1, 0.4, (80, 5)), draw.normal(-1, 0.4, (40, 5))
    model = Q.fit_pairs(good, bad)
    assert (model.score(good) >= Q.THRESHOLD).mean() > 0.97 and (model.score(bad) < Q.THRESHOLD).mean() > 0.97
    assert Q.fit_pairs(good, bad[:0]) is None


def test_quality_on_held_out_rows(spark):
    draw = random.Random(3)
    rows = []
    for i in range(300):
        clean = sentence(draw, draw.randint(20, 80)).capitalize() + "."
        rows.append((i, clean if i % 3 else clean.upper().replace(" ", "!! "), int(i % 3 > 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (5, None)], "doc_id BIGINT, quality INT")
    model = Q.fit_quality_model(docs, labels, per_label=60)
    found = {r["doc_id"]: r["score"] for r in Q.score_quality(docs, model).collect()}
    held = [(i, q) for i, _, q in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all((found[i] >= Q.THRESHOLD) == bool(q) for i, q in held)


def test_threshold_is_the_share_of_bad_texts_among_all_labels(spark):
    """A small sample gives the threshold of the whole, and so the same decisions."""
    draw = random.Random(4)
    rows = []
    for i in range(2000):
        noise = draw.randint(0, 30)  # from clean to marked all over
        words = [w + ("!!" if draw.random() < noise / 30 else "") for w in sentence(draw, 60).split(" ")]
        rows.append((i, " ".join(words), int(noise > 3)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(7, 1 - rows[7][2]), (9, 5)], "doc_id BIGINT, quality INT")
    share = {}
    for per_label in (60, 100_000):
        model = Q.fit_quality_model(docs, labels, per_label)
        scores = [r["score"] for r in Q.score_quality(docs, model).collect()]
        share[per_label] = sum(s < Q.THRESHOLD for s in scores) / len(rows)
    bad = sum(not q for _, _, q in rows) / len(rows)
    assert bad < 0.2 and all(abs(s - bad) < 0.05 for s in share.values()), (bad, share)


def test_weighted_quantile():
    scores = np.array([5.0, 1.0, 3.0, 2.0, 4.0])
    assert Q.quantile(scores, np.ones(5), 0.4) == 2.5
    assert Q.quantile(scores, np.array([1, 1, 1, 7, 0.0]), 0.8) == 2.5  # the 1 and the 2 weigh 8 of 10
    assert Q.quantile(scores, np.ones(5), 1.0) == 4.5


def test_quality_of_odd_texts(documents, odd_rows):
    model = Q.fit_pairs(np.eye(len(Q.FEATURES)), -np.eye(len(Q.FEATURES)))
    for used in (model, None):
        found = Q.score_quality(documents(odd_rows), used).collect()
        assert len(found) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in found)
    assert Q.score_quality(documents([]), model).collect() == []
    assert all(np.isfinite(Q.features(t or "")).all() for _, t in odd_rows)


def test_numerals_are_no_letters():
    assert [L.has_letter(t.encode()) for t in ("", "12 ²½①_", "² é", "語", "\U0001f600")] == [False, False, True, True, False]


def test_all_labelled_rows_are_learned_from(spark):
    """Cells smaller than the labels: moments and threshold are those of all rows, and copies cost no row its pairs."""
    draw = random.Random(6)
    rows = [(i, sentence(draw, 30) + "!!" * draw.randint(0, 9), int(i % 9 > 0)) for i in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id BIGINT, quality INT")
    kept = [(Q.features(t), q) for i, t, q in rows if zlib.crc32(str(i).encode()) % 5]
    x, q = np.array([f for f, _ in kept]), np.array([q for _, q in kept])
    for per_label in (50, 4000):
        model = Q.fit_quality_model(docs, labels, per_label)
        assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.spread, np.maximum(x.std(0), 1e-6))
        assert np.isclose(model.threshold, Q.quantile(model.rank(x), np.ones(len(q)), (q == 0).mean()))
    whole = Q.fit_pairs(x[q == 1], x[q == 0])  # one cell: the model of the rows in memory
    assert np.allclose(model.weights, whole.weights, atol=1e-6) and np.isclose(model.threshold, whole.threshold)


def test_values_at_a_place(spark):
    values = [3.0, -1.5, 2.0, 2.0, 2.0, 1e300, 0.0, 5e-324]
    frame = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    ordered = sorted(values)
    for k in range(len(values) - 1):
        assert Q._smallest(frame, "v", k, bins=3) == (ordered[k], ordered[k + 1])

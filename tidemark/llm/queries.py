"""The registered queries of the operators and the pipeline, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    decontaminate, fingerprints, language_id, lexical_search, licenses, line_dedup, near_dedup, ngram_join,
    periodic_runs, pieces, quality, secrets, warc,
)
from tidemark.llm.common import stored, table

#: Shingles of op3 are four words, as its contract says.
OP3_WORDS = 4


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, folder = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read_bundles(index, folder, payloads=False).drop("payload")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stored(quality.measure(table(spark, sf_dir, "documents")), "quality-features")
    model = quality.fit_measured(measured, table(spark, sf_dir, "labels"))
    scored = quality.score_measured(measured, model)
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), OP3_WORDS)


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(table(spark, sf_dir, "documents"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", kept)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.detect_language(docs, language_id.fit_language_model(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_digest(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(periodic_runs.planted(table(spark, sf_dir, "documents")))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(listed, "\n"), F.lit("\n"))).otherwise("")
    best = found.withColumn("best", periodic_runs.longest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(F.encode(lines, "utf-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "utf-8"), 256).alias("collapsed_sha256"),
    )


def op12_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_ngrams(table(spark, sf_dir, "documents"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc, op2_quality, op3_minhash, op4_pieces, op5_licenses, op6_lines, op7_language, op8_secrets,
        op9_fingerprints, op10_decontaminate, op11_runs, op12_ngrams,
        op13_search,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP1 = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first_id FROM p GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (payload_digest)
"""


def _near(words: int, columns: str) -> str:
    """Components of documents whose shingle sets are alike, by comparing all pairs that share a shingle."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(words) >= {words} THEN list_transform(range(1, len(words) - {words - 2}),
                                          lambda i: array_to_string(words[i:i + {words - 1}], ' '))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS grams FROM w
), g AS (SELECT doc_id, unnest(grams) AS gram FROM s),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM shared JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y
  WHERE 100 * n >= 80 * (len(a.grams) + len(b.grams) - n)
), edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, b.y FROM reach r JOIN edges b ON b.x = r.other
), lowest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, {columns}
FROM s JOIN lowest USING (doc_id)
"""

_OP3 = _near(OP3_WORDS, "component_id, doc_id = component_id AS kept")
_OP12 = _near(5, "component_id")

_OP6 = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), k AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM l),
o AS (
  SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), d AS (
  SELECT k.*, owner IS NOT NULL AND owner <> doc_id AS gone FROM k LEFT JOIN o ON k.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""


def _op5() -> str:
    gaps = r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    split = lambda text: f"list_filter(regexp_split_to_array({_LOWER.format(text)}, {gaps}), lambda x: x <> '')"
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    phrases = ", ".join(f"({listed(p.split())}, '{label}')" for p, label in licenses.PHRASES.items())
    templates = ", ".join(
        f"('{r.label}', {listed(sorted(r.ordered))}, {r.need}, CAST({listed(r.keys)} AS VARCHAR[]), {r.longest})"
        for r in licenses.rules(licenses.TEMPLATES, {}, licenses.CONTAINMENT)
    )
    return f"""
WITH p(phrase, label) AS (VALUES {phrases}), t(label, words, need, keys, longest) AS (VALUES {templates}),
w AS (SELECT doc_id, {split("coalesce(text, '')")} AS words FROM documents),
i AS (SELECT doc_id, words, unnest(range(0, len(words))) AS place FROM w),
f AS (SELECT doc_id, label, place FROM i JOIN p ON words[place + 1:place + len(phrase)] = phrase),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM f GROUP BY doc_id
), l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
b AS (SELECT doc_id, list_distinct({split("line")}) AS words FROM l),
near AS (
  SELECT doc_id, w.words AS own, t.*, unnest(range(0, len(w.words))) AS place
  FROM w JOIN t ON list_has_all(w.words, keys) AND len(list_intersect(list_distinct(w.words), t.words)) >= need
), stretches AS (
  SELECT doc_id, label, words, need, keys, list_distinct(own[place + 1:place + longest]) AS own
  FROM near WHERE list_contains(words, own[place + 1])
), blocks AS (
  SELECT doc_id, label, t.words, need, keys, b.words AS own FROM b JOIN t ON list_has_all(b.words, keys)
  UNION ALL SELECT doc_id, label, words, need, keys, own FROM stretches WHERE list_has_all(own, keys)
), m AS (
  SELECT doc_id, label, len(list_intersect(own, words)) / len(words) AS share
  FROM blocks WHERE len(list_intersect(own, words)) >= need
), found AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM
    (SELECT doc_id, label FROM f UNION ALL SELECT doc_id, label FROM m) GROUP BY doc_id
), best AS (SELECT doc_id, max(share) AS share FROM m GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN best USING (doc_id)
"""

_TERMS = f"""regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

_OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
total AS (SELECT count(*) AS n_docs, sum(len(words)) AS n_terms FROM d WHERE len(words) > 0),
held AS (SELECT r, unnest(words) AS term FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term
), m AS (SELECT r, doc_id, 50 + (50 * CAST(len(words) AS HUGEINT) * n_docs) // n_terms AS m FROM d, total WHERE len(words) > 0),
impacts AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS points
            FROM tf JOIN m USING (r) JOIN weights USING (term)),
scores AS (SELECT item_id, r, doc_id, CAST(sum(points) AS BIGINT) AS score
           FROM impacts JOIN asked USING (term) GROUP BY item_id, r, doc_id HAVING sum(points) > 0)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scores
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)
QUALIFY row_number() OVER best <= 50
"""


ORACLES = {"op1_warc": _OP1, "op3_minhash": _OP3, "op5_licenses": _op5(), "op6_lines": _OP6, "op12_ngrams": _OP12, "op13_search": _OP13}

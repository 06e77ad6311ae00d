"""Document fingerprints: threshold-scaled sketches.

A sketch holds every hash of a text's word 5-grams that lies below a fixed fraction (1 / ``SCALE``) of the
hash range, so sketches of any two texts are samples by the same rule: they merge by union, and
containment of a short text in a very long one is estimated as well as likeness. The smallest hash is
always kept, also above the fraction, so that a text with words never has an empty sketch; a union
keeps the hashes below the fraction and the smallest.

All of it is DataFrame expressions. The next document is found by a window over ranges of ids, cut at
approximate quantiles of the ids, so that sparse or clustered ids give ranges of about equal numbers
of rows, too; each range ends with the first row of the next one.

Cases: null text counts as empty; a text without words has the empty sketch; with fewer than five words
all of them are one shingle. Two empty sketches are alike (1), an empty and another one are not (0).
Rows with a null id come after all others; rows that share an id follow each other by text. Extra
columns are ignored. A single row is its own next document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import ascii_lower, free_name

WORDS = 5
SCALE = 8
_BORDER = -(1 << 63) + (1 << 64) // SCALE
_LAST = (1 << 63) - 1


def with_sketch(df: DataFrame, text: str, name: str, words: int = WORDS) -> DataFrame:
    """``df`` with the sketch of column ``text``, a sorted array of 64-bit hashes."""
    # The word hashes are a column of their own: each shingle looks up several of them.
    hashes = free_name(df, "_hashes")
    tokens = F.filter(F.split(ascii_lower(F.col(text)), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    df = df.withColumn(hashes, F.transform(tokens, lambda w: F.xxhash64(w)))
    h = F.col(hashes)
    chained = lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, words)))
    starts = F.slice(h, 1, F.greatest(F.size(h) - (words - 1), F.lit(0)))
    found = (
        F.when(F.size(h) >= words, F.transform(starts, chained))
        .when(F.size(h) > 0, F.array(F.xxhash64(h)))
        .otherwise(F.array().cast("array<bigint>"))
    )
    return df.withColumn(name, _scaled(found)).drop(hashes)


def _scaled(hashes: Column) -> Column:
    """The distinct hashes below the fraction, and the smallest."""
    return F.filter(F.array_sort(F.array_distinct(hashes)), lambda x, i: (x < _BORDER) | (i == 0))


def merge(a: Column, b: Column) -> Column:
    """The sketch of two sketches' texts taken together."""
    return _scaled(F.array_union(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second one holds, 0 to 1."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def written(sketch_: Column) -> Column:
    return F.array_join(F.transform(sketch_, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def range_bounds(rows: DataFrame, key: str, ranges: int) -> list[int]:
    """Values of the long column ``key``, ascending, that cut ``rows`` into at most ``ranges`` ranges, none of them empty."""
    shares = [k / ranges for k in range(1, ranges)]
    cuts = F.percentile_approx(key, shares, max(10_000, 10 * ranges))  # each of them occurs in the column
    found = rows.agg(F.min(key).alias("least"), cuts.alias("cuts")).first()
    return sorted({c for c in found["cuts"] or [] if c > found["least"]})


def range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are at or below ``key``, by bisection."""
    if not bounds:
        return F.lit(0)
    listed = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")  # one literal
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))))
    # Behind the last bound ``get`` is null.
    return F.aggregate(steps, F.lit(0), lambda at, size: F.when(F.get(listed, at + size - 1) <= key, at + size).otherwise(at))


def with_next(rows: DataFrame, order: list[str], values: list[str]) -> DataFrame:
    """``rows`` with ``next_<value>`` of the row that follows by ``order``; the first follows the last.

    The first column of ``order`` must be a long without nulls. There are about twice as many ranges as
    shuffle partitions; rows that are equal in that column share a range.
    """
    bounds = range_bounds(rows, order[0], 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.withColumn("_range", range_of(F.col(order[0]), bounds))
    # Each range ends with the first row of the next one, the last range with that of the first.
    row = F.struct(*order, *(v for v in values if v not in order))
    firsts = placed.groupBy("_range").agg(F.min_by(row, F.struct(*order)).alias("row"))
    before = F.pmod(F.col("_range") - 1, F.lit(len(bounds) + 1))
    ends = firsts.select(before.alias("_range"), F.lit(1).alias("_end"), F.col("row.*"))
    both = placed.withColumn("_end", F.lit(0)).unionByName(ends, allowMissingColumns=True)
    window = Window.partitionBy("_range").orderBy("_end", *order)
    both = both.select("*", *(F.lead(value).over(window).alias(f"next_{value}") for value in values))
    return both.where("_end = 0").drop("_range", "_end")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: sketches of the text, of its edited text and of the next text.

    Columns: doc_id, n_chars, edited (text), own, other (of the edited text), following.
    """
    at = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    rows = docs.select("doc_id", at.alias("_at"), F.coalesce("text", F.lit("")).alias("text"))
    paired = with_next(with_sketch(rows, "text", "own"), ["_at", "text"], ["text", "own"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    paired = paired.withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    paired = with_sketch(paired, "edited", "other")
    return paired.select("doc_id", "n_chars", "edited", "own", "other", F.col("next_own").alias("following"))


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    found = fingerprints(docs)
    return found.select(
        "doc_id", "n_chars",
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        written(F.col("own")).alias("fingerprint"),
        written(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
        containment(F.col("own"), F.col("other")).alias("kept_share"),
    )

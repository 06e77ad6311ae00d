"""Documents linked by the Jaccard similarity of their n-gram sets, by vertical partitioning.

Equal sets are one class. All n-grams have one global order: first by the power of two of the number of
classes that hold them, rare ones first, then by hash. The order is cut into fragments, four for each
power, and a class's set into segments, one a fragment. A pair's segments are intersected fragment by
fragment, and the partial counts summed per pair decide the link: ``100 c >= percent (n + m - c)``. No task
holds more than two segments of a pair, and nothing is compared but whole sets.

Which pairs are counted. A link takes ``need = ceil(percent n / 100)`` common n-grams, so of two linked
classes each holds, among its ``n - need + 1`` first n-grams in any global order, one that the other has
there, too.

1. In the order of the hashes, ``n - need + l`` first n-grams have the first ``l`` common ones of a link
   (``l`` a twentieth of the smaller set). Classes with fewer that are held twice have no link. This needs a
   quarter of all n-grams; whole sets are made for the classes left only.
2. In the global order each first n-gram offers its holders the heaviest of them as partner, which meets
   most others, as the original of edited copies does. Counted links are closed to components.
3. First n-grams whose holders lie in several components offer all pairs of different components that were
   not counted yet, where both have as many n-grams left as a link takes. Only holders outside the component
   of the heaviest seek, for any partner in that component is met from their side.

So a group of copies never meets as all pairs, and every link either lies in a component already or is
counted.

Cases: null or empty text and text without words have an empty set and link with nothing. Rows with a null id
link with nothing (null component). Rows that share an id are judged each by its own text; a component has the
smallest id of all its rows. Equal rows, ties and an empty table need no rule. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import bytes_of, cut, fan_join, spread_join, stored
from tidemark.llm.components import components
from tidemark.llm.near_dedup import shingles

#: Fragments of the global order for each power of two of holders, as a power of two.
SLICE_BITS = 2
#: One n-gram in so many is asked to be common in the first step.
HEAD = 20


def _need(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _set_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _heads(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Every row's set: its size, its key and its first n-grams in the order of the hashes."""

    def head(hashes: np.ndarray) -> np.ndarray | None:
        n = len(hashes)
        return hashes[: n - _need(n, percent) + max(1, n // HEAD)].view(np.int64) if n else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text"):
            sets = [shingles(t, words) for t in bytes_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(map(head, sets), pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "set_key", "head"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id {kind}, n_shingles BIGINT, set_key BINARY, head ARRAY<BIGINT>"
    )


def _whole_sets(texts: DataFrame, words: int) -> DataFrame:
    """``set_key`` and ``grams`` of every text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text"):
            sets = [shingles(t, words) for t in bytes_of(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["set_key", "grams"],
            )

    return texts.select("text").mapInArrow(work, "set_key BINARY, grams ARRAY<BIGINT>")


def _twice(rows: DataFrame) -> DataFrame:
    """The n-grams ``gram`` of more than one row, with their number ``holders``."""
    return rows.groupBy("gram").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")


def _may_link(classes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The classes that have enough n-grams in common with others by the heads of ``rows`` alone."""
    heads = rows.select("id", "head").join(classes.select("id"), "id", "left_semi")
    grams = heads.select("id", F.explode("head").alias("gram"))
    common = grams.join(_twice(grams), "gram").groupBy("id").agg(F.count(F.lit(1)).alias("common"))
    # The partner may be smaller, and then its own head has fewer n-grams in excess.
    smaller = F.ceil(F.col("n") * percent / 100)
    enough = F.col("common") >= F.greatest(F.lit(1), F.floor(smaller / HEAD))
    return classes.join(common, "id").where(enough).drop("common")


def _fragment(gram: Column, level: Column) -> Column:
    """The number of the fragment: consecutive ranges of the order by level, then hash."""
    ranges = 1 << SLICE_BITS
    return level * ranges + (F.shiftright(gram, 64 - SLICE_BITS) + ranges // 2).cast("int")


def _ordered(sets: DataFrame, percent: int) -> DataFrame:
    """Classes with their common n-grams in the global order: ``common``, an array of (level, gram), and ``weight``."""
    grams = sets.select("id", F.explode("grams").alias("gram"))
    level = F.floor(F.log2("holders")).cast("int")
    held = grams.join(_twice(grams), "gram").select("id", "holders", F.struct(level.alias("level"), "gram").alias("g"))
    listed = held.groupBy("id").agg(F.sort_array(F.collect_list("g")).alias("listed"), F.sum("holders").alias("weight"))
    # A repeated row brings its set twice; that only raises the numbers of holders. Equal ones stand side by side.
    first = lambda g, i: (i == 0) | (g != F.get(F.col("listed"), i - 1))
    listed = listed.select("id", "weight", F.filter("listed", first).alias("common"))
    sizes = sets.select("id", "n").dropDuplicates(["id"])
    return listed.join(sizes, "id").where(100 * F.size("common") >= percent * F.col("n"))


def _segments(ordered: DataFrame) -> DataFrame:
    """``id``, ``fragment`` and the class's n-grams in that fragment, where it has any."""
    number = lambda g: _fragment(g.gram, g.level)
    parts = ordered.select("id", "common", F.explode(F.array_distinct(F.transform("common", number))).alias("fragment"))
    mine = F.filter("common", lambda g: number(g) == F.col("fragment"))
    return parts.select("id", "fragment", F.transform(mine, lambda g: g.gram).alias("segment"))


def _first(ordered: DataFrame, percent: int, need: Column) -> DataFrame:
    """The first common n-grams of each class: ``gram``, and ``left``, how many it has from there on."""
    # N-grams of one holder come first in the order and meet nobody; they only shorten the rest.
    length = F.greatest(F.size("common") - need.cast("int") + 1, F.lit(0))
    taken = ordered.select("id", "n", "weight", "root", F.size("common").alias("size"), F.posexplode(F.slice("common", F.lit(1), length)))
    return taken.select("id", "n", "weight", "root", F.col("col.gram").alias("gram"), (F.col("size") - F.col("pos")).alias("left"))


def _enough(percent: int, n: str, left: str, m: str, left_too: str) -> Column:
    """Whether two classes that have so many n-grams left can have as many in common as a link takes."""
    return (100 + percent) * F.least(left, left_too) >= percent * (F.col(n) + F.col(m))


def _links(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, n, b, m) that the summed partial counts of their fragments confirm; b may be in many pairs."""
    left = segments.select(F.col("id").alias("a"), "fragment", F.col("segment").alias("x"))
    right = segments.select(F.col("id").alias("b"), "fragment", F.col("segment").alias("y"))
    met = fan_join(pairs.join(left, "a"), right, ["b", "fragment"], F.col("a"))
    partial = met.select("a", "b", "n", "m", F.size(F.array_intersect("x", "y")).cast("bigint").alias("c"))
    total = partial.groupBy("a", "b", "n", "m").agg(F.sum("c").alias("c"))
    return total.where(100 * F.col("c") >= percent * (F.col("n") + F.col("m") - F.col("c"))).select("a", "b")


def _offered(ordered: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, n, b, m): the holders of each first n-gram and the heaviest of them."""
    first = _first(ordered, percent, F.ceil(F.col("n") * percent / 100))
    heaviest = F.min(F.struct((-F.col("weight")).alias("o"), F.col("id").alias("b"), F.col("n").alias("m"), F.col("left").alias("left_too")))
    centres = first.groupBy("gram").agg(heaviest.alias("c"), F.count(F.lit(1)).alias("k")).where("k > 1")
    met = spread_join(first, centres.select("gram", "c.*"), "gram", F.col("id")).where("id != b")
    met = met.where(_enough(percent, "n", "left", "m", "left_too"))
    return met.select(F.col("id").alias("a"), "n", "b", "m").distinct()


def _remaining(ordered: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, n, b, m) of different components that share a first n-gram; only holders outside the heaviest's seek."""
    first = _first(ordered, percent, F.ceil(F.col("n") * percent / 100))
    torn = first.groupBy("gram").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("least"), F.max_by("root", F.struct("weight", "root")).alias("main"),
    ).where("lo != hi")
    held = spread_join(first, torn.select("gram", "least", "main"), "gram", F.col("id"))
    # The smallest partner in reach tells how many n-grams a link takes at least.
    reach = held.groupBy("id").agg(F.min("least").alias("least"), F.bool_or(F.col("root") != F.col("main")).alias("seeks"))
    partner = F.greatest("least", F.ceil(F.col("n") * percent / 100))
    tighter = ordered.join(reach, "id").withColumn("need", F.ceil(percent * (F.col("n") + partner) / (100 + percent)))
    seeking = tighter.where("seeks").select("id")
    first = stored(_first(tighter, percent, F.col("need")), "first-grams")
    seek = first.join(seeking, "id", "left_semi").select(
        "gram", F.col("id").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"), F.col("left").alias("la")
    )
    met = first.join(seek, "gram").where((F.col("root") != F.col("ra")) & _enough(percent, "n", "left", "na", "la"))
    pair = met.select(F.least("id", "a").alias("a"), F.when(F.col("id") < F.col("a"), F.col("n")).otherwise(F.col("na")).alias("n"),
                      F.greatest("id", "a").alias("b"), F.when(F.col("id") < F.col("a"), F.col("na")).otherwise(F.col("n")).alias("m"))
    return pair.distinct()


def _rooted(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with the components (``root``) that ``links`` make of them."""
    roots = components(links).select(F.col("node").alias("id"), F.col("root").alias("into"))
    return classes.join(roots, "id", "left").withColumn("root", F.coalesce("into", "id")).drop("into")


def join_ngrams(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``."""
    # The number of a row stands once for all, as the table is written.
    rows = stored(_heads(docs, words, percent).withColumn("id", F.monotonically_increasing_id()), "heads")
    listed = rows.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = listed.groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.any_value("n_shingles").alias("n"), F.min("id").alias("id"))
    classes = stored(classes, "classes")
    linked = stored(_may_link(classes, rows, percent), "may-link")

    texts = docs.select("doc_id", "text").join(linked.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = _whole_sets(texts, words).join(linked.select("set_key", "id", "n"), "set_key")
    ordered = stored(_ordered(stored(sets.select("id", "n", "grams"), "sets"), percent), "ordered")
    segments = stored(_segments(ordered), "segments")

    tried = stored(_offered(ordered.withColumn("root", F.col("id")), percent), "pairs")
    links = stored(_links(tried, segments, percent), "links")
    both = tried.select("a", "b").union(tried.select("b", "a"))
    rest = _remaining(_rooted(ordered, links), percent).join(both, ["a", "b"], "left_anti")
    links = links.union(_links(stored(rest, "pairs"), segments, percent))

    named = _rooted(classes, links).select("set_key", "first_id", "root")
    lowest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = spread_join(named.select("root", "set_key"), lowest, "root", F.col("set_key")).select("set_key", "component_id")
    of_class = stored(of_class, "class-components")
    found = spread_join(listed.select("doc_id", "n_shingles", "set_key"), of_class, "set_key", F.col("doc_id"))
    alone = rows.where("set_key IS NULL OR doc_id IS NULL")
    return found.select("doc_id", "n_shingles", "component_id").union(
        alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    )

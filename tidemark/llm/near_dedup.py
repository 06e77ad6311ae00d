"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set is its distinct word shingles, each a 64-bit hash. The sketch has COORDINATES
bins. In round ``i`` every shingle is thrown, by that round's hash, into one bin with the value
``i + fraction``; a bin keeps its least value, so earlier rounds win. After as many rounds as there
are bins, round ``COORDINATES + j`` throws every shingle into bin ``j``, which fills whatever is
left. Two sets agree in a coordinate with the probability of their similarity, and agreements
concentrate at least as well as with independent hash functions.

BANDS bands of ROWS coordinates give candidates: at similarity 0.8 a pair is missed with probability
(1 - 0.8^5)^32 < 4e-6. Links count only if the full sets confirm them.

Large groups never meet as all pairs. Equal sets become one class first. Classes that share a band
are linked to the centre of that band, and confirmed links are closed to components. Bands that
still reach over several components are torn: their classes look for partners by their rarest
shingles, and all pairs of different components found so are confirmed, except those already tried.
That closes all links that banding can see. The second closing works on components, not on classes.

Cases: null or empty text, or text without words, has no shingles and no links. Rows with a null id
are linked with nothing (null component, kept). Rows that share an id are judged each by its own
text. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.llm.common import GOLDEN, bytes_of, cut, free_name, mix, spread_join, stored
from tidemark.llm.components import components

BANDS, ROWS = 32, 5
COORDINATES = BANDS * ROWS
_U64 = np.uint64


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; a shorter text is one shingle."""
    tokens = (text or b"").lower().split()  # bytes: A-Z only, and splits at the six ASCII spaces
    if not tokens:
        return np.zeros(0, _U64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), _U64, len(tokens))
    n = min(words, len(tokens))
    with np.errstate(over="ignore"):
        factors = mix(np.arange(1, n + 1, dtype=_U64) * GOLDEN + _U64(n)) | _U64(1)
        total = np.zeros(len(hashes) - n + 1, _U64)
        for k in range(n):
            total = mix(total + hashes[k : len(hashes) - n + 1 + k] * factors[k])
    return np.unique(total)


def sketch(sets: list[np.ndarray], size: int = COORDINATES) -> np.ndarray:
    """The sketches of several sets, one row each; rows of empty sets are all ones."""
    full = np.iinfo(_U64).max
    bins = np.full(len(sets) * size, full, _U64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets) if len(owner) else np.zeros(0, _U64)
    low = _U64((1 << 44) - 1)
    for i in range(2 * size):
        if not len(flat):
            break
        with np.errstate(over="ignore"):
            h = mix(flat + GOLDEN * _U64(i + 1))
        slot = ((h >> _U64(44)) * _U64(size) >> _U64(20)).astype(np.int64) if i < size else i - size
        np.minimum.at(bins, owner * size + slot, _U64(i << 44) | (h & low))
        short = (bins.reshape(len(sets), size) == full).any(1)
        if not short[owner].all():
            keep = short[owner]
            flat, owner = flat[keep], owner[keep]
    return bins.reshape(len(sets), size)


def bands(sketches: np.ndarray) -> np.ndarray:
    """One hash a band; it covers the band's number."""
    parts = sketches.reshape(len(sketches), BANDS, ROWS)
    with np.errstate(over="ignore"):
        out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U64) * GOLDEN, parts.shape[:2]).copy()
        for k in range(ROWS):
            out = mix(out * _U64(0x9FB21C651E98DF25) + parts[:, :, k])
    return out.view(np.int64)


_CLASS = T.StructType([
    T.StructField("text_key", T.LongType()),
    T.StructField("n_shingles", T.LongType()),
    T.StructField("set_key", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
])
_SET = T.StructType([T.StructField("set_key", T.BinaryType()), T.StructField("hashes", T.ArrayType(T.LongType()))])


def _set_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _sketched(docs: DataFrame, words: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text"):
            sets = [shingles(t, words) for t in bytes_of(batch.column(1))]
            found = bands(sketch(sets))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([list(f) if len(s) else None for s, f in zip(sets, found, strict=True)], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "n_shingles", "set_key", "bands"],
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(work, T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *_CLASS.fields]))


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """The full sets of ``texts`` (column text), named by their key."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text"):
            sets = [shingles(t, words) for t in bytes_of(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(_set_key, sets), pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                ["set_key", "hashes"],
            )

    return texts.select("text").mapInArrow(work, _SET)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, ra, rb) whose full sets are similar enough."""
    left = sets.select(F.col("set_key").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("set_key").alias("b"), F.col("hashes").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    both = pairs.join(right, "b").join(left, "a")
    return both.where(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b", "ra", "rb")


def _torn(classes: DataFrame, percent: int) -> DataFrame:
    """The classes (columns set_key, n, root, need, seeks) in bands that reach over several components.

    A link with a class of ``m`` shingles takes ``percent (n + m) / (100 + percent)`` common ones; ``need``
    has the smallest ``m`` that the class's bands offer. All classes of a band seek partners but those of
    the component of its heaviest class, which any partner would find from its own side.
    """
    slots = classes.select("set_key", "n", "weight", "root", F.explode("bands").alias("band"))
    spans = slots.groupBy("band").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("m"), F.max(F.struct("weight", "root"))["root"].alias("main")
    ).where("lo != hi")
    least = (
        spread_join(slots, spans, "band", F.col("set_key")).groupBy("set_key")
        .agg(F.first("n").alias("n"), F.first("root").alias("root"), F.min("m").alias("m"), F.bool_or(F.col("root") != F.col("main")).alias("seeks"))
    )
    partner = F.greatest("m", F.ceil(F.col("n") * percent / 100))
    return least.withColumn("need", F.ceil(percent * (F.col("n") + partner) / (100 + percent)).cast("int")).drop("m")


def _prefixes(torn: DataFrame, sets: DataFrame) -> DataFrame:
    """(set_key, n, root, seeks, h, left) for the ``n - need + 1`` rarest shingles of the classes that can have a link.

    Any shingle of a link is held by two classes of the torn bands at least, so classes with fewer such
    shingles than they need go. Of two classes with a link each has a shingle in its prefix that is in
    the other's, too, as both prefixes follow one order. ``left`` counts the class's shingles from this
    one on, held by two classes at least.
    """
    held = sets.join(torn, "set_key").select("set_key", "n", "need", "root", "seeks", F.explode("hashes").alias("h"))
    counts = held.groupBy("h").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    common = held.join(counts, "h").groupBy("set_key", "n", "need", "root", "seeks")
    listed = common.agg(F.sort_array(F.collect_list(F.struct("holders", "h"))).alias("ordered")).where(F.size("ordered") >= F.col("need"))
    # Shingles of one holder come first in the order and meet nobody: they only shorten the rest of the prefix.
    length = F.size("ordered") - F.col("need") + 1
    taken = listed.select("set_key", "n", "root", "seeks", F.size("ordered").alias("size"), F.posexplode(F.slice("ordered", 1, length)))
    return taken.select("set_key", "n", "root", "seeks", F.col("col.h").alias("h"), (F.col("size") - F.col("pos")).alias("left"))


def _last_pairs(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, ra, rb) of different components, of classes that share a shingle of their prefixes.

    From the first shingle that two classes share, both must have as many left as a link takes. Two
    classes that both seek meet once.
    """
    seek = prefixes.where("seeks").select("h", F.col("set_key").alias("k2"), F.col("n").alias("n2"), F.col("root").alias("r2"), F.col("left").alias("left2"))
    enough = (100 + percent) * F.least("left", "left2") >= percent * (F.col("n") + F.col("n2"))
    once = ~F.col("seeks") | (F.col("set_key") < F.col("k2"))
    met = prefixes.join(seek, "h").where((F.col("root") != F.col("r2")) & enough & once)
    return _ordered(met, "set_key", "root", "k2", "r2").distinct()


def _ordered(met: DataFrame, x: str, x_root: str, y: str, y_root: str) -> DataFrame:
    """Columns a, b, ra, rb: two classes, the smaller first, and their components."""
    lo, hi = (F.struct(F.col(k).alias("k"), F.col(r).alias("r")) for k, r in ((x, x_root), (y, y_root)))
    pair = met.select(F.least(lo, hi).alias("p"), F.greatest(lo, hi).alias("q"))
    return pair.select(F.col("p.k").alias("a"), F.col("q.k").alias("b"), F.col("p.r").alias("ra"), F.col("q.r").alias("rb"))


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with the components that ``links`` between their components (ra, rb) make of them."""
    roots = components(links.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    moved = roots.select(F.col("node").alias("root"), F.col("root").alias("into"))
    return spread_join(classes, moved, "root", F.col("set_key"), "left").withColumn("root", F.coalesce("into", "root")).drop("into")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row of ``docs``."""
    found = _judged(docs, words, percent).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _judged(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``set_key``, ``text_key`` and ``chosen`` of every row of ``docs``.

    ``chosen``: the row's set is the one that its component keeps, a set of the component's smallest id.
    """
    rows = stored(_sketched(docs, words), "sketches")
    listed = rows.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = listed.groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands"))
    slots = classes.select("set_key", "first_id", "n", F.explode("bands").alias("band"))
    shared = slots.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # A class has BANDS bands at most.
    placed = stored(
        spread_join(slots, shared, "band", F.col("set_key")).groupBy("set_key", "first_id", "n")
        .agg(F.sum("size").alias("weight"), F.collect_list("band").alias("bands")).withColumn("root", F.col("set_key")),
        "placed",
    )

    needed = placed.select(F.col("first_id").alias("doc_id"), "set_key")
    texts = docs.select("doc_id", "text").join(needed.select("doc_id").distinct().hint("shuffle_hash"), "doc_id", "left_semi")
    sets = stored(
        _sets(texts, words).join(needed.select("set_key"), "set_key", "left_semi").dropDuplicates(["set_key"]), "sets"
    )

    # The centre of a band is the class that meets most others, as an unedited original does.
    in_bands = placed.select("set_key", "n", "weight", "root", F.explode("bands").alias("band"))
    centres = in_bands.groupBy("band").agg(F.min(F.struct((-F.col("weight")).alias("o"), "set_key", "n")).alias("c"))
    met = spread_join(in_bands, centres, "band", F.col("set_key"))
    fits = 100 * F.least("n", "c.n") >= percent * F.greatest("n", "c.n")
    met = met.where((F.col("set_key") != F.col("c.set_key")) & fits).select("set_key", F.col("c.set_key").alias("centre"))
    tried = stored(_ordered(met, "set_key", "set_key", "centre", "centre").distinct(), "pairs")
    joined = stored(_joined(placed, stored(_confirmed(tried, sets, percent), "links")), "joined")

    torn = stored(_torn(joined, percent), "torn-bands")
    last = _last_pairs(stored(_prefixes(torn, sets), "prefixes"), percent).join(tried.select("a", "b"), ["a", "b"], "left_anti")
    joined = _joined(joined, stored(_confirmed(stored(last, "pairs"), sets, percent), "links"))

    named = listed.groupBy("set_key").agg(F.min("doc_id").alias("first_id")).join(joined.select("set_key", "root"), "set_key", "left")
    named = named.withColumn("root", F.coalesce("root", "set_key"))
    lowest = named.groupBy("root").agg(F.min(F.struct("first_id", "set_key")).alias("least"))
    of_class = spread_join(named.select("root", "set_key"), lowest, "root", F.col("set_key"))
    of_class = stored(of_class.select("set_key", F.col("least.first_id").alias("component_id"), (F.col("set_key") == F.col("least.set_key")).alias("main")), "classes")
    with_class = spread_join(listed.select("doc_id", "n_shingles", "set_key", "text_key"), of_class, "set_key", F.col("doc_id"))
    chosen = (F.col("main") & (F.col("doc_id") == F.col("component_id"))).alias("chosen")
    alone = rows.where("set_key IS NULL OR doc_id IS NULL")
    return with_class.select("doc_id", "n_shingles", "component_id", "set_key", "text_key", chosen).union(
        alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "set_key", "text_key", F.lit(True))
    )


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, the one with the smallest id; all columns as they are.

    Rows with a null id stay. Of rows that share a kept id, those stay whose own text is kept, and
    equal rows of them once. If the texts of one id are near copies of each other, one of them stays.
    """
    chosen = _judged(docs, words, percent).where("chosen AND doc_id IS NOT NULL")
    # Texts of one set differ in white space or case only: one of them stays. Texts without words have no set.
    copies = F.coalesce("set_key", F.encode(F.col("text_key").cast("string"), "utf-8"))
    key = free_name(docs, "_text")
    kept = chosen.groupBy("doc_id", copies.alias("copies")).agg(F.min("text_key").alias(key)).drop("copies")
    rank = free_name(docs, "_copy")
    named = docs.where("doc_id IS NOT NULL").withColumn(key, F.xxhash64("text"))
    named = named.join(kept.hint("shuffle_hash"), ["doc_id", key], "left_semi")
    one = Window.partitionBy("doc_id", key).orderBy("doc_id")
    named = named.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).drop(rank, key)
    return named.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))

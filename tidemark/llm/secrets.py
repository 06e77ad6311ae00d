"""Secret scans: patterns, and Shannon entropy over a sliding window of candidate strings.

A candidate is a run of at least ``WINDOW`` characters of a key alphabet. A window's class is the narrowest
alphabet that holds it (hex, letters and digits, base64 and URL-safe base64), and each class has its
threshold in bits. Separators inside hex groups (``=``, ``_``, ``-``) leave a window with a letter in the hex class;
digits with separators alone (dates, phone numbers) need the bits of base64. The window's entropy is
``log2(w) - S / w`` with ``S`` the sum of ``c log2 c`` over its character counts; moving the window by one changes two counts, so ``S`` is updated by two
differences and never recomputed. A span reaches from the first to the last window above the
threshold. What is on the allow list (examples, placeholders, alphabets in order, identifiers in UUID form)
cuts a run, so that no window touches it and the rest is judged; spans are suppressed if they lie inside a pattern's span.

All of it is DataFrame expressions over a row. Positions count code points: a text is split at the
pattern, and a match begins after the parts and matches before it.

Cases: null text counts as empty and has no span. Repeated rows and ids are scanned one by one; extra
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 20
#: Matches that are placed one after the other.
BLOCK = 256

#: The base patterns. The hex and access patterns match greedily, so that the least
#: length can stand in the pattern; an assignment's least length is tested after the match.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_HEAD = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW
#: Class, its alphabet, and the bits that a window needs; a window of 20 has at most 4.32.
CLASSES = (("hex", r"^[0-9a-fA-F]+$", 3.0), ("alnum", r"^[0-9A-Za-z]+$", 3.7), ("base64", r"^[0-9A-Za-z+/_=-]+$", 3.8))
#: What an allowed candidate holds or is (lower case).
ALLOWED = (
    "example", "placeholder", "changeme", "your_", "xxxxxxxx", "00000000", "0123456789", "abcdefghij", "lorem",
)
ALLOWED_INSIDE = r"(?<![0-9A-Za-z])(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})(?![0-9A-Za-z])"
#: Hex in groups: with a letter and a separator.
GROUPED = r"^(?=.*[a-fA-F])[0-9a-fA-F=_-]+$"
ALLOWED_FORM = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"

_SPAN = "array<struct<start:int,kind:int,stop:int>>"


def _none() -> Column:
    return F.array().cast(_SPAN)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _placed(sizes: Column, at: Column, kind: int) -> Column:
    """Spans of a few parts (gap, match, valid) that follow each other from ``at``; the invalid ones are left out."""

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + part["gap"]
        end = begin + part["match"]
        span = F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("stop"))).cast(_SPAN)
        return F.struct(end.alias("at"), F.when(part["valid"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(sizes, F.struct(at.alias("at"), _none().alias("spans")), step, lambda state: state["spans"])


def pattern_spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Array of (start, kind, stop) of the pattern's leftmost matches; ``keep`` tests a match's text.

    The matches are placed block by block, from running sums of the blocks' lengths, so that no array
    longer than a block or than the number of blocks is built up piece by piece.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def size(gap: Column, match: Column) -> Column:
        valid = match.isNotNull()
        if keep is not None:
            valid = valid & keep(match)
        return F.struct(F.length(gap).alias("gap"), F.coalesce(F.length(match), F.lit(0)).alias("match"), valid.alias("valid"))

    def place(sizes: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.size(sizes), F.lit(BLOCK)), lambda first: F.slice(sizes, first, F.lit(BLOCK)))
        length = lambda block: F.aggregate(block, F.lit(0), lambda n, part: n + part["gap"] + part["match"])
        follow = lambda ends, block: F.concat(ends, F.array(F.element_at(ends, -1) + length(block)))
        starts = lambda cut: F.slice(F.aggregate(cut, F.array(F.lit(0)), follow), F.lit(1), F.size(cut))
        return F.flatten(_let(blocks, lambda cut: F.zip_with(cut, starts(cut), lambda block, at: _placed(block, at, kind))))

    return F.when(text.rlike(pattern), _let(F.zip_with(gaps, found, size), place)).otherwise(_none())


#: What S grows by when a count becomes 1, 2, ..., WINDOW.
_GAINS = [c * math.log2(c) - (c - 1) * math.log2(max(c - 1, 1)) for c in range(1, WINDOW + 1)]


def _least(window: Column) -> Column:
    """The bits that a window of a candidate needs."""
    least = F.lit(CLASSES[-1][2])
    for _, alphabet, bits in reversed(CLASSES[:-1]):
        least = F.when(window.rlike(alphabet), F.lit(bits)).otherwise(least)
    return F.when(window.rlike(GROUPED), F.lit(CLASSES[0][2])).otherwise(least)


def entropy_windows(candidate: Column) -> Column:
    """(first, last): starts of the first and the last window of ``candidate`` with enough bits; null without one.

    ``S`` follows the window: the entering character raises its count, the leaving one lowers its own.
    """
    chars = F.split(candidate, "")
    start = F.struct(
        F.lit(0).alias("at"), F.lit(0.0).alias("s"), F.lit("").alias("window"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"),
    )
    gains = F.array(*map(F.lit, _GAINS))
    count = lambda window, c: F.length(window) - F.length(F.replace(window, c, F.lit("")))
    gain = lambda window, c: F.element_at(gains, count(window, c))
    lowest = min(b for _, _, b in CLASSES)

    def step(state: Column, c: Column) -> Column:
        full = state["at"] >= WINDOW
        window = F.concat(F.when(full, F.substring(state["window"], 2, WINDOW)).otherwise(state["window"]), c)
        lowered = F.when(full, gain(state["window"], F.substring(state["window"], 1, 1))).otherwise(0.0)

        def judge(x: Column) -> Column:
            moved = F.struct((state["s"] - lowered + gain(x, c)).alias("s"), x.alias("window"))
            return _let(moved, lambda m: _let(hit(m), lambda h: result(m, h)))

        def hit(m: Column) -> Column:
            bits = math.log2(WINDOW) - m["s"] / WINDOW
            return (state["at"] >= WINDOW - 1) & (bits >= lowest) & (bits >= _least(m["window"]))

        def result(m: Column, h: Column) -> Column:
            place = state["at"] + 1 - WINDOW
            return F.struct(
                (state["at"] + 1).alias("at"), m["s"].alias("s"), m["window"].alias("window"),
                F.when(h & state["first"].isNull(), place).otherwise(state["first"]).alias("first"),
                F.when(h, place).otherwise(state["last"]).alias("last"),
            )

        return _let(window, judge)

    return F.aggregate(chars, start, step, lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last")))


def _without_allowed(text: Column) -> Column:
    """``text`` with spaces for what is on the allow list; nothing else moves."""
    for word in ALLOWED:
        text = F.regexp_replace(text, F.lit(f"(?i){word}"), F.lit(" " * len(word)))
    return F.regexp_replace(text, F.lit(ALLOWED_INSIDE), F.lit(" " * 36))


def entropy_spans(text: Column) -> Column:
    """Array of (start, kind, stop) of the candidates' high-entropy stretches."""
    kind = KINDS.index("entropy")

    def spans(clear: Column) -> Column:
        def stretch(place: Column) -> Column:
            candidate = F.substring(clear, place["start"] + 1, place["stop"] - place["start"])
            return _let(entropy_windows(candidate), lambda window: F.struct(
                (place["start"] + window["first"]).alias("start"), F.lit(kind).alias("kind"),
                (place["start"] + window["last"] + WINDOW).alias("stop"),
            ))

        return F.filter(F.transform(pattern_spans(clear, CANDIDATE, kind), stretch), lambda s: s["start"].isNotNull()).cast(_SPAN)

    found = F.get(F.transform(F.array(_without_allowed(text)), spans), F.lit(0))
    return F.when(text.rlike(CANDIDATE), found).otherwise(_none())


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``base`` and ``entropy``, arrays of (start, kind, stop)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    long_enough = lambda m: F.length(F.regexp_replace(m, ASSIGN_HEAD, "")) >= ASSIGN_LEAST
    rows = rows.select(
        "doc_id",
        pattern_spans(F.col("text"), ASSIGN, 0, long_enough).alias("assign"),
        pattern_spans(F.col("text"), ACCESS, 1).alias("access"),
        pattern_spans(F.col("text"), HEX, 2).alias("hex"),
        entropy_spans(F.col("text")).alias("dense"),
    )
    rows = rows.select("doc_id", F.array_sort(F.concat("assign", "access", "hex")).alias("base"), "dense")
    inside = lambda s: F.exists("base", lambda b: (b["start"] <= s["start"]) & (b["stop"] >= s["stop"]))
    return rows.select("doc_id", "base", F.filter("dense", lambda s: ~inside(s)).alias("entropy"))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])
    return F.array_join(F.transform(spans, one), ",")


def secret_digest(docs: DataFrame) -> DataFrame:
    """The scan as counts, a digest of the base spans, and all spans as text."""
    found = scan_secrets(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", "entropy"))).alias("spans"),
    )

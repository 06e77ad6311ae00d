"""License scans: an exact set-similarity join of text blocks with license templates.

A block matches a template when it holds at least ``CONTAINMENT`` of the template's distinct words, its
key words among them (``KEY_WORDS``: the words that tell the license from others). A block is a line, or, so that
wrapped notices are found, a stretch: any run of words at most ``1 / CONTAINMENT`` times as long as the template,
wherever its line breaks stand. A stretch is reported if it covers more than one line and is fuller than each
line it touches; those lines are then not reported themselves. Of stretches that overlap, read in order, the fullest is
reported, then the one that ends first, then the shortest. Template words are ordered by how many documents of the corpus hold them, rarest
first. The join filters by

* prefix: a match must hold one of the ``n - need + 1`` rarest words of the template (n words, ``need``
  of them needed), so only blocks with such a word are looked at;
* length: a block needs at least ``need`` distinct words;
* position: with the first held word at place ``p`` of the template's order, at most ``n - p`` words can be
  held, so ``p`` must be at most ``n - need``. The first held word of a prefix decides this;

and what is left is counted exactly. For stretches the filters hold for the text; then each
template word of the text begins one stretch, which stops at the last word that is new to it. Templates are few and given by the caller: at most
``MAX_TEMPLATE_WORDS`` words in all, which bounds what each task gets.

All of it is DataFrame expressions over a row, without a shuffle of texts; only the counts of
template words are aggregated.

Cases: null text counts as empty; a text without words has no place, no label and score 0. Repeated
rows and ids are scanned one by one; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ascii_lower

CONTAINMENT = 0.8
MAX_TEMPLATE_WORDS = 50_000
#: Everything that is no word character: ASCII but for letters and digits.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases and the labels that they give.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices by which works commonly state their license, one block each.
TEMPLATES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit-notice": "Released under the MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

#: Words of those templates without which a notice states another license.
KEY_WORDS = {
    "apache-notice": ("apache",),
    "cc-by-nc-notice": ("cc", "nc"),
    "gpl-notice": ("gnu",),
    "mit-notice": ("mit",),
    "mpl-notice": ("mozilla",),
}


@dataclass(frozen=True)
class Rule:
    """What a block must hold for one template: ``need`` of the words ``ordered``, all of ``keys``."""

    label: str
    ordered: list[str]
    need: int
    keys: list[str]
    longest: int

    @property
    def prefix(self) -> list[str]:
        return self.ordered[: len(self.ordered) - self.need + 1]

    def share(self, own: Column) -> Column:
        """The share of the template's words in distinct words, null without a match."""
        # Prefix and position in one: a match has a word among the first n - need + 1.
        early = F.arrays_overlap(own, _strings(self.prefix))
        shared = F.size(F.array_intersect(own, _strings(self.ordered)))
        enough = (F.size(own) >= self.need) & early & self.keyed(own) & (shared >= self.need)
        return F.when(enough, shared / F.lit(float(len(self.ordered))))

    def keyed(self, own: Column) -> Column:
        return F.lit(True) if not self.keys else F.size(F.array_except(_strings(self.keys), own)) == 0


def rules(templates: dict[str, str], ranks: dict[str, int], containment: float) -> list[Rule]:
    """The rule of each template that has words; ``ranks``: documents that hold each word."""
    found = []
    for label, template in sorted(templates.items()):
        ordered = sorted(template_words(template), key=lambda w: (ranks.get(w, 0), w))
        need = math.ceil(containment * len(ordered) - 1e-9)
        spoken = sum(bool(w) for w in re.split(_GAPS, template.lower()))
        longest = math.ceil(spoken / containment - 1e-9) if need else 0
        if need:
            found.append(Rule(label, ordered, need, sorted(KEY_WORDS.get(label, ())), longest))
    return found


def words(text: Column) -> Column:
    """The text's words, in order."""
    return F.filter(F.split(ascii_lower(text), _GAPS), lambda w: w != "")


def template_words(text: str) -> list[str]:
    """Distinct words of a template; templates are ASCII."""
    return sorted({w for w in re.split(_GAPS, text.lower()) if w})


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def word_ranks(docs: DataFrame, templates: dict[str, str]) -> dict[str, int]:
    """How many documents hold each template word; the template's words bound the result."""
    vocabulary = sorted({w for t in templates.values() for w in template_words(t)})
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError("too many template words to send to every task")
    held = F.array_intersect(words(F.coalesce("text", F.lit(""))), _strings(vocabulary))
    counted = docs.select(F.explode(held).alias("w")).groupBy("w").count().collect()
    return dict.fromkeys(vocabulary, 0) | {r["w"]: r["count"] for r in counted}


def license_matches(text: Column, held: Column, ranks: dict[str, int], templates: dict[str, str], containment: float) -> Column:
    """Array of (block, label, containment) of the matches in a text; ``held``: the text's words.

    ``block`` is the number of the block's first line.
    """
    kind = "array<struct<block:int,label:string,containment:double>>"
    nothing = F.array().cast(kind)
    found = rules(templates, ranks, containment)
    if not found:
        return nothing
    lines = F.transform(F.split(text, "\n", -1), lambda line, at: F.struct(at.alias("at"), words(line).alias("words")))

    def matches(rule: Rule, lines: Column) -> Column:
        shares = F.transform(lines, lambda b: F.struct(b["at"], b["words"], F.coalesce(rule.share(F.array_distinct(b["words"])), F.lit(0.0)).alias("own")))
        return _let(shares, lambda b: _let(_stretches(b, rule), lambda spans: _reported(b, spans, rule.label)))

    def one(rule: Rule, lines: Column) -> Column:
        return F.when(rule.share(held).isNotNull(), matches(rule, lines)).otherwise(nothing)

    early = _strings(sorted({w for rule in found for w in rule.prefix}))
    every = _let(lines, lambda b: F.concat(*(one(rule, b) for rule in found)))
    return F.when(F.arrays_overlap(held, early), every).otherwise(nothing)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _reported(lines: Column, spans: Column, label: str) -> Column:
    """Array of (block, label, containment): the stretches, and the matching lines that none of them touches."""
    hit = lambda at, share: F.struct(at.alias("block"), F.lit(label).alias("label"), share.alias("containment"))
    touched = F.flatten(F.transform(spans, lambda s: F.sequence(s["block"], s["until"])))
    alone = F.filter(lines, lambda b: (b["own"] > 0) & ~F.array_contains(touched, b["at"]))
    return F.concat(F.transform(alone, lambda b: hit(b["at"], b["own"])), F.transform(spans, lambda s: hit(s["block"], s["share"])))


def _stretches(lines: Column, rule: Rule) -> Column:
    """Array of (start, stop, block, until, share) of the stretches that match one template.

    ``lines``: (at, words, own) with the containment of each line by itself. ``start`` and ``stop`` are
    words of the text, ``block`` and ``until`` the lines where those stand.
    """
    tokens = F.flatten(F.transform(lines, lambda b: F.transform(b["words"], lambda w: F.struct(b["at"].alias("at"), w.alias("word"), b["own"].alias("own")))))
    placed = F.transform(tokens, lambda t, i: F.struct(t["at"].alias("at"), t["word"].alias("word"), t["own"].alias("own"), i.alias("i")))
    free = F.filter(placed, lambda t: F.array_contains(_strings(rule.ordered), t["word"]))

    def reach(free: Column) -> Column:
        def ahead(t: Column, k: Column) -> Column:
            near = F.filter(F.slice(free, k + 1, rule.longest), lambda x: x["i"] < t["i"] + rule.longest)
            return F.struct(t["i"].alias("start"), t["at"].alias("block"), near.alias("ahead"))

        return F.filter(F.transform(free, ahead), lambda c: rule.share(F.array_distinct(c["ahead"]["word"])).isNotNull())

    def measured(c: Column) -> Column:
        fresh = F.filter(c["ahead"], lambda x, k: F.array_position(c["ahead"]["word"], x["word"]) == k + 1)

        def whole(fresh: Column) -> Column:
            last = F.element_at(fresh, -1)
            inner = F.filter(c["ahead"], lambda x: x["i"] <= last["i"])
            share = F.size(fresh) / F.lit(float(len(rule.ordered)))
            return F.struct(
                c["start"].alias("start"), last["i"].alias("stop"), c["block"].alias("block"), last["at"].alias("until"),
                share.alias("share"), F.array_max(F.transform(inner, lambda x: x["own"])).alias("own"),
            )

        return _let(fresh, whole)

    kind = "struct<start:int,stop:int,block:int,until:int,share:double,own:double>"
    spans = F.filter(F.transform(_let(free, reach), measured), lambda s: (s["until"] > s["block"]) & (s["share"] > s["own"]))

    def fullest(state: Column, c: Column) -> Column:
        last = state["last"]
        apart = last.isNull() | (c["start"] > last["stop"])
        tighter = (c["share"] == last["share"]) & (c["stop"] <= last["stop"])
        better = (c["share"] > last["share"]) | tighter
        done = F.when(apart & last.isNotNull(), F.concat(state["done"], F.array(last))).otherwise(state["done"])
        return F.struct(done.alias("done"), F.when(apart | better, c).otherwise(last).alias("last"))

    start = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit(None).cast(kind).alias("last"))
    closed = lambda state: F.when(state["last"].isNull(), state["done"]).otherwise(F.concat(state["done"], F.array(state["last"])))
    return F.aggregate(spans.cast(f"array<{kind}>"), start, fullest, closed)


def _phrase_places(held: Column, phrase: str, label: str) -> Column:
    """Array of (label, word) for each place where the phrase's words stand in ``held``."""
    parts = phrase.split(" ")
    n = len(parts)
    starts = F.sequence(F.lit(0), F.size(held) - n)
    here = F.filter(starts, lambda i: F.array_join(F.slice(held, i + 1, n), " ") == phrase)
    spots = F.transform(here, lambda i: F.struct(F.lit(label).alias("label"), i.cast("long").alias("word")))
    maybe = (F.size(held) >= n) & F.array_contains(held, parts[0]) & F.array_contains(held, parts[-1])
    return F.when(maybe, spots).otherwise(F.array().cast("array<struct<label:string,word:bigint>>"))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """One row per row of ``docs``: the phrases' places and labels, and the blocks that match a template.

    Columns: doc_id, n_words, places (label and first word of each phrase found), matches
    (block, label, containment).
    """
    templates = TEMPLATES if templates is None else templates
    ranks = word_ranks(docs, templates)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("held", words(F.col("text")))
    places = F.concat(*(_phrase_places(F.col("held"), phrase, label) for phrase, label in sorted(PHRASES.items())))
    return rows.select(
        "doc_id",
        F.size("held").cast("long").alias("n_words"),
        places.alias("places"),
        license_matches(F.col("text"), F.col("held"), ranks, templates, containment).alias("matches"),
    )


def license_blocks(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """Every text block that meets the containment threshold: doc_id, block, label, containment."""
    return scan_licenses(docs, templates, containment).select("doc_id", F.inline("matches"))


def license_digest(docs: DataFrame) -> DataFrame:
    """The scan as counts, places and comma-joined labels; score 1 with a phrase, else the best containment."""
    found = scan_licenses(docs)
    names = lambda c: F.array_distinct(F.transform(c, lambda x: x["label"]))
    at = F.transform("places", lambda x: x["word"])
    best = F.coalesce(F.array_max(F.transform("matches", lambda x: x["containment"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        F.array_join(F.array_sort(names(F.col("places"))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(names(F.col("places")), names(F.col("matches")))), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"),
    )

"""License scan: places of phrases, and text blocks that contain a license template.

A text states a template if a run of its words has at least ``CONTAINMENT`` of the template's
words in their order: from each word of a run the next of the template is looked for among the
following ones, passed over if it is not there, and the run may be longer than the template by the
same share. So words that are merely near one another state nothing, and a wording that is
wrapped, cut short or has words put in is found.

Runs lie in blocks of words that do not depend on line ends: twice as long as the longest run,
starting at every multiple of its length, so any run is whole in one of them. Texts that do not
have enough words of any template are not cut. Blocks that may state a template are found by a
set-similarity join on words in one order, rarest in the corpus first (ties by the word):

* prefix filter: a block with enough words of a template has one of the template's
  ``size - needed + 1`` rarest, so only these are in the index;
* length filter: the block has at least ``needed`` words of the templates;
* positional filter: from the first common word on, both lists still have enough;
* survivors are counted exactly, and their runs are read in order.

The join keeps only words that occur in templates, as no other word can count.
Frequencies are counted over the blocks of all rows. Templates are a bounded
list, so their index is an expression and nothing but matches is shuffled.
``TEMPLATES`` are the sentences by which texts state a license; whole license texts can be
given in their place, see ``templates_of``.

Defined cases: null text is empty and has no words; null ids are kept; repeated
rows are scanned each; other columns of the table are not looked at; a template
without words, or an empty list of templates, finds nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import stored
from eventloom.llm.urls import LOWER, UPPER

# Words of lower-cased text, and the same words before lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAINMENT = 0.8
MAX_TEMPLATES = 500

# Phrases and their labels; every phrase holds the word "license".
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
KEYWORD = "license"

# Wordings by which texts state their license, and the labels these give.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("all rights reserved", "reserved"),
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def phrase_starts(words: Column, phrase: str) -> Column:
    """Numbers of the words at which ``phrase`` starts."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        return reduce(and_, [F.get(words, i + k) == F.lit(part) for k, part in reversed(list(enumerate(parts)))])

    last = F.size(words) - len(parts)
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), here)).otherwise(F.array().cast("array<int>"))


def _literal(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


@dataclass(frozen=True)
class Template:
    """A wording: its words in order, how many of them are needed, and how far a run may go (0: anywhere, in any order)."""

    words: tuple[str, ...]
    label: str
    needed: int
    span: int

    @property
    def distinct(self) -> list[str]:
        return sorted(set(self.words))

    @property
    def needed_distinct(self) -> int:
        """Different words that a run with enough words has at least."""
        return max(len(self.distinct) - (len(self.words) - self.needed), 1)


def templates_of(wordings: Sequence[tuple[str, str]], least: float = CONTAINMENT) -> list[Template]:
    """Templates from (wording, label), of texts of any length; those without words are left out."""
    out = []
    for text, label in wordings:
        words = tuple(re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER))))
        if words:
            out.append(Template(words, label, math.ceil(least * len(words) - 1e-9), int(len(words) / least + 1e-9)))
    if len(out) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    return out


def _in_order(run: Column, words: Column, span: Column) -> Column:
    """The most words of a template that a run inside a block has in order."""
    slack = span - F.size(words)

    def from_word(start: Column) -> Column:
        def step(state: Column, word: Column) -> Column:
            ahead = F.greatest(F.least(slack + 1, start + span - state["at"]), F.lit(0))
            found = F.array_position(F.slice(run, state["at"] + 1, ahead), word).cast("int")
            return F.when(
                found > 0, F.struct((state["at"] + found).alias("at"), (state["n"] + 1).alias("n"))
            ).otherwise(state)

        return F.aggregate(words, F.struct(start.alias("at"), F.lit(0).alias("n")), step)["n"]

    starts = F.filter(F.sequence(F.lit(0), F.size(run) - 1), lambda i: F.array_contains(words, F.get(run, i)))
    return F.coalesce(F.array_max(F.transform(starts, from_word)), F.lit(0))


def _unordered(text: str, label: str) -> Template:
    words = tuple(sorted(set(text.split())))
    return Template(words, label, math.ceil(CONTAINMENT * len(words) - 1e-9), 0)


def template_matches(blocks: DataFrame, templates: Sequence[Template | tuple[str, str]]) -> DataFrame:
    """(row, label, containment) of each block of ``blocks`` (row, words) and template that it states.

    ``words`` are a block's words in order. A (text, label) is a template whose different words may stand in any order.
    """
    templates = [t if isinstance(t, Template) else _unordered(*t) for t in templates]
    vocabulary_of = sorted({w for t in templates for w in t.words})
    if not vocabulary_of:
        return blocks.select("row", F.lit("").alias("label"), F.lit(0.0).alias("containment")).where("false")
    blocks = blocks.select("row", "words", F.array_intersect("words", _literal(vocabulary_of)).alias("known"))
    counts = blocks.select(F.explode("known").alias("word")).groupBy("word").count().collect()
    often = {r.word: r["count"] for r in counts}  # at most one row per word of the templates
    vocabulary = sorted(vocabulary_of, key=lambda w: (often.get(w, 0), w))
    place = {w: i for i, w in enumerate(vocabulary)}
    ranked = [sorted(place[w] for w in t.distinct) for t in templates]
    needed = [t.needed_distinct for t in templates]
    index: dict[int, list[int]] = {}
    for t, places in enumerate(ranked):
        for p in places[: len(places) - needed[t] + 1]:
            index.setdefault(p, []).append(t)
    to_place = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, place[w])])
    to_templates = F.create_map(*[c for p, ts in index.items() for c in (F.lit(p), _literal(ts))])
    rows = blocks.select(
        "row", "words", F.array_sort(F.transform("known", lambda w: F.element_at(to_place, w))).alias("have")
    ).where(F.size("have") >= min(needed))
    hits = F.array_distinct(F.flatten(F.array_compact(F.transform("have", lambda p: F.try_element_at(to_templates, p)))))

    def of_template(values: list) -> Column:
        return F.get(_literal(values), F.col("t"))

    found = rows.select("row", "words", "have", F.explode(hits).alias("t")).select(
        "row",
        "words",
        "have",
        of_template([list(p) for p in ranked]).alias("want"),
        of_template(needed).alias("needed"),
        of_template([list(t.words) for t in templates]).alias("wording"),
        of_template([t.needed for t in templates]).alias("needed_words"),
        of_template([t.span for t in templates]).alias("span"),
        of_template([t.label for t in templates]).alias("label"),
    )
    common = F.array_intersect("have", "want")  # in the order of ``have``: the first is the rarest
    first = F.get(common, F.lit(0))
    ordered = _in_order(F.col("words"), F.col("wording"), F.col("span"))
    left = [F.size(c) - F.array_position(c, first) + 1 for c in ("have", "want")]
    return (
        found.where(F.size("have") >= F.col("needed"))
        .where(F.least(*left) >= F.col("needed"))
        .where(F.size(common) >= F.col("needed"))
        .withColumn("n", F.when(F.col("span") == 0, F.size(common)).otherwise(ordered))
        .where("n >= needed_words")
        .select("row", "label", (F.col("n") / F.size("wording")).alias("containment"))
    )


def _may_hold(known: Column, templates: Sequence[Template]) -> Column:
    """Whether some template has enough of its words among ``known``."""
    enough = [F.size(F.array_intersect(known, _literal(t.distinct))) >= t.needed_distinct for t in templates]
    return reduce(or_, enough, F.lit(False))


def _blocks(words: Column, templates: Sequence[Template]) -> Column:
    """The blocks of a text that have enough words of some template."""
    longest = max((t.span for t in templates), default=1)
    vocabulary = _literal(sorted({w for t in templates for w in t.words}))
    starts = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)), F.lit(longest))
    runs = F.transform(starts, lambda at: F.slice(words, at, 2 * longest))
    return F.filter(runs, lambda run: _may_hold(F.array_intersect(run, vocabulary), templates))


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = CONTAINMENT) -> DataFrame:
    """One row per document (doc_id, text) with phrase counts, labels and score; see the module's text."""
    known_templates = templates_of(templates, least)
    vocabulary = sorted({w for t in known_templates for w in t.words})
    text = F.coalesce(F.col("text"), F.lit(""))
    none, no_blocks = F.array().cast("array<string>"), F.array().cast("array<array<string>>")
    every = F.col("every")
    words = F.when(text.rlike(f"(?i){KEYWORD}"), every).otherwise(none)
    blocks = F.when(_may_hold(F.col("known"), known_templates), _blocks(every, known_templates)).otherwise(no_blocks)
    per_phrase = [phrase_starts(F.col("words"), phrase) for phrase in PHRASES]
    kept = stored(
        docs.select("doc_id", "text", words_of(text).alias("every"))
        .select("*", (F.array_intersect(every, _literal(vocabulary)) if vocabulary else none).alias("known"))
        .select(
            "doc_id",
            F.size(every).cast("long").alias("n_words"),
            words.alias("words"),
            (blocks if vocabulary else no_blocks).alias("blocks"),
        )
        .select(
            "doc_id",
            "n_words",
            "blocks",
            *[starts.alias(label) for starts, label in zip(per_phrase, PHRASES.values(), strict=True)],
            F.monotonically_increasing_id().alias("row"),
        ),
        "licenses",
    )
    blocks = kept.select("row", F.explode("blocks").alias("words"))
    matches = template_matches(blocks, known_templates).groupBy("row")
    matches = matches.agg(F.collect_set("label").alias("more"), F.max("containment").alias("score"))
    labels = list(PHRASES.values())
    starts = F.concat(*labels)
    base = F.array_compact(F.array(*[F.when(F.size(label) > 0, F.lit(label)) for label in labels]))
    both = F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))
    return kept.drop("blocks").join(matches, "row", "left").select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )

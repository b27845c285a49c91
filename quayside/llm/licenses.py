"""License scans: phrases at their places, and an exact set-similarity join of text blocks with license templates.

A block is a window of consecutive words, over line breaks too, that is as long as the template and a slack: so a wrapped
notice is met, and words scattered over a text are not. A template matches a block if at least ``threshold`` of its
distinct words stand in it, among them all that it requires, and none that a narrower template requires besides (``nc``
for ``cc by``). Words are ordered by how often they occur in the whole corpus, rarest first. Of a template with ``n`` words,
of which ``need`` must be met, only the ``n - need + 1`` rarest are indexed: a block without any of them can't match. The
templates are a parameter of a few dozen lines at most, so the index is a literal map and the join needs no shuffle;
a text that no gate word occurs in is never cut into words.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from quayside.llm.common import LOWER, UPPER

#: Words of a text whose capitals A-Z are lower-cased; with capitals they are the same places of the raw text.
WORD, RAW_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Notices that are in use, with SPDX-like labels of our own and the words that a block can't do without.
TEMPLATES = (
    ("released under the mit license", "mit", "mit license"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", "mit", "permission granted charge copy"),
    ("licensed under the apache license version 2 0", "apache", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl", "gnu general public"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl", "gnu general public"),
    ("licensed under cc by 4 0", "cc-by", "cc by"),
    ("licensed under cc by nc 4 0", "cc-by-nc", "cc by nc"),
    ("licensed under cc by nd 4 0", "cc-by-nd", "cc by nd"),
    ("licensed under cc by sa 4 0", "cc-by-sa", "cc by sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd", "cc by nc nd"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa", "cc by nc sa"),
    ("released under the bsd 3 clause license", "bsd", "bsd"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd", "redistribution binary conditions"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl", "mozilla public"),
    ("all rights reserved no part of this publication may be reproduced", "all-rights-reserved",
     "reproduced rights reserved"),
)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), 0)


def word_counts(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each word of the vocabulary occurs in all texts; one row per word comes to the driver."""
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit(RAW_WORD), 0)).alias("w"))
    found = words.select(F.lower("w").alias("w")).filter(F.col("w").isin(vocabulary)).groupBy("w").count()
    return {row["w"]: row["count"] for row in found.collect()}


class Template(NamedTuple):
    """A template's distinct words in global order, how many must be met, how many are indexed, words that must or must
    not stand in a block, and the block's length."""
    label: str
    words: list[str]
    need: int
    head: int
    required: list[str]
    barred: list[str]
    width: int


def template_index(templates, counts: dict[str, int], threshold: float, slack: float) -> list[Template]:
    out = []
    for text, label, required in templates:
        words = sorted(set(text.split()), key=lambda w: (counts.get(w, 0), w))
        need = max(1, math.ceil(threshold * len(words) - 1e-9))
        must, length = set(required.split()), len(text.split())
        barred = {w for _, _, other in templates if must < set(other.split()) for w in set(other.split()) - must}
        out.append(Template(label, words, need, len(words) - need + 1, sorted(must), sorted(barred),
                            length + max(2, math.ceil(slack * length))))
    return out


def scan_licenses(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = 0.8,
                  slack: float = 0.25) -> DataFrame:
    """Add n_words, n_base, first_word, last_word, base_labels, labels and score to every row.

    ``score`` is 1 where a phrase stands, else the largest share of a template's words met in a block, 0 without a
    match. A block has ``slack`` of the template's length more words than it, two at least. A null text has no words;
    without phrases or templates there are no labels and empty texts for them. Each row is judged by itself, so ties,
    repeats and other columns don't matter; columns of these names are replaced, all others are kept.
    """
    vocabulary = sorted({w for text, *_ in templates for w in text.split()})
    index = template_index(templates, word_counts(docs, vocabulary) if templates else {}, threshold, slack)
    gate = sorted({w for t in index for w in t.words[:t.head]} | {p.split()[-1] for p, _ in phrases}) or ["\x00"]
    edge = RAW_WORD[:-1]
    text = F.coalesce("text", F.lit(""))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = docs.drop(*names).select(F.struct("*").alias("row"), text.alias("text")).withColumn(
        "_hit", F.col("text").rlike("(?i)(?<!" + edge + ")(?:" + "|".join(map(re.escape, gate)) + ")(?!" + edge + ")"))

    # Places of the phrases.
    words = F.when(F.col("_hit"), _words(F.col("text"))).otherwise(F.array().cast("array<string>"))
    places = [_places(F.col("_words"), phrase.split(), label) for phrase, label in phrases]
    none = F.array().cast("array<struct<at:int,label:string>>")
    rows = (rows.withColumn("_words", words)
            .withColumn("_base", F.when(F.size("_words") > 0, F.concat(*places, none)).otherwise(none)))

    # Blocks that meet a template.
    none = F.array().cast("array<struct<label:string,share:double>>")
    rows = rows.withColumn("_met", F.when(F.size("_words") > 0, _matches(F.col("_words"), index)).otherwise(none))

    at, base = F.transform("_base", lambda b: b["at"].cast("bigint")), F.transform("_base", lambda b: b["label"])
    more = F.transform("_met", lambda m: m["label"])
    best = F.array_max(F.transform("_met", lambda m: m["share"]))
    return rows.select(
        "row.*", F.regexp_count("text", F.lit(RAW_WORD)).cast("bigint").alias("n_words"),
        F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat(base, more))), ",").alias("labels"),
        F.when(F.size("_base") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))


def _places(words: Column, phrase: list[str], label: str) -> Column:
    """Where the phrase's words stand one after the other, counted from 0, each with the label."""
    spots = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)))
    wanted = F.array(*map(F.lit, phrase))
    starts = F.filter(spots, lambda i: F.slice(words, i + 1, len(phrase)) == wanted)
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))


def _matches(words: Column, index: list[Template]) -> Column:
    """The templates that a block meets, with the largest share of words met around each place.

    Each block that can match holds one of its template's indexed words, so only blocks around those are looked at.
    """
    if not index:
        return F.array().cast("array<struct<label:string,share:double>>")
    heads: dict[str, list[int]] = {}
    for i, t in enumerate(index):
        for w in t.words[:t.head]:
            heads.setdefault(w, []).append(i)
    posting = F.create_map(*[x for w, found in sorted(heads.items()) for x in (
        F.lit(w), F.array(*map(F.lit, found)))])

    def texts(values: list[str]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<string>")

    table = F.array(*[F.struct(
        F.lit(t.label).alias("label"), texts(t.words).alias("words"), F.lit(t.need).alias("need"),
        texts(t.required).alias("required"), texts(t.barred).alias("barred"), F.lit(t.width).alias("width"))
        for t in index])
    posted = F.filter(F.transform(words, lambda w, at: F.when(w.isin(sorted(heads)), F.struct(
        at.alias("at"), F.element_at(posting, w).alias("ts")))), lambda p: p.isNotNull())
    pairs = F.flatten(F.transform(posted, lambda p: F.transform(p["ts"], lambda i: F.struct(
        p["at"].alias("at"), F.element_at(table, i + 1).alias("t")))))

    def first(p: Column) -> Column:  # start of the blocks around the place
        return F.greatest(p["at"] - p["t"]["width"] + 1, F.lit(0))

    def near(p: Column) -> Column:
        """Length and position: the words around the place are enough, and all required ones are among them."""
        around = F.slice(words, first(p) + 1, p["at"] + p["t"]["width"] - first(p))
        return ((F.size(words) >= p["t"]["need"])
                & (F.size(F.array_except(p["t"]["required"], around)) == 0)
                & (F.size(F.array_intersect(p["t"]["words"], around)) >= p["t"]["need"]))

    def met(p: Column, start: Column) -> Column:
        block, t = F.slice(words, start + 1, p["t"]["width"]), p["t"]
        whole = (F.size(F.array_except(t["required"], block)) == 0) & ~F.arrays_overlap(t["barred"], block)
        return F.when(whole, F.size(F.array_intersect(t["words"], block))).otherwise(0)

    def best(p: Column) -> Column:
        n = F.array_max(F.transform(F.sequence(first(p), p["at"]), lambda start: met(p, start)))
        return F.struct(n.alias("n"), p["t"].alias("t"))

    return F.transform(F.filter(F.transform(F.filter(pairs, near), best), lambda m: m["n"] >= m["t"]["need"]),
                       lambda m: F.struct(m["t"]["label"].alias("label"), (m["n"] / F.size(m["t"]["words"])).alias("share")))

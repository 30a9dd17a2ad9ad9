"""Licence scan with a positional rare-token index.

A template is a run of words with a mandatory key phrase in it.  The index holds,
for each template, the two words of the key phrase that are rarest in the corpus
(highest IDF) and their positions.  A document looks up its words in the index;
each posting gives the place where the key phrase would start, and a place counts
when both words point to it and the phrase stands there word for word.  The score
is the IDF share of the whole template found in place.

Defined results: a null text is empty and has no words; a document without a
phrase has empty labels, score 0 and null first and last word; overlapping and
repeated places all count; ties in IDF go to the earlier word of the phrase; repeated
rows are scanned alike; other columns are never read.

Scale: two scans of the texts, no shuffle of them.  Document frequencies are counted
for the templates' words only (a fixed list), combined map-side; the index is a
literal in the plan.  Only DataFrame functions run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import text_or_empty

#: What separates words once A-Z is lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Base phrases: (label, phrase); every place counts.  Fixed values.
BASE = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
#: Further templates: (label, words before, key phrase, words after).
TEMPLATES = [
    ("apache", "licensed under the", "apache license version 2 0", "the license you may not use this file except in compliance"),
    ("mit", "permission is hereby granted free of charge", "to any person obtaining a copy of this software", "and associated documentation files"),
    ("bsd", "", "redistribution and use in source and binary forms", "with or without modification are permitted"),
    ("gpl", "redistribute it and or modify it under the terms of the", "gnu general public license as published by", "the free software foundation"),
    ("gpl-3.0", "under the", "gnu general public license version 3", ""),
    ("lgpl", "under the terms of the", "gnu lesser general public license", "as published by the free software foundation"),
    ("agpl", "under the terms of the", "gnu affero general public license", "as published by the free software foundation"),
    ("mpl", "subject to the terms of the", "mozilla public license", "v 2 0"),
    ("epl", "under the terms of the", "eclipse public license", "v 2 0"),
    ("cc-by-nc", "licensed under", "cc by nc", "4 0"),
    ("cc-by-sa", "licensed under", "cc by sa", "4 0"),
    ("cc-by-nd", "licensed under", "cc by nd", "4 0"),
    ("cc", "licensed under a", "creative commons attribution", "4 0 international license"),
    ("cc0", "", "cc0 1 0 universal", "public domain dedication"),
    ("unlicense", "this is free and unencumbered software", "released into the public domain", ""),
    ("isc", "permission to", "use copy modify and or distribute this software", "for any purpose with or without fee"),
    ("proprietary", "", "all rights reserved", ""),
]


def templates() -> list[dict]:
    """All templates: label, words, where the key phrase starts, the phrase, whether base."""
    out = [{"label": label, "words": p.split(), "at": 0, "phrase": p.split(), "base": True} for label, p in BASE]
    for label, before, phrase, after in TEMPLATES:
        b = before.split()
        out.append({"label": label, "words": b + phrase.split() + after.split(), "at": len(b), "phrase": phrase.split(), "base": False})
    return out


def words(text: Column) -> Column:
    """The words of lower-cased text."""
    return F.filter(F.split(text, SEPARATORS), lambda w: w != "")


def strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def idf_of(docs: DataFrame, found: list[dict]) -> dict[str, float]:
    """IDF over all documents of the templates' words."""
    vocabulary = sorted({w for t in found for w in t["words"]})
    own = F.array_intersect(F.split(F.lower(text_or_empty()), SEPARATORS), strings(vocabulary))
    df = docs.select(F.explode(F.concat(own, strings([""]))).alias("w")).groupBy("w").count().collect()
    df = {r[0]: r[1] for r in df}  # '' is on every row, so it counts the documents (or once more, at an edge)
    n = docs.count()
    return {w: math.log((1 + n) / (1 + df.get(w, 0))) for w in vocabulary}


def rare_words(t: dict, idf: dict[str, float]) -> list[tuple[str, int]]:
    """The two rarest words of the key phrase, with their positions in it."""
    order = sorted(range(len(t["phrase"])), key=lambda i: (-idf[t["phrase"][i]], i))
    return [(t["phrase"][i], i) for i in order[:2]]


def starts(w: Column, t: dict, rare: list[tuple[str, int]]) -> Column:
    """Where the key phrase of a template starts in the words ``w``: postings of its
    two rare words that agree on the place, verified word for word.  ``_p`` holds the
    places of indexed words."""
    (one, a), (two, b) = rare[0], rare[-1]
    return F.filter(F.transform("_p", lambda p: p - a), lambda s: (
        (s >= 0) & (F.get(w, s + a) == one) & (F.get(w, s + b) == two)
        & (F.slice(w, F.greatest(s, F.lit(0)) + 1, len(t["phrase"])) == strings(t["phrase"]))))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, matches (label and word place of each)."""
    found = templates()
    idf = idf_of(docs, found)
    rare = {i: rare_words(t, idf) for i, t in enumerate(found)}
    keys = strings(sorted({r[0][0] for r in rare.values()}))
    rows = docs.select("doc_id", text_or_empty().alias("_t")).withColumn("_w", words(F.lower("_t")))
    # only documents with an indexed word need exact words and places
    rows = rows.withColumn("n_words", F.size("_w").cast("long")) \
        .withColumn("_hit", F.arrays_overlap("_w", keys)) \
        .withColumn("_w", F.when(F.col("_hit"), words(F.translate("_t", UPPER, LOWER))).otherwise(strings([]))) \
        .withColumn("_p", F.filter(F.transform("_w", lambda w, i: F.when(F.array_contains(keys, w), i)), lambda i: i.isNotNull()))
    w = F.col("_w")
    for i, t in enumerate(found):
        rows = rows.withColumn(f"_s{i}", starts(w, t, rare[i]))
    base = [i for i, t in enumerate(found) if t["base"]]
    places = F.concat(*[F.col(f"_s{i}") for i in base])
    label = lambda which: F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*[
        F.when(F.size(f"_s{i}") > 0, F.lit(found[i]["label"])) for i in which]), lambda x: x.isNotNull()))), ",")

    def share(i: int) -> Column:
        """Largest IDF share of template i in place at one of its starts."""
        t = found[i]
        total = sum(idf[x] for x in t["words"])
        if not total or len(t["words"]) == len(t["phrase"]):
            return F.when(F.size(f"_s{i}") > 0, F.lit(1.0)).otherwise(F.lit(0.0))
        at = t["at"]
        held = F.transform(f"_s{i}", lambda s: sum(
            (F.when(F.get(w, F.when(s >= at - j, s + (j - at))) == x, F.lit(idf[x] / total)).otherwise(F.lit(0.0)) for j, x in enumerate(t["words"])), F.lit(0.0)))
        return F.coalesce(F.array_max(held), F.lit(0.0))

    def match(i: int) -> Column:
        return F.transform(f"_s{i}", lambda s: F.struct(F.lit(found[i]["label"]).alias("label"), s.cast("long").alias("word"),
                                                        F.lit(found[i]["base"]).alias("base")))

    matches = F.concat(*[match(i) for i in range(len(found))])
    return rows.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        label(base).alias("base_labels"), label(range(len(found))).alias("labels"),
        F.least(F.lit(1.0), F.greatest(*[share(i) for i in range(len(found))])).alias("score"), matches.alias("matches"))

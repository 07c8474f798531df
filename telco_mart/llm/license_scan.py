"""License scan with a positional rare-token index.

A template is a short license text: a list of words, of which some phrases are
mandatory. The index holds, for each template, its rarest words: in falling
order of their inverse document frequency, until those left out weigh less than
a place may miss. A place (template, start) with enough of the template's weight
therefore holds at least one indexed word, and looking up only these loses none.

Each text is one row from start to end, with no shuffle: its words that stand in
the index are looked up, each posting (template, position) gives the start at
word position - template position, and the postings of a template's indexed
words are intersected at that relative position: what they weigh together must
leave no more than a place may miss. Places that pass are compared word by word,
must hold every mandatory phrase, and score the weight of their equal words over
the weight of all words. The index is built from the counts of the license words
over all documents (one aggregate; its size is bounded by the templates) and is
part of the expressions, so the job is DataFrame functions only.

Words are runs of ASCII digits, ASCII letters (A-Z lower-cased) and all other
code points from U+0080. The base phrases are templates that are mandatory as a
whole. Places lie inside the text and may overlap; each template is found at
every place that reaches the threshold.

Inputs: null text counts as empty and has no words; texts of any length are
scanned whole; repeated rows and null ids are scanned row by row; a template
that reaches a score twice is listed at both starts (ties keep the order of
templates, then of starts); empty tables give empty results. Only the id and
text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False


def split_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


# Phrases and their labels.
BASE = [
    Template(label, phrase, (phrase,), base=True)
    for phrase, label in (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
]
# The customary notices of public licenses, and their short forms.
NOTICES = [
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", ("gnu general public license", "free software foundation")),
    Template("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", ("gnu affero general public license",)),
    Template("apache-2.0", "licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ("compliance with the license", "apache org licenses")),
    Template("mit", "released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("free of charge", "associated documentation files")),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("source and binary forms", "with or without modification")),
    Template("bsd-3-clause", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ("endorse or promote products",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("epl-2.0", "made available under the terms of the Eclipse Public License 2.0", ("eclipse public license",)),
    Template("cc-by-4.0", "licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-nc-4.0", "licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa-4.0", "licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-nd-4.0", "licensed under CC BY-ND 4.0", ("cc by nd",)),
    Template("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    Template("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ("attribution sharealike",)),
    Template("cc0-1.0", "waived all copyright and related or neighboring rights to this work", ("waived all copyright", "neighboring rights")),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
    Template("bsl-1.0", "Distributed under the Boost Software License, Version 1.0", ("boost software license",)),
    Template("zlib", "This software is provided 'as-is', without any express or implied warranty", ("express or implied warranty",)),
]
TEMPLATES = BASE + NOTICES


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


@dataclass(frozen=True)
class Entry:
    """A template as the index holds it: words and their weights, the indexed
    positions, what these must weigh at one place, the mandatory positions."""

    template: Template
    words: list[str]
    weights: list[float]
    indexed: list[int]
    needed: float
    mandatory: list[int]

    @property
    def total(self) -> float:
        return sum(self.weights)


def mandatory_positions(template: Template, words: list[str]) -> list[int]:
    found: set[int] = set()
    for phrase in template.phrases:
        p = split_words(phrase)
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        if not at:
            raise ValueError(f"'{phrase}' is not part of the template of {template.label}")
        found.update(range(at[0], at[0] + len(p)))
    return sorted(found)


def build_index(frequencies: dict[str, int], documents: int, templates: list[Template], threshold: float = THRESHOLD) -> list[Entry]:
    """Entries of the templates, with words weighted by how few documents have them."""
    weight = lambda w: math.log(1 + documents / (1 + frequencies.get(w, 0))) + 0.01
    out = []
    for t in templates:
        words = split_words(t.text)
        weights = [weight(w) for w in words]
        slack = (1 - threshold) * sum(weights) * (1 + 1e-9)  # sums of doubles depend on their order
        mass = {w: weight(w) * words.count(w) for w in words}
        rare, held = set(), 0.0
        for w in sorted(mass, key=lambda w: (-weight(w), w)):
            if held > slack:
                break
            rare.add(w)
            held += mass[w]
        indexed = [i for i, w in enumerate(words) if w in rare]
        out.append(Entry(t, words, weights, indexed, held - slack, mandatory_positions(t, words)))
    return out


def document_frequencies(df: DataFrame, templates: list[Template], text_col: str = "text") -> tuple[dict[str, int], int]:
    """Documents that hold each word of the templates, and all documents."""
    vocabulary = sorted({w for t in templates for w in split_words(t.text)})
    words = df.select(word_list(F.col(f"`{text_col}`")).alias("words"))
    held = F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))
    n = words.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counts = {r.word: r.n for r in n.collect()}  # no more rows than the templates have words
    return counts, counts.pop("", 0)


def _numbers(values: list, kind: str) -> Column:
    return F.array(*(F.lit(v) for v in values)).cast(f"array<{kind}>")


def _postings(entries: list[Entry]) -> Column:
    """word -> its (template, position) pairs, as template * 2^32 + position."""
    at: dict[str, list[int]] = {}
    for t, e in enumerate(entries):
        for i in e.indexed:
            at.setdefault(e.words[i], []).append((t << 32) + i)
    return F.create_map(*(c for w, p in at.items() for c in (F.lit(w), _numbers(p, "bigint"))))


def places(words: Column, entries: list[Entry], threshold: float = THRESHOLD) -> list[tuple[str, Column]]:
    """Steps from the words of a text to its places, each a named column that
    refers to the ones before."""
    indexed = sorted({e.words[i] for e in entries for i in e.indexed})
    per = lambda make, kind: F.array(*(make(e) for e in entries)).cast(f"array<{kind}>")
    word_at = lambda start, i: F.get(words, start + i)
    n, template, start = F.size(words), lambda c: F.shiftright(c, 32).cast("int"), lambda c: c.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    length = per(lambda e: F.lit(len(e.words)), "int")
    needed = per(lambda e: F.lit(e.needed), "double")
    total = per(lambda e: F.lit(e.total), "double")
    checked = per(lambda e: F.array(*(F.struct(F.lit(i), F.lit(e.words[i]), F.lit(e.weights[i])) for i in e.indexed)), "array<struct<i:int,word:string,weight:double>>")
    whole = per(lambda e: F.array(*(F.struct(F.lit(i), F.lit(w), F.lit(x)) for i, (w, x) in enumerate(zip(e.words, e.weights)))), "array<struct<i:int,word:string,weight:double>>")
    must = per(lambda e: F.array(*(F.struct(F.lit(i), F.lit(e.words[i])) for i in e.mandatory)), "array<struct<i:int,word:string>>")
    label = per(lambda e: F.lit(e.template.label), "string")
    base = per(lambda e: F.lit(e.template.base), "boolean")
    zero = F.lit(0.0)

    def weighed(parts: Column, at: Column) -> Column:
        """What the parts of a template weigh whose word stands at its place."""
        return F.aggregate(parts, zero, lambda sum_, p: sum_ + F.when(word_at(at, p["i"]) == p["word"], p["weight"]).otherwise(zero))

    hits = F.filter(F.transform(words, lambda w, i: F.when(w.isin(indexed), i)), lambda i: i.isNotNull())
    empty = F.array().cast("array<bigint>")
    postings = lambda i: F.coalesce(F.try_element_at(_postings(entries), F.get(words, i)), empty)
    # posting (t, q) at word i: (t << 32) + q becomes (t << 32) + (i - q) where the place begins inside the text
    shifted = lambda i, p: F.when(start(p) <= i, p - start(p) + (i - start(p)))
    starts = F.array_distinct(F.flatten(F.transform("hits", lambda i: F.transform(postings(i), lambda p: shifted(i, p)))))
    inside = lambda c: c.isNotNull() & (start(c) + F.get(length, template(c)) <= n)
    common = lambda c: weighed(F.get(checked, template(c)), start(c)) >= F.get(needed, template(c))
    verified = lambda c: F.forall(F.get(must, template(c)), lambda p: F.coalesce(word_at(start(c), p["i"]) == p["word"], F.lit(False)))
    score = lambda c: F.least(weighed(F.get(whole, template(c)), start(c)) / F.get(total, template(c)), F.lit(1.0))
    scored = lambda c: F.struct(
        template(c).alias("template"), start(c).alias("start"), F.get(length, template(c)).alias("length"),
        F.get(label, template(c)).alias("label"), F.get(base, template(c)).alias("base"), score(c).alias("score"),
    )
    return [
        ("hits", hits),
        ("starts", F.filter(starts, lambda c: inside(c))),
        ("starts", F.filter("starts", lambda c: common(c))),
        ("places", F.array_sort(F.filter(F.transform(F.filter("starts", verified), scored), lambda p: p["score"] >= threshold))),
    ]


def scan(df: DataFrame, templates: list[Template] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_words, places) for every row; places is an array of (template,
    start, length, label, base, score) in order of template and start."""
    entries = build_index(*document_frequencies(df, templates, text_col), templates, threshold)
    out = df.select(F.col(f"`{id_col}`").alias(id_col), word_list(F.col(f"`{text_col}`")).alias("words"))
    for name, column in places(F.col("words"), entries, threshold):
        out = out.withColumn(name, column)
    return out.select(id_col, F.size("words").cast("long").alias("n_words"), "places")


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score):
    base columns count the places of base templates, score is the best of all."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform("base", lambda p: p["start"].cast("long"))
    labels = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda p: p["label"]))), ",")
    best = F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0))
    return found.withColumn("base", base).select(
        id_col, "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels("base").alias("base_labels"), labels("places").alias("labels"), best.alias("score"),
    )

"""Licence notices in texts by a positional index over rare words.

The index holds licence templates as words with their positions. Of each template only the words that the fewest documents of
the corpus have (the highest IDF) are looked up. A hit of such a word at place p of a text, t words into its template, says that
the template would begin at p - t; rare words that agree on that, within half a band of words, are votes for a notice there. It
is accepted if enough of the template's rare words vote and all its key phrases stand at their places as well.

A phrase is looked up by its rarest word alone, and each hit is verified on the words around it, so every place is found
whatever else the text holds. Base phrases give a label wherever they stand.

Two scans, both without a shuffle of words: one counts documents per licence word, the other writes the few hits. The index is
broadcast; its size is that of the templates. Only DataFrame functions run.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadloom.llm.graphs import written

#: What separates words of lowered text.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The only characters beyond ASCII whose lower case is in ASCII (Kelvin sign, dotted I), and what stands for them.
BEYOND = {"\u212a": "\u03ba", "\u0130": "\u0131"}
#: Places of a template may drift by half a band of words.
BAND = 32
#: Rare words of a template that are looked up: a third of its words, within these bounds.
LEAST_RARE, MOST_RARE = 2, 16
#: Per cent of them that a notice must have.
VOTES = 50
#: Stands behind the last word of every text, so that its place counts the words. No text holds it as a word.
END = "\u0000"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]


#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Public licence notices and the phrases that must not be missing from them.
TEMPLATES = (
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software.",
        ("permission is hereby granted free of charge", "shall be included in all copies"),
    ),
    Template("apache", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        ("source and binary forms", "conditions are met"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("with or without fee",),
    ),
    Template("gpl-notice", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license",)),
    Template(
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version",
        ("gnu general public license", "free software foundation"),
    ),
    Template("lgpl", "under the terms of the GNU Lesser General Public License", ("lesser general public license",)),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template(
        "creative-commons",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution",),
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("released into the public domain",)),
)


def words_of(text: str) -> list[str]:
    """The words of a template or phrase, as ``words`` takes those of a column."""
    return [w for w in re.split(GAP, "".join(BEYOND.get(c, c) for c in text).lower()) if w]


def words(text: Column) -> Column:
    """Lowered maximal runs of ASCII letters and digits and all characters beyond ASCII; none for null.

    No character beyond ASCII becomes one of A-Z, so for words in ASCII this is the lower case of A-Z alone.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    for char, other in BEYOND.items():
        text = F.replace(text, F.lit(char), F.lit(other))
    return F.array_remove(F.split(F.lower(text), GAP, -1), "")


def n_rare(template: Template) -> int:
    """How many different words of a template are looked up."""
    return min(max(math.ceil(len(words_of(template.text)) / 3), LEAST_RARE), MOST_RARE)


def vocabulary(templates: Sequence[Template] = TEMPLATES, phrases: Mapping[str, str] = PHRASES) -> list[str]:
    texts = [*phrases, *(t.text for t in templates)]
    return sorted({w for text in texts for w in words_of(text)})


def document_counts(docs: DataFrame, vocab: Sequence[str]) -> dict[str, int]:
    """In how many rows of ``docs`` each word of ``vocab`` stands. One row per licence word reaches the driver."""
    met = F.array_intersect(words(F.col("text")), F.array(*[F.lit(w) for w in vocab]))
    # The outer form: the other one would make the planner split each text twice, to drop rows without words first.
    counts = docs.select(F.explode_outer(met).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    found = {r["word"]: r["n"] for r in counts}
    return {w: found.get(w, 0) for w in vocab}


def _places(inner: list[str], outer: list[str]) -> list[int]:
    return [i for i in range(len(outer) - len(inner) + 1) if outer[i : i + len(inner)] == inner]


def index_rows(counts: Mapping[str, int], templates: Sequence[Template], phrases: Mapping[str, str]) -> list[tuple]:
    """(word, at, unit, kind, part, phrase) of every posting.

    ``at`` is the word's place in what it is a posting of. Kind 0: a base phrase, 1: a rare word of a template, 2: a key phrase
    of a template; ``unit`` numbers phrases or templates. ``part`` tells rare words or key phrases of a template apart. Base and
    key phrases hold their words in ``phrase``, to be verified.
    """
    rare = lambda ws: sorted(set(ws), key=lambda w: (counts[w], w))
    rows = []
    for unit, phrase in enumerate(phrases):
        ws = words_of(phrase)
        rows.append((rare(ws)[0], ws.index(rare(ws)[0]), unit, 0, 0, ws))
    for unit, template in enumerate(templates):
        ws = words_of(template.text)
        for part, word in enumerate(rare(ws)[: n_rare(template)]):
            rows += [(word, at, unit, 1, part, None) for at in _places([word], ws)]
        for part, key in enumerate(template.keys):
            ks = words_of(key)
            word = rare(ks)[0]
            # ``at`` leads to the template's beginning, the phrase is read from its own.
            rows += [(word, at + ks.index(word), unit, 2, part, ks) for at in _places(ks, ws)]
    return rows


def hits(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """(row, doc_id, unit, kind, part, place) of every hit in ``docs``, written.

    ``row`` numbers the rows of ``docs``. ``place`` is the word where a base phrase stands, and for the other kinds the one where
    the template would begin. Kind 3 has one hit per row, whose place is the number of words.
    """
    spark = docs.sparkSession
    counts = document_counts(docs, vocabulary(templates, phrases))
    postings = {}
    for word, at, unit, kind, part, phrase in index_rows(counts, templates, phrases):
        own = phrase.index(word) if phrase else 0
        postings.setdefault(word, []).append((at, unit, kind, part, own, phrase))
    postings[END] = [(0, 0, 3, 0, 0, None)]
    entry = "array<struct<at:int, unit:int, kind:int, part:int, own:int, phrase:array<string>>>"
    index = spark.createDataFrame(sorted(postings.items()), f"word string, postings {entry}")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), words(F.col("text")).alias("ws"))
    rows = rows.withColumn("ws", F.concat("ws", F.array(F.lit(END))))
    rows = rows.select("row", "doc_id", "ws", F.posexplode_outer("ws").alias("pos", "word"))
    found = rows.join(F.broadcast(index), "word").select("row", "doc_id", "ws", "pos", F.explode("postings").alias("p"))
    begin = F.col("pos") - F.col("p.own")
    stands = F.when(F.col("p.phrase").isNull(), F.lit(True)).when(begin >= 0, F.slice("ws", F.greatest(begin, F.lit(0)) + 1, F.size("p.phrase")) == F.col("p.phrase"))
    found = found.where(stands).select("row", "doc_id", "p.unit", "p.kind", "p.part", (F.col("pos") - F.col("p.at")).alias("place"))
    return written(found, "licence-hits")


def _labelled(unit: Column, labels: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(x) for x in labels]), unit) if labels else F.lit(None).cast("string")


def notices(found: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """(row, doc_id, label, band, share, accepted): each place with votes for a template in ``hits``.

    Bands of ``BAND`` words overlap by half, so votes at most half a band apart share one; a notice may show in two bands.
    """
    totals = [n_rare(t) if len(set(words_of(t.text))) >= n_rare(t) else len(set(words_of(t.text))) for t in templates]
    votes = found.where("kind in (1, 2)").withColumn("shift", F.explode(F.array(F.lit(0), F.lit(BAND // 2))))
    votes = votes.withColumn("band", F.floor((F.col("place") + F.col("shift")) / BAND))
    parts = lambda kind: F.size(F.collect_set(F.when(F.col("kind") == kind, F.col("part"))))
    votes = votes.groupBy("row", "unit", "shift", "band").agg(F.first("doc_id").alias("doc_id"), parts(1).alias("votes"), parts(2).alias("keys"))
    number = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("unit"))
    if not templates:
        return votes.selectExpr("row", "doc_id", "'' as label", "band", "0D as share", "false as accepted").where("false")
    accepted = (F.col("votes") * 100 >= number(totals) * VOTES) & (F.col("keys") == number([len(t.keys) for t in templates]))
    label = _labelled(F.col("unit"), [t.label for t in templates])
    return votes.select("row", "doc_id", label.alias("label"), "band", (F.col("votes") / number(totals)).alias("share"), accepted.alias("accepted"))


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per row of ``docs`` (doc_id, text).

    ``n_base`` counts all places of all base phrases. ``score`` is 1 where a base phrase stands, else the largest share of a
    template's rare words found at one place. Null and empty texts have no words, no labels and score 0; a null doc_id stays
    null; repeated rows and ids give a row each; ties among equally rare words go by the word; an empty table gives no rows.
    Other columns are ignored, whatever their names. Texts may be of any length.
    """
    found = hits(docs, templates, phrases)
    base = F.col("kind") == 0
    label = _labelled(F.col("unit"), list(phrases.values()))
    per_row = found.where("kind in (0, 3)").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max(F.when(~base, F.col("place"))).cast("bigint").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("place"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("place"))).cast("bigint").alias("last_word"),
        F.array_sort(F.collect_set(F.when(base, label))).alias("base"),
    )
    more = notices(found, templates).groupBy("row").agg(F.collect_set(F.when(F.col("accepted"), F.col("label"))).alias("more"), F.max("share").alias("share"))
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    return per_row.join(more, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )

"""License scans by diagonal voting.

Built from DataFrame functions only. Every rolling k-gram of a document's words
is hashed and joined to the positions of equal grams in license templates; the
words themselves are compared in the same join. A hit votes for its diagonal,
the difference of both positions: a passage that repeats a template's words
puts all its hits on one diagonal. Votes are counted by (document, template,
diagonal) as sets of template positions, so a repeated gram counts once.
Diagonals that are at most ``slack`` words apart are merged (a word put in or
left out moves the rest of a passage to the next diagonal), and a merged span
is verified: the template words that its hits cover, as a share of the
template, must reach ``least``, on one diagonal or within a span of at most one
and a half times the template's length.

A template of kind ``phrase`` is one gram in full: each diagonal that holds all
its votes is a place, and places are never merged.

Templates are a parameter and small: their grams are broadcast up to
``BROADCAST_GRAMS``, beyond which the join shuffles. Texts are never shuffled:
what is shuffled are the votes, combined before, and one narrow row a document.

What happens in special cases:

* null and empty texts and texts without words have no words and no labels;
  their positions are null, their score is 0;
* rows with the same id and the same text get the same result each; rows that
  share only the id are told apart by a 64-bit hash of their texts; null ids
  are ids like others;
* lower-casing concerns A to Z only; other letters stay as they are;
* places may overlap, and all count; one hit may vote on several diagonals if
  its gram occurs repeatedly in a template;
* other columns of the input are not carried; an empty table gives an empty
  result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.shared import materialise

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words in a gram; a shorter template is one gram.
GRAM = 3
SLACK = 3
LEAST = 0.75
BROADCAST_GRAMS = 200_000
BROADCAST_DOCS = 1_000_000

#: Phrases whose places are counted (fixed values).
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

#: License notices as their publishers word them (fixed values).
NOTICES = [
    ("mit-notice", "Released under the MIT License"),
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0-text",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-text",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    (
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0-text", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
]


def words(text: Column) -> Column:
    """The words of a text in order; no words for null."""
    split = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN, -1)
    return F.filter(split, lambda w: w != "")


def _grams(found: Column, size: int) -> Column:
    """array<struct<p, pair, gram, said>>: each position's hashes of two and of ``size`` words, and these words."""

    def gram(i: Column) -> Column:
        each = [F.get(found, i + k) for k in range(size)]
        return F.struct(i.alias("p"), F.xxhash64(*each[:2]).alias("pair"), F.xxhash64(*each).alias("gram"), F.concat_ws(" ", *each).alias("said"))

    return F.transform(F.sequence(F.lit(0), F.size(found) - 2), gram)


def template_grams(docs: DataFrame, phrases: list[tuple[str, str]], notices: list[tuple[str, str]]) -> DataFrame:
    """``label, kind, t_words, t_grams, q, k, t_pair, t_gram, t_said``: the positions of the templates' grams."""
    rows = [(label, kind, text) for kind, some in (("phrase", phrases), ("notice", notices)) for label, text in some]
    if any(not 2 <= len(text.split()) <= GRAM for _, text in phrases):
        raise ValueError(f"a phrase has 2 to {GRAM} words")
    said = docs.sparkSession.createDataFrame(rows, "label string, kind string, text string").select("label", "kind", words(F.col("text")).alias("w"))
    n = F.size("w")
    said = said.filter(n >= 2).withColumn("k", F.when(F.col("kind") == "phrase", n).otherwise(F.least(n, F.lit(GRAM))))
    at = F.explode(F.sequence(F.lit(0), n - F.col("k")))
    placed = said.select("label", "kind", "w", "k", n.alias("t_words"), (n - F.col("k") + 1).alias("t_grams"), at.alias("q"))
    each = [F.get("w", F.col("q") + j) for j in range(GRAM)]
    return placed.select("label", "kind", "t_words", "t_grams", "q", "k", F.xxhash64(*each[:2]).alias("t_pair"), F.when(F.col("k") == GRAM, F.xxhash64(*each)).alias("t_gram"), F.array_join(F.slice("w", F.col("q") + 1, F.col("k")), " ").alias("t_said"))


def votes(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, label, kind, t_words, t_grams, k, diagonal, met, first, last``: votes of each diagonal."""
    templates = template_grams(docs, phrases, notices)
    n = sum(len(text.split()) for _, text in phrases + notices)
    templates = F.broadcast(templates) if n <= BROADCAST_GRAMS else templates
    split = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), words(F.col(text_col)).alias("w")).filter(F.size("w") >= 2)
    grams = split.select("doc_id", "text_key", F.explode(_grams(F.col("w"), GRAM)).alias("g")).select("doc_id", "text_key", "g.*")
    # A gram of two words is checked against the first two of the three.
    same = (F.col("pair") == F.col("t_pair")) & F.when(F.col("k") == GRAM, (F.col("gram") == F.col("t_gram")) & (F.col("said") == F.col("t_said"))).otherwise(F.substring_index("said", " ", 2) == F.col("t_said"))
    hits = grams.join(templates, same)
    return hits.groupBy("doc_id", "text_key", "label", "kind", "t_words", "t_grams", "k", (F.col("p") - F.col("q")).alias("diagonal")).agg(F.collect_set("q").alias("met"), F.min("p").alias("first"), F.max("p").alias("last"))


def _covered(met: Column) -> Column:
    """Template words that the grams at positions ``met`` cover."""
    return F.size(F.array_distinct(F.flatten(F.transform(met, lambda q: F.sequence(q, q + F.col("k") - 1)))))


def spans(voted: DataFrame, slack: int = SLACK, least: float = LEAST) -> DataFrame:
    """``doc_id, text_key, label, kind, start, stop, coverage``: places of phrases, and verified spans of notices."""
    places = voted.filter((F.col("kind") == "phrase") & (F.size("met") == F.col("t_grams")))
    places = places.select("doc_id", "text_key", "label", "kind", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("t_words")).alias("stop"), F.lit(1.0).alias("coverage"))
    line = Window.partitionBy("doc_id", "text_key", "label").orderBy("diagonal")
    notices = voted.filter("kind = 'notice'").withColumn("apart", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(line) > slack).cast("int"), F.lit(0)))
    merged = (
        notices.withColumn("alone", _covered(F.col("met")))
        .withColumn("run", F.sum("apart").over(line))
        .groupBy("doc_id", "text_key", "label", "kind", "t_words", "k", "run")
        .agg(F.array_distinct(F.flatten(F.collect_list("met"))).alias("met"), F.max("alone").alias("alone"), F.min("first").alias("start"), (F.max("last") + F.first("k")).alias("stop"))
    )
    together = F.when((F.col("stop") - F.col("start")) * 2 <= F.col("t_words") * 3, _covered(F.col("met"))).otherwise(0)
    found = merged.withColumn("coverage", F.greatest("alone", together) / F.col("t_words"))
    return places.unionByName(found.filter(F.col("coverage") >= least).select("doc_id", "text_key", "label", "kind", "start", "stop", "coverage"))


def scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every document."""
    phrase = F.col("kind") == "phrase"
    found = spans(materialise(votes(docs, phrases, notices, id_col, text_col), "license-votes"))  # read twice
    per = found.groupBy(F.col("doc_id").alias("s_id"), F.col("text_key").alias("s_key")).agg(
        F.count_if(phrase).alias("n_base"),
        F.min(F.when(phrase, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(phrase, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(phrase, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score"),
    )
    per = materialise(per, "license-spans")
    if per.count() <= BROADCAST_DOCS:
        per = F.broadcast(per)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.size(words(F.col(text_col))).cast("long").alias("n_words"))
    joined = rows.join(per, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("text_key") == F.col("s_key")), "left")
    nothing = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}
    return joined.select("doc_id", "n_words", *[(F.coalesce(F.col(c), F.lit(nothing[c])) if c in nothing else F.col(c)).alias(c) for c in ("n_base", "first_word", "last_word", "base_labels", "labels", "score")])

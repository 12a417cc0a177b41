r"""License scan by diagonal voting, in DataFrame expressions only.

1. Every rolling window of ``K`` words of every text is hashed and joined to the
   hashed windows of the license templates (one row a window, a few hundred for the
   fixed ones; broadcast up to ``BROADCAST_WINDOWS``); a hit is one (text place,
   template place) whose windows are equal word for word.
2. Hits are counted by offset diagonal (text place minus template place).
3. Diagonals of one template that lie within ``SLACK`` of the one before are
   merged: inserted or dropped words shift the rest of a license by a few places.
4. A merged band is a license where the hits in some span of it, not longer than twice the
   template, cover ``MIN_COVER`` percent of the template's windows.  Every hit is tried as the
   span's begin, so repeated openings before a license do not hide it; a band gives its best span.

Base phrases are found as consecutive words and always give their label.

Defined results: null texts are empty; long texts are scanned whole; of spans that cover as much the first
is given; equal rows get equal results; an empty
table gives no rows; in the general form other columns pass through unless a
new column has their name (then the new one replaces them).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# word characters of the contract; upper-case letters are split as word characters and lowered after
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
K = 6
SLACK = 8
MIN_COVER = 60
BROADCAST_WINDOWS = 200_000

# Base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# License wordings (public texts and notices) that the method looks for.
TEMPLATES = {
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not "
        "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
        "Released under the MIT License; see the license file for details.",
    ],
    "apache-2": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
}


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z only) words."""
    split = F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")
    return F.transform(split, lambda w: F.when(F.octet_length(w) == F.char_length(w), F.lower(w))
                       .otherwise(F.translate(w, UPPER, LOWER)))


def template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^0-9a-z]+", text.lower()) if w]


def template_rows(templates: dict[str, list[str]] | None = None) -> list[tuple]:
    """(label, template, windows, place, window) for every window of every template."""
    out = []
    for label, texts in sorted((templates or TEMPLATES).items()):
        for i, t in enumerate(texts):
            w = template_words(t)
            n = len(w) - K + 1
            if n < 1:
                raise ValueError(f"a template of {label} has fewer than {K} words")
            out += [(label, f"{label}-{i}", n, p, " ".join(w[p:p + K])) for p in range(n)]
    return out


def phrase_places(words: Column, joined: Column, phrase: str) -> Column:
    """Word places where the phrase's words stand; the list is walked only where the phrase occurs."""
    p = phrase.split(" ")
    here = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - len(p), F.lit(0))),
                    lambda i: F.array_join(F.slice(words, i + 1, F.lit(len(p))), " ") == phrase)
    return F.when(joined.contains(f" {phrase} "), here).otherwise(F.array().cast("array<int>"))


def license_hits(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """Verified license spans: rows ``(key, label, template, first, last, cover)``.

    ``docs``: rows ``(key, words)``.
    """
    spark = docs.sparkSession
    listed = template_rows(templates)
    known = spark.createDataFrame(
        listed, "label string, template string, windows int, tpos int, window string").withColumn("h", F.xxhash64("window"))
    windows = docs.filter(F.size("words") >= K).select("key", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.size("words") - K),
        lambda i: F.concat_ws(" ", *[F.get(F.col("words"), i + j) for j in range(K)]))).alias("pos", "window"))
    hits = windows.withColumn("h", F.xxhash64("window")).join(
        F.broadcast(known) if len(listed) <= BROADCAST_WINDOWS else known, ["h", "window"])
    votes = hits.groupBy("key", "label", "template", "windows", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.collect_set("tpos").alias("places"))
    by = Window.partitionBy("key", "template").orderBy("diagonal")
    banded = (votes.withColumn("new", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > SLACK, F.lit(True)))
              .withColumn("band", F.sum(F.col("new").cast("int")).over(by)))
    band = Window.partitionBy("key", "template", "band")
    enough = F.col("windows") * MIN_COVER
    places = (banded.withColumn("all", F.size(F.array_distinct(F.flatten(F.collect_list("places").over(band)))))
              .filter(F.col("all") * 100 >= enough)
              .select("key", "label", "template", "windows", "band", "diagonal", F.explode("places").alias("tpos"))
              .withColumn("pos", F.col("diagonal") + F.col("tpos")))
    # begins of a span's hits lie at most 2 (windows + K - 1) - K places apart; the half keeps whole places
    # off the frame's border
    reach = 2 * (F.col("windows") + K - 1) - K + F.lit(0.5)
    span = band.orderBy("scaled").rangeBetween(0, 1)
    spans = (places.withColumn("scaled", F.col("pos") / reach)
             .withColumn("covered", F.size(F.collect_set("tpos").over(span)))
             .withColumn("last", F.max("pos").over(span) + K - 1)
             .filter(F.col("covered") * 100 >= enough)
             .withColumn("cover", F.col("covered") / F.col("windows")))
    return (spans.groupBy("key", "label", "template", "band").agg(F.min(F.struct(
        (-F.col("cover")).alias("cover"), F.col("pos").alias("first"), F.col("last").alias("last"))).alias("b"))
            .select("key", "label", "template", "b.first", "b.last", (-F.col("b.cover")).alias("cover")))


def document_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """Query form: base places and labels, the method's labels, best cover as score.

    ``templates``: label to texts, for example whole licenses, in place of the fixed ones.
    """
    pad = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    base = (docs.select("doc_id", F.struct(*[F.xxhash64(F.lit(n), "doc_id", F.coalesce("text", F.lit(""))).alias(f"k{n}") for n in (1, 2)])
                        .alias("key"),
                        words_of(F.col("text")).alias("words")))
    spans = license_hits(base.select("key", "words"), templates)
    found = spans.groupBy("key").agg(F.collect_set("label").alias("found"), F.max("cover").alias("cover"))
    at = {p: f"at{i}" for i, p in enumerate(PHRASES)}
    placed = base.withColumn("joined", pad)
    placed = placed.withColumns({c: phrase_places(F.col("words"), F.col("joined"), p) for p, c in at.items()}).select(
        "doc_id", "key", F.size("words").cast("long").alias("n_words"), *at.values())
    every = F.concat(*[F.col(c) for c in at.values()])
    counted = placed.select(
        "doc_id", "key", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_compact(F.array(*[
            F.when(F.size(c) > 0, F.lit(PHRASES[p])) for p, c in at.items()]))).alias("base"))
    out = counted.join(found, "key", "left")
    both = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.greatest(F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.lit(0.0)),
                   F.coalesce("cover", F.lit(0.0))).alias("score"))

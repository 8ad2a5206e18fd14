r"""License notices: fixed phrases, and an exact set-similarity join of text blocks with templates. DataFrame functions only.

Base: places where the words of a phrase stand consecutively. Words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of the text with A-Z
lower-cased.

Added by the method: the label of every template of which some block holds at least `threshold` of the distinct words. A block is
a run of `span` lines, one starting at each line. The words of the templates are ordered by how many documents hold them, over
all documents, rarest first. A block that holds ceil(threshold |T|) of a template's words holds one of the first
|T| - ceil(threshold |T|) + 1 (prefix), has that many template words at all (length), and as many from the shared one on
(position); blocks that pass are counted whole. So no block that meets the threshold is missed.

With `runs`, blocks are also all runs of consecutive words, 1 / threshold times as many as the template has words, so that line
breaks and blank lines don't decide. They go through the same filters: a document meets a template by a shared prefix word,
with enough template words at all, and enough of them from that word's place in the order on; then only the runs around a prefix
word are counted. Only of documents that hold enough of a template at all are the words' places kept.

Every text is read whole, once. NULL and empty texts have no words, places or labels; repeated rows have a result each.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import settle

# Phrases with their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# The opening words of common public license notices.
TEMPLATES = [
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
]

_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
PLACE = rf"(?:\A|(?<={_GAP}))(?i:" + "|".join(f"{_GAP}+".join(p.split()) for p in PHRASES) + rf")(?={_GAP}|\z)"
THRESHOLD, SPAN = 0.8, 4


def words_of(template: str) -> list[str]:
    return sorted(set(re.findall(r"[0-9a-z]+", template.lower())))


def run_of(template: str, threshold: float) -> int:
    """Words of a run: the template's, and as large a share of other words as may be missing."""
    return math.ceil(len(re.findall(r"[0-9a-z]+", template.lower())) / threshold - 1e-9)


def _n_words(words: Column) -> Column:
    """Size of a split at gaps, without an empty first or last piece."""
    empty = lambda at: (F.element_at(words, at) == "").cast("int")
    return F.size(words) - empty(1) - F.when(F.size(words) > 1, empty(-1)).otherwise(0)


def _places(text: Column) -> Column:
    """n, labels, first and last word of the base places; only of texts that have any."""
    found = F.regexp_extract_all(text, F.lit(PLACE), F.lit(0))
    phrase = F.transform(found, lambda m: F.lower(F.regexp_replace(m, f"{_GAP}+", " ")))
    label = F.create_map(*[F.lit(x) for pair in PHRASES.items() for x in pair])
    size = F.create_map(*[F.lit(x) for p in PHRASES for x in (p, len(p.split()))])
    pieces = F.split(text, PLACE, -1)
    before = F.regexp_count(F.element_at(pieces, 1), F.lit(_WORD))
    behind = F.regexp_count(F.element_at(pieces, -1), F.lit(_WORD)) + size[F.element_at(phrase, -1)]
    return F.struct(F.size(found).alias("n"), F.array_distinct(F.transform(phrase, lambda p: label[p])).alias("labels"), before.alias("first"), behind.alias("behind"))


def read(docs: DataFrame, vocabulary: list[str], least: int, text: str = "text", id: str = "doc_id", placed: Column | None = None) -> DataFrame:
    """One row for each document: words, base places, the template words it holds, and by line where they may be enough; where
    `placed` is true also the place of each template word."""
    body = F.coalesce(F.col(text), F.lit(""))
    known = F.array(*[F.lit(w) for w in vocabulary])
    split = F.transform(F.split(F.lower(body), "\n", -1), lambda line: F.split(line, f"{_GAP}+", -1))
    by_line = F.transform(split, lambda w: F.struct(_n_words(w).alias("n"), F.array_intersect(w, known).alias("held")))
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id).cast("long").alias("id"),
        by_line.alias("by_line"),
        F.when(body.rlike(PLACE), _places(body)).alias("base"),
        *([] if placed is None else [body.alias("body")]),
    )
    held = F.transform("by_line", lambda x: x["held"])
    rows = rows.select("uid", "id", "base", *rows.columns[4:], F.aggregate("by_line", F.lit(0).cast("long"), lambda total, x: total + x["n"]).alias("n_words"), held.alias("lines"))
    rows = rows.withColumn("held", F.array_distinct(F.flatten("lines")))
    if placed is not None:
        words = F.transform(F.split(F.lower("body"), f"{_GAP}+", -1), lambda w, at: F.when(F.array_contains(known, w), F.struct(at.alias("at"), w.alias("word"))))
        rows = rows.withColumn("spots", F.when(placed, F.filter(words, lambda x: x.isNotNull()))).drop("body")
    # A document that holds too few template words has no block that holds more.
    return rows.withColumn("lines", F.when(F.size("held") >= least, F.col("lines")))


def _in_runs(rows: DataFrame, heads: DataFrame, rank_of: Column, wanted: Column) -> DataFrame:
    """(uid, template, size, shared) of the templates of which a run of words holds enough; `wanted`: what `scan` has of each."""
    ordered = rows.where("spots IS NOT NULL").select("uid", F.array_sort(F.transform("held", lambda w: rank_of[w])).alias("block"))
    met = ordered.select("uid", "block", F.posexplode("block").alias("place", "rank")).join(F.broadcast(heads), "rank")
    met = met.where("size(block) - place >= need").withColumn("shared", F.size(F.array_intersect("block", "ranks"))).where("shared >= need")
    # A document has as many rows here as there are templates at most.
    met = met.groupBy("uid", "template").agg(F.collect_set("rank").alias("anchors"))
    pairs = rows.select("uid", "spots").join(met, "uid").select("uid", "spots", "anchors", F.element_at(wanted, F.col("template") + 1).alias("t"))
    pairs = pairs.select("uid", "t", "anchors", F.filter("spots", lambda x: F.array_contains(F.col("t.words"), x["word"])).alias("own"))
    near = F.transform(F.filter("own", lambda x: F.array_contains("anchors", rank_of[x["word"]])), lambda x: x["at"])
    pairs = pairs.withColumn("near", near)

    def held(x: Column, k: Column) -> Column:
        run = F.filter(F.slice("own", k + 1, F.col("t.run")), lambda y: y["at"] < x["at"] + F.col("t.run"))
        around = F.exists("near", lambda at: (at >= x["at"]) & (at < x["at"] + F.col("t.run")))
        return F.when(around, F.size(F.array_distinct(F.transform(run, lambda y: y["word"])))).otherwise(0)

    best = pairs.select("uid", "t.template", F.size("t.words").alias("size"), "t.need", F.array_max(F.transform("own", held)).alias("shared"))
    return best.where("shared >= need").drop("need")


def scan(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, span: int = SPAN, text: str = "text", id: str = "doc_id", runs: bool = False
) -> DataFrame:
    """One row for each document: `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels`, `score` (the largest
    share of a template that a block holds, 1 at a base place, 0 below the threshold). `runs`: blocks by words as well as lines."""
    spark = docs.sparkSession
    sets = [(label, words_of(t)) for label, t in templates]
    need = [math.ceil(threshold * len(words) - 1e-9) for _, words in sets]
    vocabulary = sorted({w for _, words in sets for w in words})
    parts = [(number, need[number], run_of(t, threshold), F.array(*[F.lit(w) for w in sets[number][1]])) for number, (_, t) in enumerate(templates)]
    wanted = F.array(*[F.struct(F.lit(k).alias("template"), F.lit(n).alias("need"), F.lit(run).alias("run"), words.alias("words")) for k, n, run, words in parts])
    enough = F.exists(wanted, lambda t: F.size(F.array_intersect("held", t["words"])) >= t["need"]) if runs else None
    rows = settle(read(docs, vocabulary, min(need, default=1), text, id, enough), "licenses")

    # As many rows as the templates have words.
    held = {r.word: r.n for r in rows.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    order = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (held.get(w, 0), w)))}
    prefix = [
        (rank, number, len(words), need[number], ranks)
        for number, (_, words) in enumerate(sets)
        for ranks in [sorted(order[w] for w in words)]
        for rank in ranks[: len(words) - need[number] + 1]
    ]
    heads = spark.createDataFrame(prefix, "rank int, template int, size int, need int, ranks array<int>")
    rank_of = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, order[w])])
    blocks = rows.where("lines IS NOT NULL").select("uid", "lines", F.posexplode("lines").alias("line", "own"))
    # A block is looked at where its first line adds a word.
    blocks = blocks.where(F.size("own") > 0).select("uid", "line", F.array_distinct(F.flatten(F.slice("lines", F.col("line") + 1, F.lit(span)))).alias("words"))
    blocks = blocks.select("uid", "line", F.array_sort(F.transform("words", lambda w: rank_of[w])).alias("block"))
    met = blocks.select("uid", "line", "block", F.posexplode("block").alias("place", "rank")).join(F.broadcast(heads), "rank")
    met = met.where("size(block) >= need AND size(block) - place >= need").withColumn("shared", F.size(F.array_intersect("block", "ranks"))).where("shared >= need")
    met = met.select("uid", "template", "size", "shared")
    if runs:
        met = met.unionByName(_in_runs(rows, heads, rank_of, wanted))
    label_of = F.array(*[F.lit(label) for label, _ in sets])
    found = met.groupBy("uid").agg(F.collect_set(F.element_at(label_of, F.col("template") + 1)).alias("more"), F.max(F.col("shared") / F.col("size")).alias("best"))

    out = rows.join(found, "uid", "left")
    none = F.array().cast("array<string>")
    base_labels, more = F.coalesce("base.labels", none), F.coalesce("more", none)
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return out.select(
        F.col("id").alias(id),
        "n_words",
        F.coalesce("base.n", F.lit(0)).cast("long").alias("n_base"),
        F.col("base.first").cast("long").alias("first_word"),
        (F.col("n_words") - F.col("base.behind")).alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, more)).alias("labels"),
        F.when(F.col("base").isNotNull(), 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )

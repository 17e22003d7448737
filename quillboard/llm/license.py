"""License scans: phrases at word places, and an exact containment join with templates.

Everything is a DataFrame expression. A text block is a line; a block is labelled with
every template of which it holds at least the threshold share of the words, and among them
those that tell the template apart: all of a short one, the license's name of a long one.
The words are ordered by how often they occur in the whole corpus, rarest first, and three filters
cut the candidates: the prefixes must meet, the block must be long enough, and the places
of the meeting word must leave room for the overlap that is needed.

A notice that is wrapped over lines is found in its paragraph, a run of lines without an
empty one: a short template as consecutive words, as its words in any order may be chance
where lines meet; a long one in windows of as many words as it has.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

#: Phrases whose words must stand consecutively, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices as they stand in public license texts, and their labels.
TEMPLATES = [
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
]
THRESHOLD = 0.85

#: Templates of fewer distinct words than this must be held whole, and words that name a license must be held by any block that its template labels.
WHOLE_BELOW = 12
NAMES = {"gnu", "apache", "mit", "cc", "nc", "sa", "creative", "commons", "attribution", "mozilla"}
EMPTY_LINES = "\\n\\s*\\n"
OTHERS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _telling(words: list[str]) -> list[str]:
    """The words of a template that tell it apart from others: a block without one of them is not its notice."""
    return words if len(words) < WHOLE_BELOW else [w for w in words if w in NAMES]


def _words(text: Column) -> Column:
    """Lower-cased words with single spaces between; the fold is F.lower, which maps no word onto or off the phrases' letters."""
    return F.trim(F.regexp_replace(F.lower(text), OTHERS, " "))


def with_rows(documents: DataFrame) -> DataFrame:
    """row and text: what tells a row from others, its doc_id and a hash of its text."""
    return documents.select(F.struct(documents["doc_id"].cast("long").alias("doc_id"), F.xxhash64(documents["text"]).alias("text")).alias("row"), documents["text"].alias("text"))


def _blocks(documents: DataFrame, vocabulary: list[str]) -> DataFrame:
    """row, block, words: each line's distinct words that some template has."""
    lines = documents.select("row", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("block", "line"))
    return lines.select("row", "block", F.array_intersect(F.split(_words(F.col("line")), " "), F.array(*map(F.lit, vocabulary))).alias("words"))


def template_matches(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """row, block, template, label, containment, told: the exact containment join of lines with templates.

    told: the block holds the words that tell the template apart. The only rows that the driver sees are the counts of the templates' own words.
    """
    spark = documents.sparkSession
    sets = [(k, label, sorted(set(text.split()))) for k, (label, text) in enumerate(templates)]
    vocabulary = sorted({w for _, _, ws in sets for w in ws})
    blocks = _blocks(documents, vocabulary)
    counts = dict(blocks.select(F.explode("words").alias("w")).groupBy("w").count().collect())
    order = {w: r for r, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    need = {k: math.ceil(threshold * len(ws) - 1e-9) for k, _, ws in sets}
    least = min(need.values())
    prefixes = []
    for k, label, ws in sets:
        ranks = sorted(order[w] for w in ws)
        told = [order[w] for w in _telling(ws)]
        prefixes += [(r, k, label, j, len(ranks), need[k], ranks, told) for j, r in enumerate(ranks[: len(ranks) - need[k] + 1])]
    table = spark.createDataFrame(prefixes, "rank int, template int, label string, t_at int, t_size int, need int, t_ranks array<int>, t_told array<int>")
    rank_of = F.create_map(*[F.lit(x) for w, r in order.items() for x in (w, r)])
    ranked = blocks.where(F.size("words") >= least).select("row", "block", F.array_sort(F.transform("words", lambda w: rank_of[w])).alias("ranks"))
    starts = ranked.select("row", "block", "ranks", F.posexplode(F.slice("ranks", F.lit(1), F.size("ranks") - (least - 1))).alias("b_at", "rank"))
    size = F.size("ranks")
    room = F.least(size - F.col("b_at"), F.col("t_size") - F.col("t_at"))
    candidates = starts.join(F.broadcast(table), "rank").where((size >= F.col("need")) & (F.col("b_at") <= size - F.col("need")) & (room >= F.col("need")))
    shared = F.size(F.array_intersect("ranks", "t_ranks"))
    # A pair meets at most once for each word of a template's prefix: its first meeting stands for it.
    first = F.col("rank") == F.element_at(F.array_intersect("ranks", "t_ranks"), 1)
    return candidates.where(first & (shared >= F.col("need"))).select("row", "block", "template", "label", (shared / F.col("t_size")).alias("containment"), (F.size(F.array_except("t_told", "ranks")) == 0).alias("told"))


def _best_window(words: Column, own_words: list[str], told: list[str], length: int, need: int) -> Column:
    """Greatest share of a template's words in `length` words on end that hold enough of them; null where none do."""
    own, names = F.array(*map(F.lit, own_words)), F.array(*map(F.lit, told)).cast("array<string>")

    def held(i: Column) -> Column:
        shared = F.array_intersect(F.slice(words, i + 1, F.lit(length)), own)
        return F.when(F.size(F.array_except(names, shared)) == 0, F.size(shared)).otherwise(0)

    starts = F.filter(F.transform(words, lambda x, i: F.when(F.array_contains(own, x), i)), lambda i: i.isNotNull())
    most = F.when(F.size(F.array_intersect(words, own)) >= need, F.array_max(F.transform(starts, held)))
    return F.when(most >= need, most / len(own_words))


def wrapped_matches(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """row, label, containment: notices in paragraphs of several lines, line ends being spaces.

    A window starts at a word of the template. Texts go first that lack a template's telling
    words, or all of so many of its words that too few would be left; paragraphs next that
    do not hold enough of its words in all.
    """
    lowered = documents.where(F.col("text").contains("\n")).select("row", F.lower("text").alias("low"))
    found, may = [], F.lit(False)
    for label, template in templates:
        ws = sorted(set(template.split()), key=lambda w: (-len(w), w))
        need, told = math.ceil(threshold * len(ws) - 1e-9), _telling(ws)
        here = F.lit(True)
        for w in told:
            here = here & F.col("low").contains(w)
        if not told:
            here = F.lit(False)
            for w in ws[: len(ws) - need + 1]:
                here = here | F.col("low").contains(w)
        may = may | here
        if len(ws) < WHOLE_BELOW:
            share = F.when(F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).contains(f" {template} "), 1.0)
        else:
            share = _best_window(F.col("w"), ws, told, len(template.split()), need)
        found.append(F.when(share.isNotNull(), F.struct(F.lit(label).alias("label"), share.cast("double").alias("containment"))))
    paragraphs = lowered.where(may).select("row", F.explode(F.split("low", EMPTY_LINES)).alias("paragraph")).where(F.trim(F.col("paragraph")).contains("\n"))
    # the outer form keeps the split from being repeated for each template
    words = paragraphs.select("row", F.explode_outer(F.array(F.split(_words(F.col("paragraph")), " "))).alias("w"))
    return words.select("row", F.explode(F.array_compact(F.array(*found))).alias("m")).select("row", "m.label", "m.containment")


def license_scan(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: phrase places, labels and a score.

    score is 1 where a phrase stands, else the greatest containment found, else 0. A null
    text is empty: no words, no places (first_word and last_word null), labels ''. Rows
    that share a doc_id, null included, are labelled by their own texts: matches find
    their row by doc_id and the text's hash. Further columns are left out.
    """
    docs = with_rows(documents)
    plain = docs.select("row", _words(F.coalesce("text", F.lit(""))).alias("plain"))
    padded = F.concat(F.lit(" "), "plain", F.lit(" "))

    def places(phrase: str, label: str) -> Column:
        ws = phrase.split()
        at = lambda i: F.forall(F.array(*[F.get("w", i + k) == w for k, w in enumerate(ws)]), lambda x: x)
        found = F.filter(F.sequence(F.lit(0), F.size("w") - len(ws)), at)
        return F.when(F.size("w") >= len(ws), F.transform(found, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))).otherwise(F.array().cast("array<struct<at: bigint, label: string>>"))

    any_phrase = F.lit(False)
    for phrase in PHRASES:
        any_phrase = any_phrase | padded.contains(f" {phrase} ")
    based = plain.select(
        "row",
        F.when(F.col("plain") == "", 0).otherwise(F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"),
        F.when(any_phrase, F.split("plain", " ")).otherwise(F.array().cast("array<string>")).alias("w"),
    )
    spotted = based.select("row", "n_words", F.concat(*[places(p, label) for p, label in PHRASES.items()]).alias("spots"))
    base = spotted.select(
        "row",
        "n_words",
        F.size("spots").cast("long").alias("n_base"),
        F.array_min("spots.at").alias("first_word"),
        F.array_max("spots.at").alias("last_word"),
        F.array_sort(F.array_distinct("spots.label")).alias("base_set"),
    )
    matches = template_matches(docs, templates, threshold).where("told").select("row", "label", "containment").unionAll(wrapped_matches(docs, templates, threshold))
    found = matches.groupBy("row").agg(F.collect_set("label").alias("m_labels"), F.max("containment").alias("m_score"))
    both = base.join(found, "row", "left")
    return both.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_set", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_set", F.coalesce("m_labels", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("m_score", F.lit(0.0))).alias("score"),
    )

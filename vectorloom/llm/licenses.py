"""License scans: phrases, and an exact set-similarity join with templates, in DataFrame functions only.

A text block is a run of SPAN consecutive words, beginning at any word, whatever lines
they stand in. A text carries a template's label if one of its blocks holds at least
PERCENT of the template's distinct words, in any order. The join is exact: words are
ordered by their frequency over all texts, rarest first; a block that reaches the
threshold has one of the first m - need + 1 of a template's m words (prefix filter), so
blocks are looked for around those only. Around such a word there must be `need` words
of the template at all (length filter), and as many of those that come no earlier in
the order (positional filter). What passes is counted block by block.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import narrow, written

#: Phrases, as words, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Public wording of license texts, and their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced or transmitted in any form without prior written permission"),
)
PERCENT, SPAN = 80, 32
#: Between words: ASCII other than digits and letters (of either case here; letters are folded where they are compared).
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def template_words(wording: str) -> list[str]:
    return sorted({w for w in re.split(BETWEEN, wording.lower()) if w})


def needed(m: int, percent: int) -> int:
    """The least overlap with 100 * overlap >= percent * m."""
    return -(-percent * m // 100)


def phrases(texts: DataFrame, *others: str) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base (array of labels), other columns from (doc_id, text).

    Words are joined by one space, with one at both ends; a place of a phrase begins after
    the space that ends what is before it.
    """
    joined = F.concat(F.lit(" "), F.trim(F.regexp_replace("text", BETWEEN, " ")), F.lit(" "))
    either = "|".join(PHRASES)
    spaces = lambda x: (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))).cast("long")
    cut = texts.select("doc_id", *others, joined.alias("joined")).select("doc_id", *others, "joined", F.split("joined", f" (?=(?i:{either}) )", -1).alias("parts"))
    n_words = F.when(F.col("joined") == "  ", F.lit(0).cast("long")).otherwise(spaces(F.col("joined")) - 1)
    some = F.size("parts") > 1
    return cut.select(
        "doc_id",
        *others,
        n_words.alias("n_words"),
        (F.size("parts") - 1).cast("long").alias("n_base"),
        F.when(some, spaces(F.element_at("parts", 1))).alias("first_word"),
        F.when(some, n_words - spaces(F.element_at("parts", -1))).alias("last_word"),
        F.array_compact(F.array(*(F.when(some & F.col("joined").rlike(f"(?i) {p} "), F.lit(label)) for p, label in PHRASES.items()))).alias("base"),
    )


def template_places(text: Column, vocabulary: list[str]) -> Column:
    """at, word of each place of a text that has one of the words, in order."""
    # the Kelvin sign is the one other character whose lower case is an ASCII letter
    words = F.split(F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u03ba"))), BETWEEN)
    return F.filter(F.transform(words, lambda word, at: F.struct(at.alias("at"), word.alias("word"))), lambda x: x["word"].isin(vocabulary))


def matches(hits: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """row, label, containment of (row, hits: template_places()), of what meets the threshold; one row for each place of a prefix word."""
    sets = [(label, template_words(wording)) for label, wording in templates]
    # one count a template word
    counts = dict(hits.select(F.explode("hits.word").alias("word")).groupBy("word").count().collect())
    rows = []
    for label, words in sets:
        own, need = sorted(words, key=lambda w: (counts.get(w, 0), w)), needed(len(words), percent)
        rows += [(w, label, own, own[i:], len(own), need) for i, w in enumerate(own[: len(own) - need + 1])]
    prefix = F.broadcast(hits.sparkSession.createDataFrame(rows, "word string, label string, own array<string>, rest array<string>, m int, need int"))  # fixed by the templates
    rare = sorted({r[0] for r in rows})
    # hits have different places: those of a block with one of them are among its SPAN - 1 neighbours on each side
    around = lambda i: F.slice("hits", F.greatest(i + 2 - SPAN, F.lit(1)), 2 * SPAN - 1)
    near = lambda hit, i: F.filter(around(i), lambda x: F.abs(x["at"] - hit["at"]) < SPAN)
    spots = F.transform("hits", lambda hit, i: F.when(hit["word"].isin(rare), F.struct(hit["word"].alias("word"), near(hit, i).alias("near"))))
    joined = hits.select("row", F.explode(F.filter(spots, lambda x: x.isNotNull())).alias("spot")).select("row", "spot.word", "spot.near").join(prefix, "word")
    reach = lambda words: F.size(F.array_intersect(words, F.col("near.word"))) >= F.col("need")
    joined = joined.filter(reach("own")).filter(reach("rest")).withColumn("near", F.filter("near", lambda x: F.array_contains("own", x["word"])))
    block = lambda first: F.filter("near", lambda x: (x["at"] >= first["at"]) & (x["at"] < first["at"] + SPAN))
    most = F.array_max(F.transform("near", lambda first: F.size(F.array_distinct(F.transform(block(first), lambda x: x["word"])))))
    return joined.select("row", "label", "m", "need", most.alias("most")).filter("most >= need").select("row", "label", (F.col("most") / F.col("m")).alias("containment"))


def scan(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document.

    Null texts are empty; where nothing is found labels are '' and the score 0. The score
    is the highest containment, 1 where a phrase stands. Each row is judged by itself,
    also where ids are null or repeated. Texts are read once; what later steps need of
    them is kept in a narrow table.
    """
    vocabulary = sorted({w for _, wording in templates for w in template_words(wording)})
    texts = narrow(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    kept = written(phrases(texts.withColumn("hits", template_places(F.col("text"), vocabulary)), "hits").withColumn("row", F.monotonically_increasing_id()))
    found = matches(kept.select("row", "hits"), templates, percent).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("containment"))
    joined = kept.drop("hits").join(found, "row", "left")
    both = F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(both)), ",").alias("labels"),
        F.greatest(F.coalesce("containment", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)).alias("score"),
    )

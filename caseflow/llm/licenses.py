"""License scans: notices found by an exact set-similarity join. DataFrame functions only.

Text blocks are lines; a block's set holds its distinct words. A block matches a template if it contains at least
``percent`` / 100 of the template's distinct words. The join works with words in one global order, by how many blocks hold
them, rarest first:

- prefix filter: a block that holds ``need`` of a template's words must hold one of its first size - need + 1 words;
- length filter: it must hold at least ``need`` words of the templates at all;
- positional filter: where the common word stands in both ordered sets bounds how many more they can share.

What is left is verified on the sets. Words that no template has are not kept, as they cannot match. Templates are fixed,
so what is broadcast is a few dozen rows. All blocks of all documents are counted and joined.

Besides, ``scan`` counts the places of three phrases word by word. Defined results: a null text is empty; empty texts
have no words, no places and no labels. Equal rows have equal results. Columns of the documents that the scan does not
name are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.llm.tables import materialize, text_key

#: Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: The words of common license notices, by license.
TEMPLATES = [
    ("MIT", "released under the mit license"),
    ("MIT", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "licensed under the apache license version 2 0"),
    ("GPL-3.0", "this work is licensed under the gnu general public license version 3"),
    ("GPL-3.0", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("CC-BY-NC-4.0", "licensed under cc by nc 4 0"),
    ("CC-BY-4.0", "licensed under the creative commons attribution 4 0 international license"),
    ("BSD", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("MPL-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("ISC", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "this is free and unencumbered software released into the public domain"),
]

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PERCENT = 80


def _list(values: list[str]) -> Column:
    return F.split(F.lit(" ".join(values)), " ")


def blocks(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``doc_id, key, block, words``: the lines that hold words of the vocabulary, and which."""
    lines = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.posexplode(F.split("text", "\n")).alias("block", "line"))
    found = F.array_intersect(F.split(F.lower("line"), BETWEEN), _list(vocabulary))
    return lines.select("doc_id", "key", "block", found.alias("words")).where(F.size("words") > 0)


def matches(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """``doc_id, key, block, label, containment``: every block and template that reach the threshold."""
    sets = [(label, sorted(set(words.split()))) for label, words in templates]
    held = materialize(blocks(docs, sorted({w for _, words in sets for w in words})), "blocks")
    counts = {r["word"]: r["n"] for r in held.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    order = sorted({w for _, words in sets for w in words}, key=lambda w: (counts.get(w, 0), w))
    place = {w: k for k, w in enumerate(order)}
    entries = []
    for number, (label, words) in enumerate(sets):
        ranks = sorted(place[w] for w in words)
        need = math.ceil(percent * len(ranks) / 100)
        entries += [(ranks[p], p, number, label, need, ranks) for p in range(len(ranks) - need + 1)]
    prefixes = docs.sparkSession.createDataFrame(entries, "rank int, p int, template int, label string, need int, ranks array<int>")
    ranked = held.withColumn("ranks_b", F.array_sort(F.transform("words", lambda w: F.array_position(_list(order), w).cast("int") - 1)))
    heads = F.split(F.lit(" ".join(str(r) for r in sorted({e[0] for e in entries}))), " ").cast("array<int>")
    pairs = ranked.withColumn("rank", F.explode(F.array_intersect("ranks_b", heads))).join(F.broadcast(prefixes), "rank")
    q = F.array_position("ranks_b", F.col("rank")) - 1
    most = F.least("p", q) + 1 + F.least(F.size("ranks") - F.col("p") - 1, F.size("ranks_b") - q - 1)
    near = pairs.where(F.size("ranks_b") >= F.col("need")).where(most >= F.col("need"))
    shared = F.size(F.array_intersect("ranks_b", "ranks"))
    found = near.withColumn("shared", shared).where("shared >= need")
    found = found.select("doc_id", "key", "block", "template", "label", (F.col("shared") / F.size("ranks")).alias("containment"))
    return found.distinct().drop("template")


def scan(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for each document row.

    ``score`` is 1 with a phrase, else the largest containment found, or 0.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = F.filter(F.split(F.translate("text", UPPER, LOWER), BETWEEN), lambda w: w != "")
    likely = F.col("text").rlike("(?i)license")
    based = rows.select(
        "doc_id", text_key(F.col("text")).alias("key"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        F.when(likely, words).otherwise(F.array().cast("array<string>")).alias("words"),
    )

    def places(phrase: str) -> Column:
        parts = phrase.split()
        steps = F.when(F.size("words") >= len(parts), F.sequence(F.lit(0), F.size("words") - len(parts)))

        def here(i: Column) -> Column:
            result = F.lit(True)
            for k, part in enumerate(parts):
                result = result & (F.get("words", i + k) == part)
            return result

        return F.coalesce(F.filter(steps, here), F.array().cast("array<int>"))

    for n, phrase in enumerate(PHRASES):
        based = based.withColumn(f"p{n}", places(phrase))
    every = F.concat(*[F.col(f"p{n}") for n in range(len(PHRASES))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{n}") > 0, F.lit(x)) for n, x in enumerate(PHRASES.values())]))
    based = based.select(
        "doc_id", "key", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"), labels.alias("own"),
    )
    found = matches(rows, **options).groupBy("doc_id", "key").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    found = materialize(found, "licenses").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "more", "best")
    both = based.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    more = F.coalesce("more", F.array().cast("array<string>"))
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("own"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own", more)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )

"""License scan by diagonal voting, in built-in functions only.

Every rolling word k-gram of every document is hashed and joined with the places
of the same k-gram in license templates. A copied passage keeps its words in
order, so its hits share one difference *place in text - place in template*, a
diagonal. Hits vote for diagonals; diagonals a few words apart (a name put in, a
word left out) are merged to one span, cut at a distance from its strongest diagonal; a
span that covers enough of the template is a match, unless one of another license
over the same place covers more of its own. Short phrases are also found exactly
(the base labels).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedmill.llm.common import ascii_lower, bind

GRAM = 4
#: Diagonals at most this far apart belong to one span.
DRIFT = 4
#: Share of a template's k-grams that a span must hold.
COVER = 0.5

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening notices of widely used licenses.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
]


def plain(text: Column) -> Column:
    """Words in lower case with one space between them; empty if there are none."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def word_list(line: Column) -> Column:
    return F.when(line == "", F.array().cast("array<string>")).otherwise(F.split(line, " "))


def gram_hashes(words: Column) -> Column:
    """Hashes of all k-grams in order; none if the text has fewer words."""

    def rolling(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(h) - (GRAM - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, GRAM)))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= GRAM, bind(hashed, rolling)).otherwise(none)


def template_grams(spark: SparkSession) -> DataFrame:
    """``gram, template, label, at, of``: as many rows as the templates above have k-grams."""
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("template"), F.lit(name).alias("label"), F.lit(text).alias("text")) for i, (name, text) in enumerate(TEMPLATES)]))
    texts = spark.range(1).select(rows.alias("t")).select("t.*")
    grams = texts.select("template", "label", gram_hashes(word_list(plain(F.col("text")))).alias("grams"))
    return grams.select("template", "label", F.size("grams").alias("of"), F.posexplode("grams").alias("at", "gram"))


def _places(words: Column, parts: list[str], label: str) -> Column:
    def here(i: Column) -> Column:
        same = F.get(words, i) == parts[0]
        for k, word in enumerate(parts[1:], 1):
            same = same & F.coalesce(F.get(words, i + k) == word, F.lit(False))
        return same

    starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
    return F.transform(starts, lambda i: F.struct(i.cast("bigint").alias("at"), F.lit(label).alias("label")))


def _base(line: Column, words: Column) -> Column:
    """Places of the phrases, as an array of (at, label); looked for only where a phrase occurs at all."""
    padded = F.concat(F.lit(" "), line, F.lit(" "))
    found, some = [], F.lit(False)
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        some = some | F.contains(padded, F.lit(f" {phrase} "))

        found.append(_places(words, parts, label))
    none = F.array().cast("array<struct<at:bigint,label:string>>")
    return F.when(some, F.concat(*found)).otherwise(none)


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """Rows under a key made of id and text, so that rows that repeat an id stay apart unless they are equal."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col("doc_id"), body.alias("text"), F.xxhash64(body).alias("digest"))


def matches(docs: DataFrame, text: str = "text") -> DataFrame:
    """Verified spans: ``doc_id, digest, label, template, first_word, last_word, n_words, cover``."""
    rows = _keyed(docs, text)
    grams = rows.select("doc_id", "digest", F.posexplode(gram_hashes(word_list(plain(F.col("text"))))).alias("pos", "gram"))
    hits = grams.join(F.broadcast(template_grams(docs.sparkSession)), "gram")
    diagonals = hits.groupBy("doc_id", "digest", "template", "label", "of", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("ats"), F.min("pos").alias("low"), F.max("pos").alias("high")
    )
    chain = ("doc_id", "digest", "template")
    along = Window.partitionBy(*chain).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > DRIFT, F.lit(True))
    spans = diagonals.withColumn("span", F.sum(apart.cast("int")).over(along))
    # A chain reaches no farther than half a template from its strongest diagonal, the first one of equals.
    strongest = F.max(F.struct(F.size("ats"), -F.col("diagonal"))).over(Window.partitionBy(*chain, "span"))
    centred = spans.withColumn("centre", -strongest["col2"])
    merged = centred.where(2 * F.abs(F.col("diagonal") - F.col("centre")) <= F.col("of") + GRAM).groupBy(*chain, "label", "of", "span").agg(
        F.array_distinct(F.flatten(F.collect_list("ats"))).alias("held"),
        F.min("low").alias("first_word"),
        (F.max("high") + (GRAM - 1)).alias("last_word"),
    )
    # The words of the template that stand in its k-grams found: those of the span, compared one by one.
    words = F.size(F.array_distinct(F.flatten(F.transform("held", lambda at: F.sequence(at, at + (GRAM - 1))))))
    cover = F.col("n_held") / F.col("of")
    found = merged.withColumn("n_held", F.size("held")).withColumn("n_words", words).where(cover >= COVER)
    return _best(found.select("doc_id", "digest", "label", "template", "first_word", "last_word", "n_words", cover.alias("cover")))


def _best(found: DataFrame) -> DataFrame:
    """Of spans of different labels over one place, that which holds the larger share of its template, or more words."""
    columns = ["label", "template", "first_word", "last_word", "n_words", "cover"]
    every = found.groupBy("doc_id", "digest").agg(F.collect_list(F.struct(*columns)).alias("spans"))

    def beaten(s: Column) -> Column:
        def by(t: Column) -> Column:
            over = (t["first_word"] <= s["last_word"]) & (s["first_word"] <= t["last_word"])
            more = (t["cover"] > s["cover"]) | ((t["cover"] == s["cover"]) & (t["n_words"] > s["n_words"]))
            return over & (t["label"] != s["label"]) & more

        return F.exists("spans", by)

    kept = every.select("doc_id", "digest", F.explode(F.filter("spans", lambda s: ~beaten(s))).alias("s"))
    return kept.select("doc_id", "digest", "s.*")


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per input row: word count, base places and labels, all labels, score.

    Null and empty texts have no words and no labels (empty strings, score 0).
    Rows with a null id are kept and matched null-safely; rows equal in id and
    text get equal results. Only ``doc_id`` and the text column are read, so
    other columns cannot clash. The score is 1 where a base phrase stands, else
    the best span's share of its template.
    """
    rows = _keyed(docs, text)

    def measured(line: Column) -> Column:
        return bind(
            word_list(line),
            lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), _base(line, w).alias("base")),
        )

    base = rows.select("doc_id", "digest", bind(plain(F.col("text")), measured).alias("m")).select(
        "doc_id",
        "digest",
        F.col("m.n_words").alias("n_words"),
        F.size("m.base").cast("bigint").alias("n_base"),
        F.array_min("m.base")["at"].alias("first_word"),
        F.array_max("m.base")["at"].alias("last_word"),
        F.array_sort(F.array_distinct(F.col("m.base.label"))).alias("named"),
    )
    best = matches(docs, text).groupBy("doc_id", "digest").agg(
        F.collect_set("label").alias("spotted"), F.max("cover").alias("cover")
    )
    best = best.select(F.col("doc_id").alias("m_id"), F.col("digest").alias("m_digest"), "spotted", "cover")
    joined = base.join(best, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("digest") == F.col("m_digest")), "left")
    none = F.array().cast("array<string>")
    every = F.array_sort(F.array_distinct(F.concat("named", F.coalesce("spotted", none))))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("named", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )

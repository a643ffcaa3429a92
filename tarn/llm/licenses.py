"""License scans by an exact set-similarity join of text blocks with license templates, in DataFrame operations only.

Words are runs of ASCII letters (lower-cased), digits and other than ASCII. Base labels are where the words of a phrase of
PHRASES stand consecutively. Labels of the method: a block (a line, and a paragraph between blank lines) gets a template's
label if it holds at least CONTAINMENT of the template's distinct words.

The join: template words are ordered by their frequency in all documents, rarest first. A block that holds `need` of a
template's n words holds one of its n - need + 1 rarest, so only lines and documents with such a word (the prefix filter)
are taken further. There a block is the sorted places that its words have in the order; it is kept if these are enough (length
filter), joined with templates on prefix words, and kept if what comes from the match on, in the template and in the block,
can make up `need` (positional filter: the first word that both have is in the prefix); the rest is verified by intersection.
Templates are constants of this module, a few kilobytes, so their index is broadcast.

Cases: a null text counts as empty: no words, no labels, score 0; repeated rows each get a row; an empty table gives no
rows; other columns are ignored. score is 1 with a base place, else the highest containment found, else 0.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# What licences and their notices say, in public texts of theirs.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
CONTAINMENT = 0.8
#: What lies between words, upper-case letters counting as words here.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PHRASE = f"(?i) ({'|'.join(PHRASES)})(?= )"


def word_set(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))))


TEMPLATE_WORDS = [word_set(t) for _, t in TEMPLATES]


def spaced(text: Column) -> Column:
    """Words with a space before and after each; case as it was."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, BETWEEN, " ")), F.lit(" "))


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def base(keyed: DataFrame) -> DataFrame:
    """n_words and the places of phrases of each row."""
    text = F.coalesce("text", F.lit(""))
    rows = keyed.select("doc_id", "text_hash", spaced(text).alias("s"))
    found = F.regexp_count("s", F.lit(_PHRASE))
    rows = rows.select("doc_id", "text_hash", F.when(F.length("s") > 2, _spaces(F.col("s")) - 1).otherwise(0).cast("long").alias("n_words"), found.cast("long").alias("n_base"), F.when(found > 0, F.col("s")).alias("s"))
    first = _spaces(F.substring(F.col("s"), F.lit(1), F.regexp_instr("s", F.lit(_PHRASE)))) - 1
    last = _spaces(F.regexp_extract("s", f"(?s)^(.*){_PHRASE}", 1))
    labels = F.array_compact(F.array(*(F.when(F.col("s").rlike(f"(?i) {p}(?= )"), F.lit(label)) for p, label in PHRASES.items())))
    return rows.select("doc_id", "text_hash", "n_words", "n_base", first.cast("long").alias("first_word"), last.cast("long").alias("last_word"), F.coalesce(labels, F.array().cast("array<string>")).alias("base_labels"))


def frequencies(keyed: DataFrame) -> dict[str, int]:
    """How often each template word stands in all documents; what is collected is a number for each of those words."""
    every = sorted({w for words in TEMPLATE_WORDS for w in words})
    rows = keyed.select(F.explode(F.split(_lower(spaced(F.coalesce("text", F.lit("")))), " ")).alias("word")).where(F.col("word").isin(every))
    return dict.fromkeys(every, 0) | {r.word: r["count"] for r in rows.groupBy("word").count().collect()}


def template_index(counts: dict[str, int], containment: float = CONTAINMENT) -> tuple[list[str], list]:
    """The words of all templates, rarest first, and for each template and each word of its prefix: (place of the word among
    all, template, label, place of the word in the template, the template's places, need)."""
    order = sorted({w for words in TEMPLATE_WORDS for w in words}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order, 1)}
    prefixes = []
    for k, ((label, _), words) in enumerate(zip(TEMPLATES, TEMPLATE_WORDS, strict=True)):
        of = sorted(rank[w] for w in words)
        need = math.ceil(containment * len(of) - 1e-9)
        prefixes += [(r, k, label, i, of, need) for i, r in enumerate(of[: len(of) - need + 1])]
    return order, prefixes


def similar(keyed: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, text_hash, label, share) of templates that a block of the row meets."""
    spark = keyed.sparkSession
    order, prefixes = template_index(frequencies(keyed), containment)
    rare = F.array(*(F.lit(order[r - 1]) for r in sorted({x[0] for x in prefixes})))
    vocabulary = F.array(*(F.lit(w) for w in order))
    words = lambda c: F.split(_lower(spaced(c)), " ")
    candidates = keyed.where(F.arrays_overlap(words(F.col("text")), rare))
    blocks = F.array_distinct(F.concat(F.split("text", "\n"), F.split("text", r"\n[ \t\r]*\n")))
    blocks = candidates.select("doc_id", "text_hash", F.explode(blocks).alias("block")).select("doc_id", "text_hash", F.array_distinct(words(F.col("block"))).alias("words")).where(F.arrays_overlap("words", rare))
    places = F.array_sort(F.filter(F.transform("words", lambda w: F.array_position(vocabulary, w).cast("int")), lambda p: p > 0))
    index = spark.createDataFrame(prefixes, "rank int, template int, label string, place int, of array<int>, need int")
    met = (
        blocks.select("doc_id", "text_hash", places.alias("places"))
        .where(F.size("places") >= min(x[5] for x in prefixes))
        .select("doc_id", "text_hash", "places", F.posexplode("places").alias("at", "rank"))
        .join(F.broadcast(index), "rank")
        .where((F.size("places") >= F.col("need")) & (F.least(F.size("of") - F.col("place"), F.size("places") - F.col("at")) >= F.col("need")))
        .select("doc_id", "text_hash", "label", "need", "of", F.size(F.array_intersect("places", "of")).alias("shared"))
        .where("shared >= need")
    )
    return met.groupBy("doc_id", "text_hash").agg(F.collect_set("label").alias("found"), F.max(F.col("shared") / F.size("of")).alias("share"))


def scan(docs: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_hash", F.xxhash64("text"))
    rows, met = base(keyed), similar(keyed, containment)
    joined = rows.join(met, rows["doc_id"].eqNullSafe(met["doc_id"]) & (rows["text_hash"] == met["text_hash"]), "left")
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.coalesce("found", F.array().cast("array<string>")))))
    return joined.select(
        rows["doc_id"], "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _oracle() -> str:
    """The same by comparing each block with each template."""
    values = ", ".join(f"('{label}', [{', '.join(repr(w) for w in words)}], {math.ceil(CONTAINMENT * len(words) - 1e-9)})" for (label, _), words in zip(TEMPLATES, TEMPLATE_WORDS, strict=True))
    places = "[" + ", ".join(f"['{p}', '{label}']" for p, label in PHRASES.items()) + "]"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH low AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
), w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{word}') AS ws FROM low),
hits AS (
  SELECT r, p[2] AS label, i - 1 AS place
  FROM (SELECT r, ws, unnest({places}) AS p FROM w), LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS i)
  WHERE ws[i] = split_part(p[1], ' ', 1) AND ws[i : i + len(string_split(p[1], ' ')) - 1] = string_split(p[1], ' ')
), b AS (
  SELECT r, count(*) AS n, min(place) AS f, max(place) AS l, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM hits GROUP BY r
), blocks AS (
  SELECT r, list_distinct(regexp_extract_all(x, '{word}')) AS bw
  FROM (SELECT r, unnest(list_concat(string_split(t, chr(10)), regexp_split_to_array(t, '\n[ \t\r]*\n'))) AS x FROM low)
), m AS (
  SELECT r, label, len(list_intersect(bw, ws)) / len(ws) AS share
  FROM blocks, (VALUES {values}) AS templates(label, ws, need) WHERE len(list_intersect(bw, ws)) >= need
), s AS (SELECT r, max(share) AS share FROM m GROUP BY r),
a AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM hits UNION SELECT r, label FROM m) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(f AS BIGINT) AS first_word,
  CAST(l AS BIGINT) AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
  CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM w LEFT JOIN b USING (r) LEFT JOIN s USING (r) LEFT JOIN a USING (r)
"""


ORACLE = _oracle()

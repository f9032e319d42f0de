"""License scans by an exact set-similarity join of text blocks with templates; DataFrame and SQL functions only.

A block is a run of consecutive words of the whole text, about as long as the template (`span`), across line ends. A template is found
where a block holds THRESHOLD or more of its distinct words. Words of templates are ordered by how many documents of the corpus hold them,
rarest first; a block that reaches the threshold must hold one of a template's rarest |T| - c + 1 words (its prefix), so only
where those words stand are blocks looked at. The length filter asks for c words of the template within a block's reach, the position filter
for enough words that come later in the order; then the blocks themselves are counted. All three filters are lossless.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terminus.llm.common import materialize

#: Part of a template's distinct words that a block must hold; words of a block for each of the template's.
THRESHOLD, REACH = 0.9, 1.25
#: Phrases whose words stand consecutively, and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: (label, template); the words of public license notices.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("reserved", "copyright all rights reserved"),
)
BLANKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def needed(template: str, threshold: float = THRESHOLD) -> int:
    """How many of a template's distinct words a block must hold."""
    return math.ceil(threshold * len(set(template.split())) - 1e-9)


def span(template: str) -> int:
    """Words of a block that a template is looked for in."""
    return math.ceil(REACH * len(template.split()))


def _spaces(c: Column) -> Column:
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))


def _phrases(docs: DataFrame) -> DataFrame:
    """doc_id, line (the words, each with a space before and after), n_words, and per phrase k: n_k places, first_k and last_k word."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase).alias("low"))
    own = own.select("doc_id", F.trim(F.regexp_replace("low", BLANKS, " ")).alias("line"))
    own = own.select("doc_id", F.when(F.col("line") == "", F.lit("")).otherwise(F.concat(F.lit(" "), "line", F.lit(" "))).alias("line"))
    own = own.select("doc_id", "line", F.when(F.col("line") == "", F.lit(0)).otherwise(_spaces(F.col("line")) - 1).cast("long").alias("n_words"), *[F.when(F.col("line").contains(f" {p} "), F.replace("line", F.lit(" "), F.lit("  "))).alias(f"on_{k}") for k, (p, _) in enumerate(PHRASES)])
    cols: list[Column] = []
    for k, (p, _) in enumerate(PHRASES):
        on, mark, size = F.col(f"on_{k}"), " " + p.replace(" ", "  ") + " ", len(p.split())
        cols.append(((F.octet_length(on) - F.octet_length(F.replace(on, F.lit(mark), F.lit("")))) / len(mark)).cast("long").alias(f"n_{k}"))
        cols.append(((_spaces(F.substring_index(on, mark, 1)) - 1) / 2).cast("long").alias(f"first_{k}"))
        cols.append((F.col("n_words") - size - (_spaces(F.substring_index(on, mark, -1)) - 1) / 2).cast("long").alias(f"last_{k}"))
    return own.select("doc_id", "line", "n_words", *cols)


def scan(docs: DataFrame, templates: tuple = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Every document with its words, base places and labels, the method's labels and a score.

    score is 1 where a base phrase stands, else the largest part of a template that a block of the document holds, 0 if
    none reaches the threshold. Null texts count as empty: no word, no label, score 0. A repeated row
    is scanned for itself. An empty table gives an empty result; columns besides doc_id and text are not read. To the driver come
    the counts of the templates' words, as many as the templates have; templates are broadcast, and grow only
    with the parameter.
    """
    words = sorted({w for _, t in templates for w in t.split()})
    most = max(map(span, (t for _, t in templates)))
    held = F.split(F.trim("line"), " ")
    hits = F.transform(F.filter(F.sequence(F.lit(0), F.size(held) - 1), lambda i: F.get(F.col("words"), i).isin(words)), lambda i: F.struct(i.alias("at"), F.get(F.col("words"), i).alias("word")))
    own = _phrases(docs).withColumn("words", held).withColumn("hits", hits).drop("line", "words").withColumn("row", F.monotonically_increasing_id())
    own = materialize(own, "words")
    often = {r["word"]: r["n"] for r in own.select(F.explode(F.array_distinct("hits.word")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each word of the templates
    order = sorted(words, key=lambda w: (often.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    rows = []
    for label, t in templates:
        ranked = sorted(set(t.split()), key=place.get)
        c = needed(t, threshold)
        rows += [(label, w, i, len(ranked), c, span(t), ranked, ranked[i + 1 :]) for i, w in enumerate(ranked[: len(ranked) - c + 1])]
    index = F.broadcast(own.sparkSession.createDataFrame(rows, "label string, word string, place int, size int, least int, span int, template array<string>, later array<string>"))
    rare = sorted({r[1] for r in rows})
    # where a rare word stands, with the words of templates around it: at most `most` on either side
    posts = F.transform(F.filter(F.sequence(F.lit(1), F.size("hits")), lambda k: F.get(F.col("hits"), k - 1)["word"].isin(rare)), lambda k: F.struct(F.get(F.col("hits"), k - 1).alias("hit"), F.slice(F.col("hits"), F.greatest(k - most, F.lit(1)), F.least(k - 1, F.lit(most)) + 1 + most).alias("near")))
    posted = own.where((F.size("hits") > 0) & F.exists("hits", lambda h: h["word"].isin(rare))).select("row", F.explode(posts).alias("post")).select("row", F.col("post.hit.word").alias("word"), F.col("post.hit.at").alias("at"), "post.near")
    joined = posted.join(index, "word").withColumn("near", F.filter("near", lambda h: (h["at"] > F.col("at") - F.col("span")) & (h["at"] < F.col("at") + F.col("span")) & F.array_contains("template", h["word"])))
    joined = joined.where(F.size(F.array_distinct("near.word")) >= F.col("least"))
    after = F.size(F.array_intersect("near.word", "later"))
    joined = joined.where(F.col("place") + 1 + F.least(F.size("later"), after) >= F.col("least"))
    block = lambda h: F.size(F.array_distinct(F.transform(F.filter(F.col("near"), lambda x: (x["at"] >= h["at"]) & (x["at"] < h["at"] + F.col("span"))), lambda x: x["word"])))
    overlap = joined.withColumn("best", F.array_max(F.transform("near", block))).where(F.col("best") >= F.col("least")).withColumn("part", F.col("best") / F.col("size"))
    found = overlap.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("part").alias("part"))
    n_base = sum((F.coalesce(f"n_{k}", F.lit(0)) for k in range(1, len(PHRASES))), F.coalesce("n_0", F.lit(0)))
    base = F.array_compact(F.array(*[F.when(F.col(f"n_{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(PHRASES)]))
    out = own.drop("hits").join(found, "row", "left").withColumn("n_base", n_base.cast("long")).withColumn("base", F.array_sort(F.array_distinct(base)))
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        F.least(*[F.col(f"first_{k}") for k in range(len(PHRASES))]).alias("first_word"),
        F.greatest(*[F.col(f"last_{k}") for k in range(len(PHRASES))]).alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("part", F.lit(0.0))).alias("score"),
    )


def oracle(templates: tuple = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same rows from every block against every template, in DuckDB's SQL."""
    values = ", ".join(f"('{label}', {sorted(set(t.split()))!r}, {needed(t, threshold)}, {span(t)})" for label, t in templates)
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    places = " ".join(
        f"list_concat(list_filter(range(1, len(w) + 1), lambda i: {' AND '.join(f'w[i + {j}] = ' + repr(x) for j, x in enumerate(p.split()))}),"
        for p, _ in PHRASES
    )
    labels = ", ".join(f"CASE WHEN len(list_filter(range(1, len(w) + 1), lambda i: {' AND '.join(f'w[i + {j}] = ' + repr(x) for j, x in enumerate(p.split()))})) > 0 THEN '{label}' END" for p, label in PHRASES)
    return f"""
    WITH t(label, words, least, span) AS (VALUES {values}),
    d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS low FROM documents),
    x AS (SELECT r, doc_id, low, regexp_extract_all(low, '{word}') AS w FROM d),
    b AS (SELECT r, doc_id, len(w) AS n_words, {places} []{')' * len(PHRASES)} AS places, list_filter([{labels}], lambda y: y IS NOT NULL) AS base FROM x),
    may AS (SELECT r, w, label, words, least, span FROM x JOIN t ON len(list_intersect(words, w)) >= least),
    starts AS (SELECT r, label, words, least, span, w, unnest(range(1, len(w) + 1)) AS i FROM may),
    blocks AS (SELECT r, label, least, words, len(list_intersect(words, w[i : i + span - 1])) AS n FROM starts WHERE list_contains(words, w[i])),
    m AS (SELECT r, label, n / len(words) AS part FROM blocks WHERE n >= least),
    f AS (SELECT r, list(DISTINCT label) AS more, max(part) AS part FROM m GROUP BY r)
    SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base, (list_min(places) - 1)::BIGINT AS first_word, (list_max(places) - 1)::BIGINT AS last_word,
      array_to_string(list_sort(base), ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') AS labels,
      CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0.0)::DOUBLE END AS score
    FROM b LEFT JOIN f USING (r)"""

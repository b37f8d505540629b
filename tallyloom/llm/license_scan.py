"""Licence notices by an exact set-similarity join of text blocks with templates.

A block matches a template when it holds at least the template's share of its distinct words.  The
words of all templates are ordered by how many documents hold them, rarest first.  If a block holds
``need`` words of a template with n words, one of the first n - need + 1 template words is among the
first b - need + 1 of the block's b template words.  Only such pairs are joined; the lengths and the
places of the first common word then rule out more, and the rest is counted exactly.

Blocks start every ``BLOCK_WORDS`` words and reach over the next start by the words of the longest
template, so each place is whole in the block in which it starts.  Phrases must also stand word by
word.  Only words of templates matter, so the joined sides and their counts are bounded by the
templates.  Everything runs in the JVM.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm.registry import query, table
from tallyloom.llm.text import ascii_words

BLOCK_WORDS = 64


@dataclass(frozen=True)
class Template:
    """``phrase``: the words must stand consecutively.  ``base``: counted as a base label."""

    label: str
    text: str
    share: float = 1.0
    phrase: bool = True
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()


# Phrases with their labels, and openings of public licence notices.
BASE_PHRASES = (
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
)
NOTICES = (
    Template("all-rights-reserved", "all rights reserved"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mpl", "mozilla public license"),
    Template(
        "gpl-notice", "this program is free software you can redistribute it and or modify it under the "
        "terms of the gnu general public license as published by the free software foundation", 0.8, False,
    ),
    Template(
        "apache-notice", "you may not use this file except in compliance with the license you may obtain "
        "a copy of the license at", 0.85, False,
    ),
    Template(
        "mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files", 0.85, False,
    ),
    Template(
        "bsd-notice", "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met", 0.85, False,
    ),
    Template(
        "isc-notice", "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice", 0.85, False,
    ),
)


def word_order(docs: DataFrame, templates: tuple[Template, ...]) -> list[str]:
    """The templates' words, rarest in the documents first; at most as many as the templates have."""
    vocabulary = sorted({word for t in templates for word in t.words})
    held = F.array_intersect(ascii_words(F.col("text")), F.lit(vocabulary))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").count()
    found = {row["word"]: row["count"] for row in counts.collect()}
    return sorted(vocabulary, key=lambda word: (found.get(word, 0), word))


def scan(
    docs: DataFrame,
    templates: tuple[Template, ...] = BASE_PHRASES + NOTICES,
    block_words: int = BLOCK_WORDS,
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per document: ``doc_id, n_words, matches``.

    ``matches`` lists structs of label, base, phrase, score, block (its first word) and places, the
    starts of a phrase in the block.  It is empty for null, empty and unmatched texts.  Rows that
    repeat come out as often as they came in.  ``docs`` may hold any other columns.
    """
    spark = docs.sparkSession
    order = word_order(docs, templates)
    rank = {word: place for place, word in enumerate(order)}
    reach = max(len(t.words) for t in templates) - 1
    sides, firsts, least = [], set(), len(order)
    for t in templates:
        tokens = sorted(set(t.words), key=rank.get)
        need = max(1, math.ceil(t.share * len(tokens) - 1e-9))
        prefix = tokens[: len(tokens) - need + 1]
        firsts.update(prefix)
        least = min(least, need)
        sides += [
            (token, place, t.label, t.base, t.phrase, t.words, tokens, prefix, need)
            for place, token in enumerate(prefix, 1)
        ]
    side = spark.createDataFrame(
        sides,
        "token string, t_place int, label string, base boolean, phrase boolean, t_words array<string>, "
        "t_tokens array<string>, t_prefix array<string>, need int",
    )
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        ascii_words(F.col("text")).alias("words"),
    )
    starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(block_words))
    cut = F.transform(
        starts,
        lambda s: F.struct(s.alias("block"), F.slice("words", s + 1, block_words + reach).alias("tokens")),
    )
    kind = "struct<block:int,tokens:array<string>>"
    blocks = F.concat(  # one empty block counts the row itself
        F.array(F.lit(None).cast(kind)),
        F.coalesce(F.when(F.arrays_overlap("words", F.lit(sorted(firsts))), cut), F.array().cast(f"array<{kind}>")),
    )
    rows = rows.select("doc_id", "text_hash", F.size("words").alias("n_words"), F.explode(blocks).alias("b"))
    held = F.array_intersect(F.lit(order), F.col("b.tokens"))
    rows = rows.select("doc_id", "text_hash", "n_words", "b.*", held.alias("held"))
    head = F.when(F.size("held") >= least, F.slice("held", 1, F.size("held") - least + 1))
    rows = rows.select("*", F.posexplode_outer(head).alias("place", "token"))
    size, place = F.size("held"), F.col("place") + 1
    close = (
        (size >= F.col("need"))
        & (place <= size - F.col("need") + 1)
        & (F.least(F.size("t_tokens") - F.col("t_place"), size - place) + 1 >= F.col("need"))
    )
    joined = rows.join(F.broadcast(side), (rows["token"] == side["token"]) & close, "left").drop(side["token"])
    first_common = F.element_at(F.array_intersect("held", "t_prefix"), 1) == F.col("token")
    common = F.size(F.array_intersect("held", "t_tokens"))
    width = F.size("t_words")
    places = F.when(
        F.col("phrase") & (F.size("tokens") >= width),
        F.filter(
            F.sequence(F.lit(1), F.least(F.lit(block_words), F.size("tokens") - width + 1)),
            lambda i: F.slice("tokens", i, width) == F.col("t_words"),
        ),
    )
    starts_at = F.transform(places, lambda i: (i + F.col("block") - 1).cast("long"))
    matched = F.when(
        F.col("need").isNotNull() & first_common & (common >= F.col("need")),
        F.struct(
            "label", "base", "phrase", (common / F.size("t_tokens")).alias("score"), "block",
            F.coalesce(starts_at, F.array().cast("array<bigint>")).alias("places"),
        ),
    )
    valid = F.when(~matched["phrase"] | (F.size(matched["places"]) > 0), matched)
    return (
        joined.select("doc_id", "text_hash", "n_words", valid.alias("match"), F.col("block").isNull().alias("row"))
        .groupBy("doc_id", "text_hash", "n_words")
        .agg(F.collect_set("match").alias("matches"), F.count_if("row").alias("rows"))
        .select("doc_id", "n_words", "matches", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("row"))
        .drop("row")
    )


def _labels(chosen) -> F.Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(chosen, lambda m: m["label"]))), ",")


def reference_sql(templates: tuple[Template, ...] = BASE_PHRASES + NOTICES, block_words: int = BLOCK_WORDS) -> str:
    """SQL that compares every block with every template."""
    listed = ", ".join(
        f"('{t.label}', {t.base}, {t.phrase}, {t.words}, {sorted(set(t.words))}, "
        f"{max(1, math.ceil(t.share * len(set(t.words)) - 1e-9))})"
        for t in templates
    )
    reach = max(len(t.words) for t in templates) - 1
    return rf"""
WITH t AS (SELECT * FROM (VALUES {listed}) v(label, base, phrase, words, tokens, need)), d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM documents
), b AS (
  SELECT doc_id, s, list_distinct(w[s:s + {block_words + reach} - 1]) AS held
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w), {block_words})) AS s FROM d WHERE len(w) > 0)
), m AS (
  SELECT doc_id, label, len(list_intersect(held, tokens)) / len(tokens)::DOUBLE AS score
  FROM b, t WHERE NOT phrase AND len(list_intersect(held, tokens)) >= need
), p AS (
  SELECT doc_id, label, base, s - 1 AS place FROM (
    SELECT doc_id, w, label, base, words, unnest([i FOR i IN generate_series(1, len(w)) IF w[i] = words[1]]) AS s
    FROM d, t WHERE phrase AND list_contains(w, words[1])
  ) WHERE w[s:s + len(words) - 1] = words
), n AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p WHERE base GROUP BY doc_id
), a AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM (SELECT doc_id, label, 1.0::DOUBLE AS score FROM p UNION ALL SELECT * FROM m) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN a USING (doc_id)
"""


@query("op1_license_scan", reference_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents")))


def digest(scanned: DataFrame) -> DataFrame:
    base = F.filter("matches", lambda m: m["base"])
    places = F.flatten(F.transform(base, lambda m: m["places"]))
    return scanned.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size(places).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        _labels(base).alias("base_labels"), _labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )

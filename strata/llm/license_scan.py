"""License scans by an exact set-similarity join.

Templates are sets of words. A text's blocks are its runs of ``block_words``
words (twice the template's words, if that is more), one from each word on. The
join finds every text with a block that holds at least ``containment`` of a
template's words, and its best block:

* tokens are ordered by their frequency over all texts, rarest first;
* prefix filter: such a block holds one of a template's ``size - need + 1``
  first tokens, so texts meet templates by equality of those alone;
* length filter: a text of fewer than ``need`` of the template's words can't match;
* positional filter: a text that meets a template first at its p-th token has
  at most ``size - p`` tokens in common;
* what is left is verified: of all blocks those that start with a word of the
  template hold the most, and only they are counted.

Only template tokens are counted and joined; the templates are a given list, so
what goes to the driver and is broadcast (its tokens) doesn't grow with the texts.

Base labels stand beside it: fixed phrases whose words stand consecutively.

Defined results: null and empty texts have no words, no labels and score 0;
equal texts are scanned once and get equal labels; tokens of equal frequency go
by the alphabet; other columns are ignored.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import let, table

#: What separates words, the phrases and the template texts.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"),
    ("mit", "released under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "creative commons attribution share alike 4 0 license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved"),
]
CONTAINMENT, BLOCK_WORDS = 0.9, 64
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def scan_words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL), SEPARATORS), lambda w: w != F.lit(""))


def phrase_places(words: Column, phrase: str) -> Column:
    """Places (words from 0) where the phrase's words stand consecutively."""
    parts = phrase.split(" ")

    def places(w):
        here = lambda i: F.forall(
            F.array(*[F.struct(F.lit(k).alias("k"), F.lit(p).alias("p")) for k, p in enumerate(parts)]),
            lambda x: F.coalesce(F.get(w, i + x["k"]) == x["p"], F.lit(False)))
        return F.when(F.forall(F.array(*map(F.lit, parts)), lambda p: F.array_contains(w, p)),
                      F.filter(F.sequence(F.lit(0), F.size(w) - 1), here)).otherwise(F.array().cast("array<int>"))
    return let(words, places)


def _need(size: int, containment: float) -> int:
    return max(1, ceil(containment * size - 1e-9))


def token_order(texts: DataFrame, templates) -> list[str]:
    """The templates' tokens, the rarest over all texts (``_words``) first.

    At most as many rows as there are template tokens reach the driver.
    """
    tokens = sorted({w for _, t in templates for w in t.split(" ")})
    known = F.array(*map(F.lit, tokens))
    counts = dict(texts.select(F.explode(F.array_intersect("_words", known)).alias("token"))
                  .groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect())
    return sorted(tokens, key=lambda w: (counts.get(w, 0), w))


def _block(size: int, block_words: int) -> int:
    return max(block_words, 2 * size)


def matches(texts: DataFrame, templates=None, containment: float = CONTAINMENT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(_key, template, label, start, containment): the best block of each text and
    template that match, the first one of equals.

    ``texts`` has ``_key`` and ``_words``; ``templates`` are (label, words) pairs, the
    words lower-cased and parted by blanks.
    """
    templates = templates or TEMPLATES
    rank = {w: k for k, w in enumerate(token_order(texts, templates))}
    rows, prefix_tokens = [], set()
    for number, (label, text) in enumerate(templates):
        tokens = sorted(set(text.split(" ")), key=rank.__getitem__)
        need = _need(len(tokens), containment)
        prefix = tokens[:len(tokens) - need + 1]
        prefix_tokens.update(prefix)
        rows += [(w, number, label, tokens, prefix[:p], need, p, _block(len(text.split(" ")), block_words)) for p, w in enumerate(prefix)]
    prefix = F.broadcast(texts.sparkSession.createDataFrame(
        rows, "token string, template int, label string, tokens array<string>, rarer array<string>, need int, place int, span int"))
    first = F.array(*map(F.lit, sorted(prefix_tokens)))
    known = F.array(*map(F.lit, sorted(rank)))
    places = F.filter(F.transform("_words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda x: F.array_contains(known, x["word"]))
    held = (texts.filter(F.arrays_overlap("_words", first))
            .select("_key", places.alias("places"))
            .withColumn("words", F.array_distinct(F.col("places.word")))
            .withColumn("token", F.explode(F.array_intersect("words", first))))
    # A text meets a template at the rarest token that it holds, once.
    both = held.join(prefix, "token").filter(
        ~F.arrays_overlap("words", "rarer") & (F.size("tokens") - F.col("place") >= F.col("need"))
        & (F.size(F.array_intersect("words", "tokens")) >= F.col("need")))

    def counted(own):
        return F.transform(own, lambda x, k: F.struct(
            F.size(F.array_distinct(F.transform(F.filter(F.slice(own, k + 1, F.col("span")), lambda y: y["at"] < x["at"] + F.col("span")),
                                                lambda y: y["word"]))).alias("common"), (-x["at"]).alias("back")))
    own = F.filter("places", lambda x: F.array_contains("tokens", x["word"]))
    best = both.withColumn("best", F.array_max(let(own, counted))).filter(F.col("best.common") >= F.col("need"))
    return best.select("_key", "template", "label", (-F.col("best.back")).alias("start"),
                       (F.col("best.common") / F.size("tokens")).alias("containment")).distinct()


def scan(docs: DataFrame, keep: list[str], text: str = "text", **options) -> DataFrame:
    """Columns ``keep`` with word counts, base places and all labels."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, scan_words(F.col(text)).alias("_words"),
                       F.struct(F.xxhash64(t).alias("hash"), F.length(t).alias("chars")).alias("_key"))
    found = (matches(rows.select("_key", "_words"), **options).groupBy("_key")
             .agg(F.collect_set("label").alias("found"), F.max("containment").alias("best")))
    places = [phrase_places(F.col("_words"), p).alias(f"_p{k}") for k, (p, _) in enumerate(PHRASES)]
    base = rows.select(*keep, "_key", F.size("_words").cast("long").alias("n_words"), *places)
    every = F.concat(*[F.col(f"_p{k}") for k in range(len(PHRASES))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"_p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(PHRASES)]))
    base = base.select(*keep, "_key", "n_words", F.size(every).cast("long").alias("n_base"),
                       F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
                       F.array_sort(F.array_distinct(labels)).alias("_base"))
    return base.join(found, "_key", "left").select(
        *keep, "n_words", "n_base", "first_word", "last_word", F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size("_base") > 0, 1.0).otherwise(0.0)).alias("score"))


def query(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"), ["doc_id"])


def _sql() -> str:
    phrase = lambda p: " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split(" ")))
    places = ", ".join(f"list_filter(range(1, len(w) + 1), lambda i: coalesce({phrase(p)}, false)) AS p{k}"
                       for k, (p, _) in enumerate(PHRASES))
    labels = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(PHRASES))
    rows = ", ".join(f"('{label}', {sorted(set(t.split(' ')))}, {_need(len(set(t.split(' '))), CONTAINMENT)}, {_block(len(t.split(' ')), BLOCK_WORDS)})"
                     for label, t in TEMPLATES)
    known = sorted({w for _, t in TEMPLATES for w in t.split(" ")})
    return rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n_words, {places} FROM d),
base AS (SELECT doc_id, n_words, {' || '.join(f'p{k}' for k in range(len(PHRASES)))} AS every,
  list_filter([{labels}], lambda x: x IS NOT NULL) AS base FROM p),
template(label, tokens, need, span) AS (VALUES {rows}),
token AS (SELECT label, tokens, need, span, unnest(tokens) AS word FROM template),
place AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d
  WHERE len(list_intersect(w, {known})) > 0)),
hit AS (SELECT doc_id, i, word, label, tokens, need, span FROM place JOIN token USING (word)),
able AS (SELECT doc_id, tokens FROM hit GROUP BY doc_id, tokens, need HAVING count(DISTINCT word) >= need),
block AS (SELECT a.doc_id, a.i, a.label, a.tokens, a.need, count(DISTINCT b.word) AS common
  FROM hit a JOIN able USING (doc_id, tokens) JOIN hit b ON a.doc_id = b.doc_id AND a.tokens = b.tokens AND b.i >= a.i AND b.i < a.i + a.span
  GROUP BY a.doc_id, a.i, a.label, a.tokens, a.need),
found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(common / len(tokens)) AS best FROM block WHERE common >= need GROUP BY doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(every) AS BIGINT) AS n_base, CAST(list_min(every) - 1 AS BIGINT) AS first_word,
  CAST(list_max(every) - 1 AS BIGINT) AS last_word, array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(base || coalesce(labels, []))), ',') AS labels,
  greatest(coalesce(best, 0.0), CASE WHEN len(base) > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS score
FROM base LEFT JOIN found USING (doc_id)
"""


SQL = _sql()

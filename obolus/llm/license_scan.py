"""License scans: an exact set-similarity join of blocks of a text with licence templates.

A block is a window of as many words as the longest template has, wherever lines end; it matches a
template when it holds at least ``threshold`` of the template's distinct words. Texts are cut into words
once; what is stored of them is the places of the templates' words in those texts that hold enough of
some template at all. The join meets the bound without comparing all pairs. Words are ordered by how many
texts of the corpus hold them, the rarest first, and with ``need = ceil(threshold * |T|)``

- prefix: a block that reaches the overlap holds one of the first ``|T| - need + 1`` words of T, so only texts
  with such a word meet T, and in them only blocks around one;
- length: a block of fewer than ``need`` places with words of T can't reach it;
- position: the first common word at place j of T and at place i of the block's own words leaves
  ``1 + min(|T| - j, |B| - i)`` words to share at the most;
- the blocks left are counted.

The templates are a parameter, so the words of all together are a few hundred and tables of them as long.
Only DataFrame functions are used. The work on a text grows with its length, however many
templates' words it holds.

Defined results: a null text counts as empty: no words, no block, score 0. A text gets the label of
every template that a block of it holds enough of, but for a match that a better one explains: all its
words are words of a match that holds more of its template (of equals, of the one of more words, then the
last by name), as cc-by-4.0 beside cc-by-nc, and it stands at most of their places.
Repeated rows get the same result each; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obolus.llm.common import ascii_lower, stored
from obolus.operators.shape import once

#: Phrases whose words stand one after the other, and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Licence statements in the words of this module's word rule, and their labels.
TEMPLATES = (
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under a creative commons attribution license", "cc-by"),
    ("dedicated to the public domain under cc0", "cc0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this work is licensed under the gnu general public license version 2", "gpl-2"),
    ("this library is free software under the terms of the gnu lesser general public license", "lgpl"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("all rights reserved", "reserved"),
)
#: Characters of ASCII that are neither a digit nor, after lower-casing, a letter.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    need: int


def templates_of(texts=TEMPLATES, threshold: float = 0.8) -> list[Template]:
    out = []
    for text, label in texts:
        words = tuple(dict.fromkeys(text.split()))
        out.append(Template(label, words, max(1, math.ceil(threshold * len(words) - 1e-9))))
    return out


def words_of(text: Column) -> Column:
    """The words of a text, in their order; of one without words an empty array."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _literal(words) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.expr("cast(array() as array<string>)")


def texts_of(docs: DataFrame, phrases, templates: list[Template]) -> DataFrame:
    """(doc_id, h, n_words, own, s, places) of every document: the distinct words of templates and phrases in
    it; its words with single spaces around them where all words of some phrase are there; the places of
    templates' words, in their order, where the text holds enough words of some template."""
    known = sorted({w for t in templates for w in t.words} | {w for p, _ in phrases for w in p.split()})
    text = F.coalesce("text", F.lit(""))
    df = once(docs.select("doc_id", F.xxhash64(text).alias("h"), words_of(F.col("text")).alias("_w")), "ws", F.col("_w")).drop("_w")
    df = once(df, "own", F.array_intersect("ws", _literal(known)))
    phrase = reduce(Column.__or__, [F.size(F.array_intersect("own", _literal(sorted(set(p.split()))))) == len(set(p.split())) for p, _ in phrases], F.lit(False))
    enough = reduce(Column.__or__, [F.size(F.array_intersect("own", _literal(t.words))) >= t.need for t in templates], F.lit(False))
    body = _literal(sorted({w for t in templates for w in t.words}))
    df = once(df, "tell", F.array_intersect("own", body))
    places = F.filter(F.transform("ws", lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda p: F.array_contains(F.col("tell"), p["w"]))
    return df.select("doc_id", "h", F.size("ws").cast("long").alias("n_words"), "own", F.when(phrase, F.concat(F.lit(" "), F.array_join("ws", " "), F.lit(" "))).alias("s"),
                     F.when((F.size("own") >= min((t.need for t in templates), default=1)) & enough, places).alias("places"))


def word_counts(found: DataFrame) -> DataFrame:
    """How many texts hold each template word: one row for each word and task is shuffled."""
    return found.select(F.explode("own").alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def windows(width: int) -> Column:
    """The matches of a text with a template, from ``at`` (places of the template's words), ``body`` (its words in the
    global order), ``need`` and ``label``: one for each window of ``width`` words that begins at one of the
    places and holds enough; not those whose first word comes again before their last."""
    at, body, need = F.col("at"), F.col("body"), F.col("need")
    prefix = F.slice("body", 1, F.size(body) - need + 1)
    cuts = F.transform(at, lambda p, k: F.filter(F.slice(at, k + 1, width), lambda q: q["i"] < p["i"] + width))
    cuts = F.filter(cuts, lambda c: (F.size(c) >= need) & F.exists(c, lambda q: F.array_contains(prefix, q["w"])))
    firsts = F.transform(cuts, lambda c: F.struct(c.alias("c"), F.filter(c, lambda q, x: F.array_position(c["w"], q["w"]) == x + 1).alias("f")))
    left = lambda m: F.size(body) + 1 - F.array_min(F.transform(m["f"], lambda q: F.array_position(body, q["w"])))
    again = lambda m: F.exists(m["c"], lambda q: (q["w"] == m["f"][0]["w"]) & (q["i"] > m["f"][0]["i"]) & (q["i"] < F.element_at(m["f"], -1)["i"]))
    return F.transform(F.filter(firsts, lambda m: (F.size(m["f"]) >= need) & (left(m) >= need) & ~again(m)), lambda m: F.struct(
        m["f"][0]["i"].alias("start"), (F.size(m["f"]) / F.size(body)).alias("containment"), F.size(body).alias("size"), F.col("label").alias("label"),
        m["f"]["w"].alias("shared"), m["f"]["i"].alias("at")))


def match(found: DataFrame, templates: list[Template], counts: dict[str, int], width: int) -> DataFrame:
    """(doc_id, h, ms) of every text and template with enough words in common: the windows that match.

    ``counts`` has the vocabulary's words only, so its size is that of the templates."""
    spark = found.sparkSession
    order = sorted({w for t in templates for w in t.words}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index, bodies = [], []
    for k, t in enumerate(templates):
        words = sorted(t.words, key=rank.__getitem__)
        bodies.append((k, t.label, words))
        index += [(w, k, j, len(words), t.need) for j, w in enumerate(words[:len(words) - t.need + 1])]
    prefix = spark.createDataFrame(index, "word string, t int, j int, size int, need int")
    body = spark.createDataFrame(bodies, "t int, label string, body array<string>")
    df = found.filter("places is not null").dropDuplicates(["doc_id", "h"]).withColumn("own", F.array_intersect(_literal(order), F.col("own")))  # in the global order
    df = df.select("doc_id", "h", "places", "own", F.posexplode("own").alias("i", "word"))
    pairs = (df.join(prefix, "word")
             .filter(1 + F.least(F.col("size") - F.col("j") - 1, F.size("own") - F.col("i") - 1) >= F.col("need"))
             .join(body, "t"))
    shared = F.array_intersect("own", "body")
    pairs = pairs.filter((F.size(shared) >= F.col("need")) & (F.element_at(shared, 1) == F.col("word")))  # once: at the first common word
    pairs = once(pairs, "at", F.filter("places", lambda p: F.array_contains(F.col("body"), p["w"])))
    return pairs.select("doc_id", "h", windows(width).alias("ms"))


def unexplained(found: Column, reach: int) -> Column:
    """Of a text's matches in the order of their starts those that no better one explains; one that does is
    at most ``reach`` places away."""
    rank = lambda m: F.struct(m["containment"], m["size"], m["label"])
    return F.filter(found, lambda a, x: ~F.exists(F.slice(found, F.greatest(x + 1 - reach, F.lit(1)), 2 * reach + 1), lambda b: (
        (rank(b) > rank(a)) & (2 * F.size(F.array_except(a["at"], b["at"])) < F.size(a["at"])) & (F.size(F.array_except(a["shared"], b["shared"])) == 0))))


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word (of the phrases),
    base_labels, labels (the join's too), score (the best containment; 1 with a phrase)."""
    known = templates_of(templates, threshold)
    found = stored(texts_of(docs, phrases, known))
    counts = {r["word"]: r["n"] for r in word_counts(found).collect()}  # the templates' words: a fixed number
    width = max((len(t.split()) for t, _ in templates), default=1)
    per_text = match(found, known, counts, width).groupBy("doc_id", "h").agg(F.array_sort(F.flatten(F.collect_set("ms"))).alias("ms"))
    per_text = once(per_text, "kept", unexplained(F.col("ms"), width * len(known))).filter(F.size("kept") > 0)
    best = per_text.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), F.array_distinct("kept.label").alias("more"), F.array_max("kept.containment").alias("best"))

    spaces = lambda c: F.length(c) - F.length(F.translate(c, " ", ""))
    places, starts, ends, labels = [], [], [], []
    for phrase, label in phrases:
        has = F.contains(F.col("s"), F.lit(f" {phrase} "))
        size = len(phrase.split())
        before = F.substring_index("s", f" {phrase} ", 1)
        after = F.substring_index("s", f" {phrase} ", -1)
        places.append(F.when(has, F.regexp_count("s", F.lit(f" {phrase}(?= )"))).otherwise(0).cast("long"))
        starts.append(F.when(has, spaces(before)))
        ends.append(F.when(has, F.col("n_words") - spaces(after) - size))
        labels.append(F.when(has, F.array(F.lit(label))).otherwise(F.expr("cast(array() as array<string>)")))
    df = found.select("doc_id", "h", "n_words", sum(places[1:], places[0]).alias("n_base"), F.least(*starts).cast("long").alias("first_word"),
                      F.greatest(*ends).cast("long").alias("last_word"), F.array_distinct(F.flatten(F.array(*labels))).alias("base"))
    df = df.join(best, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    none = F.expr("cast(array() as array<string>)")
    return df.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))

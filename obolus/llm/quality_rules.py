"""Quality rules, line first: punctuation, navigation and boilerplate rules judge each line, lines
that fail go, and a document that loses too much of its text goes with them.

Everything is built of DataFrame functions and stays inside the document's row: no shuffle.

Defined results: a null text counts as empty; an empty text has no word and fails (``min_words``).
Columns besides ``text`` and ``doc_id`` are carried or left out, never read, so any name may occur.
Rows are judged one by one: repeated rows get the same result each, an empty table gives no rows.
Time and memory per row grow as n log n with the length of its text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obolus.llm.common import SPACE, words_of
from obolus.operators.shape import once

#: What menus part their entries with, what ends or parts a sentence, symbol characters.
BARS = "|»›•·"
STOPS = ".!?:;,…"
SYMBOLS = "#*$%&|<>"
#: Phrases of page furniture, looked for in short lines.
BOILERPLATE = ("all rights reserved", "privacy policy", "cookie policy", "terms of use", "terms of service", "click here", "sign up", "log in",
               "skip to content", "back to top", "enable javascript", "subscribe to our", "share this", "powered by")


@dataclass(frozen=True)
class Rules:
    min_words: int = 20            #: a document of fewer words fails
    max_repeat_percent: int = 30   #: of its words inside 8-word windows that occur again
    window: int = 8
    max_lost_percent: int = 50     #: of its words that the lines which fail may take with them
    long_line: int = 12            #: words from which a line must hold some punctuation
    short_line: int = 12           #: words up to which boilerplate phrases condemn a line


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _repeated_words(df: DataFrame, words: str, n: str, name: str) -> DataFrame:
    """Adds the number of words in windows of 8 that occur twice or more in the row's text.

    A window's hash is folded from those of its halves; rows whose windows all differ stop there.
    In the others the sorted (hash, place) list shows which windows have an equal neighbour, and
    the places in order give the length of the union of the windows."""
    df = once(df, "_h1", F.transform(F.col(words), lambda w: F.xxhash64(w)))
    h = F.col("_h1")
    for step in (1, 2, 4):  # after these, one hash for 2, 4 and 8 words
        h = F.zip_with(h, F.slice(h, 1 + step, F.greatest(F.col(n), F.lit(1)).cast("int")), lambda a, b: F.xxhash64(a, b))
        df = once(df, f"_h{2 * step}", h).drop(f"_h{step}")
        h = F.col(f"_h{2 * step}")
    df = once(df, "_w", F.when(F.col(n) >= 8, F.slice(h, 1, (F.greatest(F.col(n), F.lit(8)) - 7).cast("int")))).drop("_h8")
    again = F.size(F.array_distinct("_w")) < F.size("_w")
    df = once(df, "_s", F.when(again, F.array_sort(F.transform("_w", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))).drop("_w")
    at = F.expr("filter(_s, (x, k) -> (k > 0 and x.h = _s[k - 1].h) or (k + 1 < size(_s) and x.h = _s[k + 1].h))")
    df = once(df, "_at", F.when(F.col("_s").isNotNull(), F.array_sort(F.transform(at, lambda x: x["i"])))).drop("_s")
    total = F.expr("aggregate(_at, named_struct('n', 0L, 'last', -8), (a, p) -> named_struct('n', a.n + least(8, p - a.last), 'last', p), a -> a.n)")
    return df.withColumn(name, F.coalesce(total, F.lit(0).cast("long"))).drop("_at")


def line_verdicts(text: Column, rules: Rules = Rules()) -> Column:
    """The lines of ``text`` in order as structs (line, n words, ok). A line without a word is ok."""
    def measured(line: Column) -> Column:
        w = words_of(line)
        return F.struct(line.alias("line"), F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct"), _count(line, BARS).alias("bars"),
                        _count(line, SYMBOLS).alias("symbols"), _count(line, STOPS).alias("stops"), _count(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("upper"))

    def judged(x: Column) -> Column:
        n = x["n"]
        bare = (n >= rules.long_line) & (x["stops"] == 0)
        menu = (x["bars"] >= 3) & (x["bars"] * 4 >= n)
        symbols = (n >= 5) & (x["symbols"] * 2 >= n)
        shouted = (n >= 5) & (x["upper"] * 2 > F.length(x["line"]))
        stuck = (n >= 10) & (x["distinct"] * 3 <= n)
        furniture = (n <= rules.short_line) & F.lower(x["line"]).rlike("|".join(BOILERPLATE))
        return F.struct(x["line"].alias("line"), n.alias("n"), ((n == 0) | ~(bare | menu | symbols | shouted | stuck | furniture)).alias("ok"))

    return F.transform(F.transform(F.split(text, "\n"), measured), judged)


def measure(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document: ``row`` (its columns as they came), ``clean_text`` (the lines that
    passed), the counts, ``base_failed`` and ``kept``."""
    df = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    df = once(df, "_words", words_of(F.col("_t")))
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    df = _repeated_words(df, "_words", "n_words", "n_repeat_words").drop("_words")
    df = once(df, "_lines", line_verdicts(F.col("_t"), rules))
    spoken = F.filter("_lines", lambda x: x["n"] > 0)
    lost = F.aggregate(F.filter("_lines", lambda x: ~x["ok"]), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    lines = F.transform(spoken, lambda x: x["line"])
    df = df.select(
        "row", F.array_join(F.transform(F.filter("_lines", lambda x: x["ok"]), lambda x: x["line"]), "\n").alias("clean_text"),
        "n_words", F.length(F.translate("_t", SPACE, "")).cast("long").alias("word_chars"), _count(F.col("_t"), SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"), "n_repeat_words", lost.alias("n_lost_words"))
    df = df.withColumn("base_failed", (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    return df.withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_lost_words") <= rules.max_lost_percent * F.col("n_words")))


def keep_clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their columns; ``text`` without the lines that failed."""
    m = measure(docs, rules).filter("kept")
    return m.select(*[(F.col("clean_text") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])

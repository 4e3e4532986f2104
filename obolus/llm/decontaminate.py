"""Benchmark decontamination: training texts are scanned for windows of words of benchmark items.

A window is ``size`` consecutive words of an item; an item of fewer words, but not none, is one window.
The distinct windows, each with a hash of its words, are sent to every task as a hash set, in blocks of at
most ``BLOCK`` windows (a larger benchmark takes several scans of the texts, never a larger broadcast).
Every place of a text looks its own window up by the hash and then compares the words, so a hit is a
hit. Only hits are shuffled, to the document they stand in; a place is one row there, however many
items hold its window: windows are kept with the set of their items, and sets, not items, are counted
until a document's are known. Only DataFrame functions are used.

Defined results: words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z is lower-cased; a null text has none, is not
contaminated and hit by nothing. An item without an id marks words but is not counted among items; an
id on several rows is one item with the windows of all of them. Rows equal in doc_id and text get the same
result each; a null doc_id is an id like others. Empty benchmark: nothing is hit. Other columns of either
table are carried by ``remove`` and not read else, whatever their names. Texts of any length are scanned whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obolus.llm.common import ascii_lower, stored
from obolus.operators.shape import once

SIZE = 10
#: Windows sent to every task at once: some 200 bytes each.
BLOCK = 200_000
#: Characters of ASCII that are neither a digit nor, after lower-casing, a letter; and those of words, in any case.
NOT_WORD, WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, in their order; of one without words an empty array."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _hash(words: Column) -> Column:
    return F.xxhash64(words)


def item_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(h, words, n, set, items): the distinct windows, how many words each has, and the ids of its items, as
    strings in their order, with a name for that set of items. As many rows at the most as the benchmark has words."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("ws")).filter("size(ws) > 0")
    at = F.sequence(F.lit(1), F.greatest(F.size("ws") - size + 1, F.lit(1)))
    windows = items.select("item", F.explode(F.transform(at, lambda i: F.slice("ws", i, size))).alias("words"))
    return windows.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items")).select(
        _hash(F.col("words")).alias("h"), "words", F.size("words").alias("n"), F.sha2(F.to_json("items"), 256).alias("set"), "items")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, text), null texts empty; rows equal in doc_id and text have one key."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", _key(F.col("doc_id"), text).alias("key"), text.alias("text"))


def _key(doc_id: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.coalesce(F.concat(F.lit("i"), doc_id.cast("string")), F.lit("n")), F.lit(":"), text).cast("binary"), 256)


def scan(docs: DataFrame, windows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, key, start, n_words, n, set): every place of a text where a window of ``windows`` begins, words from
    0; of windows of several sizes that begin there, one row each. And for each document one row that
    starts after its last word, with neither n nor set, so that a text's words are counted in the same pass."""
    sizes = sorted(r["n"] for r in windows.select("n").distinct().collect())  # from 1 to the window's size: a fixed number
    blocks = -(-windows.count() // block)
    texts = keyed(docs).select("doc_id", "key", words_of(F.col("text")).alias("ws"))
    places = texts.select("doc_id", "key", "ws", F.size("ws").alias("n_words"), F.explode(F.sequence(F.lit(0), F.size("ws"))).alias("start"))
    parts, columns = [], ["doc_id", "key", "start", "n_words", "n", "set"]
    for size in sizes:
        own = windows.filter(F.col("n") == size).select("h", "words", "set", "n")
        window = F.slice(F.col("ws"), F.col("start") + 1, size)  # shorter at the end, where it is no window's equal
        for b in range(blocks):
            part = F.broadcast(own if blocks == 1 else own.filter(F.pmod("h", F.lit(blocks)) == b))
            same = (_hash(window) == F.col("h")) & (window == F.col("words"))
            parts.append((places.join(part, same) if parts else places.join(part, same, "left").filter(F.col("set").isNotNull() | (F.col("start") == F.col("n_words")))).select(*columns))
    if not parts:
        return texts.select("doc_id", "key", F.size("ws").alias("start"), F.size("ws").alias("n_words"), F.lit(None).cast("int").alias("n"), F.lit(None).cast("string").alias("set"))
    return reduce(DataFrame.unionByName, parts)


def per_text(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, n_hit, hits, items): of each text with hits, the words inside any, the hits (start, end) in
    their order, and the ids of the items, as strings in their order."""
    texts = found.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("hits"))
    state = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))  # words inside so far, and the furthest end
    counted = F.aggregate("hits", state, lambda a, s: F.struct(
        (a["n"] + F.greatest(s["end"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("n"), F.greatest(a["end"], s["end"]).alias("end")))
    sets = windows.select("set", "items").dropDuplicates(["set"])
    told = found.select("key", "set").distinct().join(sets, "set").groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return texts.join(told, "key").select("key", counted["n"].cast("long").alias("n_hit"), "hits", "items")


def _scanned(docs: DataFrame, benchmark: DataFrame, size: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n_words) of every document, and what ``per_text`` says of those with hits."""
    windows = stored(item_windows(benchmark, size))
    found = stored(scan(docs, windows, block))
    return found.filter("set is null").select("doc_id", "key", "n_words"), per_text(found.filter("set is not null"), windows)


def judge(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows, hit = _scanned(docs, benchmark, size, block)
    items = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(hit, "key", "left").select("doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                                                F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, spans: bool = True, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """``docs`` with their columns and without what benchmark windows hit: with ``spans`` these words of a
    text, each with the characters up to the next word; else the documents that have any."""
    hit = _scanned(docs, benchmark, size, block)[1].select(F.col("key").alias("_key"), "hits")
    row = docs.select(F.struct("*").alias("_row"), _key(F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("_key"))
    if not spans:
        return row.join(hit, "_key", "left_anti").select("_row.*")
    # each word with the characters after it; what stands before the first word stays
    text = F.col("_row")["text"]
    pieces = F.regexp_extract_all(text, F.lit(f"({WORD}[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*)"), F.lit(1))
    before = F.regexp_extract(text, r"^([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)", 1)
    joined = row.join(hit, "_key", "left").withColumn("_p", F.when(F.col("hits").isNotNull(), pieces))
    # runs of words between spans, in one fold over the hits: what is kept so far, and the furthest end
    start = F.struct(F.expr("cast(array() as array<struct<a:int,b:int>>)").alias("keep"), F.lit(0).alias("end"))
    folded = F.aggregate("hits", start, lambda a, s: F.struct(
        F.when(s["start"] > a["end"], F.array_append(a["keep"], F.struct(a["end"].alias("a"), s["start"].alias("b")))).otherwise(a["keep"]).alias("keep"),
        F.greatest(a["end"], s["end"]).alias("end")))
    joined = once(joined, "_f", folded)
    kept = F.concat(F.flatten(F.transform(F.col("_f")["keep"], lambda k: F.slice(F.col("_p"), k["a"] + 1, k["b"] - k["a"]))), F.slice(F.col("_p"), F.col("_f")["end"] + 1, F.size("_p")))
    cleaned = F.when(F.col("hits").isNull(), text).otherwise(F.concat(before, F.array_join(kept, "")))
    return joined.select(*[(cleaned if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns])

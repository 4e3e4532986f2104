"""Exact de-duplication by two passes of a Bloom filter.

First pass: each text sets ``bits`` places of a counting filter (all in one 64-bit word that its
hash picks). Places are counted with map-side combine, so a group of copies, however large, sends
one row from each task; the places hit twice or more make the second filter. Second pass: a row
all of whose places are in that filter may be repeated, and only such rows are shuffled (by
SHA-256, which decides); all other rows are unique and pass straight through.

The second filter is sent to every task. Its size is fixed by ``max_words`` (8 bytes each, 32 MiB
at the most) whatever the input. Beyond some 2 ** 23 texts a filter of that size lets more
rows through to the exact pass, which costs shuffle and never a result; give a larger one then.

Only DataFrame functions are used. Defined results: a null text counts as empty; of equal texts the
row with the largest doc_id stays (a null id is smaller than any other); where that id comes more
than once with the same text, ``mark`` tells each such row kept, ``drop_copies`` keeps one of them.
Columns besides ``text`` and ``doc_id`` are carried as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obolus.llm.common import stored

#: Filter words in one row of the filter's table.
BLOCK = 1024


def _places(h: Column, bits: int) -> list[Column]:
    """Places in a 64-bit word, from 6 bits each of the hash's upper part."""
    return [F.shiftrightunsigned(h, 58 - 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(bits)]


def _word(h: Column, n_words: int) -> Column:
    return F.pmod(F.xxhash64(h), F.lit(n_words))


def filter_words(rows: int, max_words: int) -> int:
    """A power of two: 32 bits for each row, within the bound."""
    return min(max_words, max(BLOCK, 1 << math.ceil(math.log2(max(1, rows) / 2 + 1))))


def repeated_filter(hashes: DataFrame, n_words: int, bits: int) -> DataFrame:
    """(block, words): the places that two or more rows set, as 64-bit words, 1024 to a row. ``hashes`` has one column, ``h``."""
    places = hashes.select(_word(F.col("h"), n_words).alias("word"), F.explode(F.array_distinct(F.array(*_places(F.col("h"), bits)))).alias("bit"))
    hit = places.groupBy("word", "bit").agg(F.count("*").alias("n")).filter("n > 1")
    words = hit.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    packed = words.groupBy(F.floor(F.col("word") / BLOCK).alias("block")).agg(F.map_from_entries(F.collect_list(F.struct(F.pmod("word", F.lit(BLOCK)).cast("int").alias("i"), "mask"))).alias("m"))
    at = F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long")))
    return packed.select("block", at.alias("words"))


def possibly_repeated(df: DataFrame, h: str, max_words: int = 1 << 22, bits: int = 3) -> DataFrame:
    """``df`` with ``_maybe``: false for rows whose hash ``h`` comes once for certain."""
    n_words = filter_words(df.count(), max_words)
    blocks = repeated_filter(df.select(F.col(h).alias("h")), n_words, bits)
    word = _word(F.col(h), n_words)
    mask = F.lit(0).cast("long")
    for b in _places(F.col(h), bits):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))
    joined = df.withColumn("_block", F.floor(word / BLOCK)).withColumn("_i", F.pmod(word, F.lit(BLOCK)).cast("int")).withColumn("_mask", mask)
    joined = joined.join(F.broadcast(blocks.withColumnRenamed("block", "_block")), "_block", "left")
    hit = F.coalesce(F.element_at("words", F.col("_i") + 1), F.lit(0).cast("long")).bitwiseAND(F.col("_mask")) == F.col("_mask")
    return joined.withColumn("_maybe", hit).drop("_block", "_i", "_mask", "words")


#: Groups that get their result by a broadcast: those of more than so small a share of all rows, so there are no more of them.
LARGE = 10_000


def mark(docs: DataFrame, max_words: int = 1 << 22) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Groups larger than a ten-thousandth of all rows, at most ten thousand of them, are sent to the
    rows; the rows of smaller groups meet theirs by a shuffle, so that no task gets a large group."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = possibly_repeated(docs.select("doc_id", F.sha2(text.cast("binary"), 256).alias("text_sha256"), F.xxhash64(text).alias("_h")), "_h", max_words).drop("_h")
    once = df.filter("not _maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    maybe = df.filter("_maybe").select("doc_id", "text_sha256")
    groups = stored(maybe.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    large = F.col("group_size") > docs.count() / LARGE
    told = maybe.join(F.broadcast(groups.filter(large).withColumnRenamed("keep_id", "_keep").withColumnRenamed("group_size", "_size")), "text_sha256", "left")
    in_large = told.filter("_size is not null").select("doc_id", F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"), "text_sha256")
    in_small = told.filter("_size is null").select("doc_id", "text_sha256").join(groups.filter(~large), "text_sha256").select("doc_id", "keep_id", "group_size", "text_sha256")
    again = in_large.unionByName(in_small).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return once.unionByName(again)


def drop_copies(docs: DataFrame, max_words: int = 1 << 22) -> DataFrame:
    """The documents that stay, with their columns. One row for each text: a group of copies is
    reduced to one row in each task before anything of it is shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = possibly_repeated(docs.select(F.struct("*").alias("_row"), F.xxhash64(text).alias("_h")), "_h", max_words)
    maybe = df.filter("_maybe").withColumn("_sha", F.sha2(F.coalesce(F.col("_row")["text"], F.lit("")).cast("binary"), 256))
    told = [F.col("_row")[c] for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    best = maybe.groupBy("_sha").agg(F.max_by("_row", F.struct(F.col("_row")["doc_id"], F.xxhash64(*told))).alias("_row"))
    return df.filter("not _maybe").select("_row.*").unionByName(best.select("_row.*"))

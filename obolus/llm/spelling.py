"""Spelling variants by a trie-node pair dictionary.

Words are paths from the root of a trie, and read backwards of another. Every node of either has a number,
and a word is, at each of its places, a pair of numbers: the node of what stands before and the reversed
node of what stands after. A word with the character at a place skipped gives one pair, a word parted
between two characters another, and

- two words with the same skipped pair differ in that one character (a replaced one);
- a skipped pair of one word that is the parted pair of another: that one lacks the character (a
  deleted or inserted one). In a run of equal characters only the first is taken, so that a pair of words
  meets once.

Numbers and not strings are joined, so a long word's pairs take no more room than a short one's. A node of
up to ``DIRECT`` characters has them, 7 bits each, for its number; deeper ones (few, as words are
short) are numbered by a dictionary table over the 128-bit hashes of their paths, joined back to them.
A group of one pair has at most a word for each character of the alphabet, 90 of them, and one
without it, whatever the corpus: no bucket is unbounded, none is capped, and no pairs leave a group:
each word takes from it how many near words it has there and the best of them.

Words that have a more frequent near one follow it; as the number of occurrences at least doubles
with each step, roots are found by a few rounds of doubling the step.

Defined results: a null text has no words; a null doc_id stands in the hash as nothing at all; repeated
rows count as often as they come (with one doc_id and text they lose the same characters). Runs of any
length are words, in room that grows with their length. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obolus.llm.common import ascii_lower, stored
from obolus.operators.shape import once

#: Characters whose nodes are numbered by themselves: 9 times 7 bits.
DIRECT = 9
#: The least characters and occurrences of a word; how many times as frequent its form is.
LENGTH, TIMES, RATIO = 5, 3, 2
#: One in so many runs of letters loses a character.
LOSES = 97


def runs_of(text: Column) -> Column:
    """The maximal runs of letters, A-Z lower-cased; of a text without any, one empty string."""
    return F.split(F.btrim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), "[^a-zÀ-ÿ]+", " ")), " ")


def vocabulary(docs: DataFrame, length: int = LENGTH, times: int = TIMES, loses: int | None = LOSES) -> DataFrame:
    """(word, n): the words of the texts with how often they occur. With ``loses`` one in so many runs, by the
    crc32 of `<doc_id>:<run>`, lacks one character."""
    runs = docs.select("doc_id", F.explode(runs_of(F.col("text"))).alias("run")).filter(F.length("run") >= length)
    if loses:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
        at = F.pmod(h, F.length("run")).cast("int")
        less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        runs = runs.select(F.when(F.pmod(h, F.lit(loses)) == 0, less).otherwise(F.col("run")).alias("run"))
    return runs.filter(F.length("run") >= length).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).filter(F.col("n") >= times)


def _code(c: int) -> int:
    """A letter of the alphabet, a to z and U+00C0 to U+00FF, as a number from 1 to 90."""
    return c - 96 if c < 128 else c - 165


def _paths(word: bytes) -> tuple[list[int], list[bytes]]:
    """The numbers of a word's nodes from the root to ``DIRECT`` characters, and the hashes of the deeper ones' paths."""
    number, numbers = 0, [0]
    for c in word[:DIRECT]:
        number = number << 7 | _code(c)
        numbers.append(number)
    if len(word) <= DIRECT:
        return numbers, []
    path, deeper = xxhash.xxh3_128(word[:DIRECT]), []
    for i in range(DIRECT, len(word)):
        path.update(word[i:i + 1])
        deeper.append(path.digest())
    return numbers, deeper


def paths(words: DataFrame) -> DataFrame:
    """(word, n, near, far, near_back, far_back): numbers and hashes of the nodes on a word's two paths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            there, back = [_paths(w) for w in coded], [_paths(w[::-1]) for w in coded]
            numbers, hashes = pa.list_(pa.int64()), pa.list_(pa.binary())
            yield pa.RecordBatch.from_arrays([
                batch.column("word"), batch.column("n"), pa.array([p[0] for p in there], numbers), pa.array([p[1] for p in there], hashes),
                pa.array([p[0] for p in back], numbers), pa.array([p[1] for p in back], hashes)], names=["word", "n", "near", "far", "near_back", "far_back"])
    return words.select("word", "n").mapInArrow(run, "word string, n long, near array<long>, far array<binary>, near_back array<long>, far_back array<binary>")


def numbered(words: DataFrame) -> DataFrame:
    """(word, n, ahead, behind): the numbers of all nodes on a word's path and on its reversed path, the root first."""
    told = stored(paths(words))
    deep = told.select("word", F.posexplode("far").alias("i", "path"), F.lit(False).alias("back")).unionByName(
        told.select("word", F.posexplode("far_back").alias("i", "path"), F.lit(True).alias("back")))
    # the dictionary: one trie's nodes and the other's may share a number, as they never meet
    nodes = stored(deep.select("path").distinct().select("path", (-1 - F.monotonically_increasing_id()).alias("node")))
    found = deep.join(nodes, "path").groupBy("word").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("back") == back, F.struct("i", "node")))).alias(name) for name, back in (("deep", False), ("deep_back", True))])
    joined = told.select("word", "n", "near", "near_back").join(found, "word", "left")
    none = F.expr("cast(array() as array<long>)")
    return joined.select("word", "n", F.concat("near", F.coalesce(F.col("deep.node"), none)).alias("ahead"), F.concat("near_back", F.coalesce(F.col("deep_back.node"), none)).alias("behind"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): of every word with near ones how many, and the most frequent (of equals the
    first in code-point order) as (less, word) with less = -n."""
    w = numbered(words).withColumn("size", F.length("word"))
    letter = lambda i: F.substring("word", i + 1, F.lit(1))
    skipped = F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.struct(
        F.get("ahead", i).alias("p"), F.get("behind", F.col("size") - 1 - i).alias("s"), F.lit(True).alias("skip"), ((i == 0) | (letter(i) != letter(i - 1))).alias("first")))
    parted = F.transform(F.sequence(F.lit(0), F.col("size")), lambda i: F.struct(
        F.get("ahead", i).alias("p"), F.get("behind", F.col("size") - i).alias("s"), F.lit(False).alias("skip"), F.lit(False).alias("first")))
    pairs = w.select("word", (-F.col("n")).alias("less"), F.explode(F.concat(skipped, parted)).alias("e"))
    groups = pairs.groupBy("e.p", "e.s").agg(F.collect_list(F.struct("less", "word", "e.skip", "e.first")).alias("ms")).filter(F.size("ms") > 1)
    met = once(groups, "m", F.col("ms")).select(F.explode("m").alias("me"), "m")
    others = F.filter("m", lambda o: (F.col("me.skip") & o["skip"] & (o["word"] != F.col("me.word"))) | (F.col("me.skip") & ~o["skip"] & F.col("me.first")) | (~F.col("me.skip") & o["skip"] & o["first"]))
    told = once(met, "others", F.transform(others, lambda o: F.struct(o["less"].alias("less"), o["word"].alias("word")))).filter(F.size("others") > 0)
    return told.select("me.word", F.size("others").alias("k"), F.array_min("others").alias("b")).groupBy("word").agg(F.sum("k").alias("n_near"), F.min("b").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form: where following forms ends. ``forms``: (word, form)."""
    now = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")))
    while now.filter("open").limit(1).count():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")))
    return now.select("word", "root")


def group(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``words`` (word, n; each word once): word, form, root, n, n_near, form_n."""
    words = stored(words)
    best = words.join(near_words(words), "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    told = stored(best.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                              F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")))
    rooted = told.join(roots(told.filter("form is not null")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

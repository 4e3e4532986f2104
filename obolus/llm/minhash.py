"""Near-duplicates by min-max hashing: of each permutation both the smallest and the largest value
are kept, so ``PERMUTATIONS`` hash evaluations give twice as many signature values, two of nearly
independent and equal odds (the Jaccard similarity) to agree. Four values make a band.

1. Signatures, and a 128-bit hash of the whole set, in the tasks. Equal sets become one node, known by that
   hash; copies are not linked one by one, and an id on several texts stands for several nodes.
2. Nodes that share a band are a bucket. Its pivot is the node that meets the most others in all its
   buckets (then the greatest hash), which is in the middle of its family. Every other node is compared
   with the pivot only, on full sets: no pairs within the bucket. A pivot with many members gets as
   many tasks as it needs, its set in each.
3. What the pivot cannot show: a node x below the threshold with pivot p may still be linked to
   another member y. With a = what a node lacks of p and b = what it has beyond p, x and y share
   |p| - |a_x u a_y| + |b_x n b_y|. A link shares threshold |x| or more, so the added shingles they
   share are at least m_x = threshold |x| - |x n p|, and m_y. If b_x and b_y are disjoint (both m at most
   0) and |a_x n a_y| <= |b_y|, then y shares no more with x than p does, and their union is no
   smaller: x and y are not linked. So partners of x either share an added shingle with it, or, both
   lying in p for the most part and y having lost more than it gained, |b_y| + 1 lost ones. Both are
   found by joins on single shingles with prefix filters (the rarest |b_x| - m_x + 1, and any |a_y| -
   |b_y|). Rows carry 256-bit maps of a and b: bits of one that the other lacks bound what the two can
   share, within the join, and pairs that pass are counted on the full differences. Members that are
   all linked to their pivot, or that links to pivots have brought together, need none of this.
4. Connected components of the links (``components``); the smallest doc_id of its sets names each.

A link between nodes that share no band is missed. Of two sets at the threshold 0.85 that happens
with (1 - 0.85 ** 4) ** 24 = 2e-8, at 0.8 with 3e-6, farther up less.

Defined results: words are `[^\\x20\\x09-\\x0D]+` after A-Z is lower-cased; a text of fewer words than a
shingle has them all as its one shingle; null and empty texts have none and are linked with nothing;
equal sets are linked. A row without doc_id belongs to the component of its equal set, or to none.
Repeated rows get the same result each. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obolus.llm.common import by_batch, frames, stored
from obolus.llm.components import connected

PERMUTATIONS, BAND = 48, 4
BANDS = 2 * PERMUTATIONS // BAND
#: Members of a pivot that one task compares.
CHUNK = 512
#: Shingles hashed at once, so that a very long text needs no more memory than its set.
PIECE = 4096
#: Columns of the bitmaps of what a member has beyond its pivot and lacks of it.
ADDED_BITS, REMOVED_BITS = [f"added_{i}" for i in range(4)], [f"removed_{i}" for i in range(4)]
#: Distinct words whose hashes a task remembers.
KNOWN = 100_000

_M = np.uint64(0x9E3779B97F4A7C15)
_words: dict[bytes, int] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _M
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of a text as 64-bit hashes, ascending."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_words) > KNOWN:
        _words.clear()
    for w in set(words):
        if w not in _words:
            _words[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        out = _mixed(out + h[j:len(words) - size + 1 + j])
    return np.unique(out)


def _keys() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64)


def bands_of(s: np.ndarray, times: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """The band hashes of a set that is not empty."""
    low, high = np.full(PERMUTATIONS, ~np.uint64(0)), np.zeros(PERMUTATIONS, np.uint64)
    for i in range(0, len(s), PIECE):
        x = s[i:i + PIECE, None] * times + plus
        low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
    values = np.stack([low, high], axis=1).reshape(BANDS, BAND)
    out = np.arange(BANDS, dtype=np.uint64)
    for j in range(BAND):
        out = _mixed(out + values[:, j])
    return out.view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, set, bands): the number of shingles, a 128-bit hash of the set, the band hashes (null for no shingle)."""
    times, plus = _keys()

    def run(b: pd.DataFrame) -> pd.DataFrame:
        sets = [shingles(t, size) for t in b["text"]]
        return pd.DataFrame({"doc_id": b["doc_id"], "n": [len(s) for s in sets], "set": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                             "bands": [bands_of(s, times, plus) if len(s) else None for s in sets]})
    return by_batch(docs.select("doc_id", "text"), run, "doc_id long, n long, set binary, bands array<long>")


def roles(nodes: DataFrame) -> DataFrame:
    """(node, set, pivot, chunk, first, many): for each pivot (a set) its members, and itself (``first``) once
    for every chunk of them, with an id that has the set. ``many``: it has more than one member."""
    banded = nodes.select("node", "set", F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    met = stored(banded.join(sizes, "band"))
    # the member that meets the most others stands in the middle of its family: the fewest are far from it
    middle = met.groupBy("set").agg(F.sum("size").alias("meets"))
    tops = met.select("band", "set").join(middle, "set").groupBy("band").agg(F.max(F.struct("meets", "set")).alias("top"))
    members = met.join(tops.select("band", F.col("top.set").alias("pivot")), "band").filter(F.col("set") != F.col("pivot")).select("pivot", "node", "set").distinct()
    counts = members.groupBy("pivot").agg(F.count("*").alias("members")).withColumn("chunks", F.ceil(F.col("members") / CHUNK))
    own = members.join(counts, "pivot").select("node", "set", "pivot", F.pmod(F.xxhash64("set"), F.col("chunks")).alias("chunk"), F.lit(False).alias("first"),
                                              (F.col("members") > 1).alias("many"))
    first = counts.join(nodes.select("node", F.col("set").alias("pivot")), "pivot").select(
        "node", F.col("pivot").alias("set"), "pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(True).alias("first"), (F.col("members") > 1).alias("many"))
    return own.unionByName(first)


def _bitmap(s: np.ndarray | None) -> list[int]:
    """256 bits as four integers: which low bytes occur in a set of hashes."""
    on = np.zeros(256, bool)
    if s is not None:
        on[s & 255] = True
    return np.packbits(on).view(np.int64).tolist()


def compare(docs: DataFrame, asked: DataFrame, size: int, percent: int) -> DataFrame:
    """(pivot, doc, n, n_pivot, linked, added, removed, and their bitmaps): each member (``doc``, a set like the
    pivot) against its pivot, on full sets. The differences are there only where a pivot has more than one member."""
    texts = asked.join(docs.select(F.col("doc_id").alias("node"), "text"), "node")
    dealt = texts.repartition("pivot", "chunk").sortWithinPartitions("pivot", "chunk", F.col("first").cast("int").desc())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = np.zeros(0, np.uint64)
        for batch in batches:
            out = []
            for pivot, doc, first, many, text in zip(batch["pivot"], batch["set"], batch["first"], batch["many"], batch["text"]):
                s = shingles(text, size)
                if xxhash.xxh3_128_digest(s.tobytes()) != doc:  # another text under the same id
                    continue
                if first:
                    p = s
                    continue
                shared = len(np.intersect1d(s, p, assume_unique=True))
                linked = 100 * shared >= percent * (len(s) + len(p) - shared)
                far = [np.setdiff1d(s, p, True).view(np.int64), np.setdiff1d(p, s, True).view(np.int64)] if many else [None, None]
                out.append((pivot, doc, len(s), len(p), linked, *far, *[b for x in far for b in _bitmap(x)]))
            if out:
                yield pd.DataFrame(out, columns=["pivot", "doc", "n", "n_pivot", "linked", "added", "removed", *ADDED_BITS, *REMOVED_BITS])
    return frames(
        dealt.select("pivot", "set", "first", "many", "text"), run, "pivot binary, doc binary, n long, n_pivot long, linked boolean, added array<long>, removed array<long>, " + ", ".join(f"{b} long" for b in ADDED_BITS + REMOVED_BITS)).dropDuplicates(["pivot", "doc"])


def beyond_pivots(compared: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between two members of a pivot of which one at least is not linked to it, and that
    the links to pivots have not brought together (``part``: the component of a member by those)."""
    some = compared.filter("added is not null")
    parted = some.groupBy("pivot").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.bool_and("linked").alias("all")).filter("lo != hi and not all")
    some = some.join(parted.select("pivot"), "pivot", "left_semi")
    some = some.withColumns({"lost": F.size("removed"), "won": F.size("added")})
    some = some.withColumn("need", F.ceil(F.lit(percent) * F.col("n") / 100) - (F.col("n_pivot") - F.col("lost")))

    def side(name: str) -> list:
        """What the bound reads of a member, under its side's name."""
        return [F.col("doc").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("part", "n", "lost", "won", *ADDED_BITS, *REMOVED_BITS)]]

    def near() -> Column:
        """False only for pairs of one part, and those whose maps show that they share too little. Kept
        short: the JVM compiles no method of more than 8,000 bytes of code."""
        beyond = lambda of, without, bits: sum(F.bit_count(F.col(f"{b}_{of}").bitwiseAND(F.bitwise_not(F.col(f"{b}_{without}")))) for b in bits)
        gone = F.greatest(F.col("lost_x") + beyond("y", "x", REMOVED_BITS), F.col("lost_y") + beyond("x", "y", REMOVED_BITS))
        both = F.least(F.col("won_x") - beyond("x", "y", ADDED_BITS), F.col("won_y") - beyond("y", "x", ADDED_BITS))
        return (F.col("part_x") != F.col("part_y")) & ((100 + percent) * (F.col("n_pivot") - gone + both) >= percent * (F.col("n_x") + F.col("n_y")))

    # shared additions: of those that other members have too, x gives the rarest that it cannot do without, y all
    won = some.select("pivot", "doc", F.explode("added").alias("s"))
    common = won.groupBy("pivot", "s").agg(F.count("*").alias("times")).filter("times > 1")
    shared = won.join(common, ["pivot", "s"]).groupBy("pivot", "doc").agg(F.array_sort(F.collect_list(F.struct("times", "s"))).alias("shared"))
    with_shared = some.join(shared, ["pivot", "doc"]).withColumn("common", F.transform("shared", lambda e: e["s"]))
    give = F.col("won") - F.greatest(F.lit(1), "need") + 1 - (F.col("won") - F.size("shared"))  # what only x has is the rarest and goes first
    x = with_shared.filter("not linked").withColumn("given", F.slice("common", F.lit(1), F.greatest(give, F.lit(0)).cast("int"))).select("pivot", "n_pivot", "given", *side("x"), F.explode("given").alias("s"))
    y = with_shared.select("pivot", "common", *side("y"), F.explode("common").alias("s"))
    met = (x["pivot"] == y["pivot"]) & (x["s"] == y["s"]) & near()
    # a pair comes at the smallest shingle it shares; inside a lambda, for the sake of that limit
    once = F.exists(F.array(F.lit(True)), lambda _: F.array_min(F.array_intersect("given", "common")) == x["s"])
    by_added = x.join(y, met & once).select(x["pivot"], "x", "y")
    # shared losses: y gives as many as it lost more than it gained, x all
    gone = some.filter("lost > won and need <= 0").select("pivot", *side("y"), F.explode(F.slice("removed", F.lit(1), F.col("lost") - F.col("won"))).alias("s"))
    lacks = some.filter("not linked and need <= 0").select("pivot", "n_pivot", *side("x"), F.explode("removed").alias("s"))
    by_lost = lacks.join(gone, (lacks["pivot"] == gone["pivot"]) & (lacks["s"] == gone["s"]) & near()).select(lacks["pivot"], "x", "y")
    pairs = by_added.unionByName(by_lost).distinct()
    full = lambda name: some.select("pivot", F.col("doc").alias(name), F.col("n").alias(f"n_{name}"), F.col("added").alias(f"b_{name}"), F.col("removed").alias(f"a_{name}"), "n_pivot")
    both = pairs.join(full("x"), ["pivot", "x"]).join(full("y").drop("n_pivot"), ["pivot", "y"])
    shared = (F.col("n_pivot") - F.size("a_x") - F.size("a_y") + F.size(F.array_intersect("a_x", "a_y")) + F.size(F.array_intersect("b_x", "b_y")))
    return both.filter(100 * shared >= percent * (F.col("n_x") + F.col("n_y") - shared)).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (the smallest id of each component).
    Two texts are linked when 100 * intersection >= percent * union of their sets of ``size``-word shingles."""
    signed = stored(signatures(docs, size))
    nodes = stored(signed.filter("n > 0").groupBy("set").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")).filter("node is not null"))
    compared = stored(compare(docs, roles(nodes), size, percent))
    parts = connected(compared.filter("linked").select(F.col("doc").alias("a"), F.col("pivot").alias("b")))
    compared = compared.join(parts.select(F.col("node").alias("doc"), "root"), "doc", "left").withColumn("part", F.coalesce("root", "doc")).drop("root")
    roots = connected(parts.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(beyond_pivots(compared, percent)))
    # components are of sets; the smallest id of any of them names each
    ids = nodes.select("set", "node").join(roots.select(F.col("node").alias("set"), "root"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    names = ids.groupBy("root").agg(F.min("node").alias("component_id"))
    named = ids.select("set", "root").join(names, "root").select("set", "component_id")
    some = signed.filter("n > 0").select("doc_id", "n", "set").join(named, "set", "left").select("doc_id", "n", "component_id")
    alone = signed.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return some.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those whose component has a smaller id, with their columns."""
    dropped = groups(docs, size, percent).filter("not kept").select(F.col("doc_id").alias("_dropped")).distinct()
    row = docs.select(F.struct("*").alias("_row"))
    return row.join(dropped, F.col("_row")["doc_id"] == F.col("_dropped"), "left_anti").select("_row.*")

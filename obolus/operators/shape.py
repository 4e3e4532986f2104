"""Skew-safe building blocks shared by views, gates and reports.

None of these gathers a group into one task: groups are pre-aggregated before the shuffle,
rankings are cut to k before it, and lookups meet at most one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds ``value`` computed once per row, however many later expressions read it: adjacent
    projections are merged and would repeat it, a generator is not merged into."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Column, largest: bool = True) -> DataFrame:
    """One row per key: the one with the largest (or smallest) ``order``. A hash aggregate with
    map-side combine, not a window over the whole group."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if largest else F.min_by
    return (df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rk") -> DataFrame:
    """The first ``k`` rows of each group. The filter on the rank lets Spark cut every task's
    share of a group to ``k`` rows before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def spread_nulls(key: Column, *salt: Column, parts: int = 4096) -> Column:
    """A string join key whose nulls match nothing and do not meet in one partition."""
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")),
                      F.concat(F.lit("n"), F.pmod(F.xxhash64(*salt), F.lit(parts)).cast("string")))


def lookup_left(left: DataFrame, right: DataFrame, key: str, *salt: str) -> DataFrame:
    """Left join on one nullable key that is unique on the right; null keys keep their rows and
    are spread over the partitions."""
    k = spread_nulls(F.col(key), *[F.col(s) for s in salt])
    r = right.withColumn("_k", F.concat(F.lit("k"), F.col(key).cast("string"))).drop(key)
    return left.withColumn("_k", k).join(r, "_k", "left").drop("_k")


#: A filter's words of 64 bits: so many in one row of its table, and at the most (32 MiB).
FILTER_BLOCK, FILTER_WORDS = 64, 1 << 22


def maybe_among(df: DataFrame, keys: Sequence[str], members: DataFrame, max_words: int = FILTER_WORDS) -> DataFrame:
    """``df`` with ``_maybe``: false for rows that meet none of ``members`` on ``keys`` for certain, so that only
    the others need be shuffled to meet them. A Bloom filter, each key's three bits in one word of it, whose size is
    bounded whatever the input, so it may be sent to every task; where it is too small for the members it lets more rows
    through and no row is lost. ``members`` is read twice: give what is cheap to read."""
    n_words = min(max_words, max(FILTER_BLOCK, 1 << (members.count() // 2).bit_length()))
    hashed = F.xxhash64(*keys)
    word = F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(n_words))
    places = [F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(3)]
    mask = F.lit(0).cast("long")
    for at in places:
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    words = members.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    packed = words.groupBy(F.floor(F.col("word") / FILTER_BLOCK).alias("_block")).agg(F.map_from_entries(F.collect_list(F.struct(F.pmod("word", F.lit(FILTER_BLOCK)).cast("int"), "mask"))).alias("m"))  # a block's words
    blocks = packed.select("_block", F.transform(F.sequence(F.lit(0), F.lit(FILTER_BLOCK - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))).alias("_words"))
    own = df.select("*", word.alias("_word"), mask.alias("_mask")).withColumn("_block", F.floor(F.col("_word") / FILTER_BLOCK))
    there = F.coalesce(F.element_at("_words", F.pmod("_word", F.lit(FILTER_BLOCK)).cast("int") + 1), F.lit(0).cast("long"))
    return own.join(F.broadcast(blocks), "_block", "left").select(*df.columns, (there.bitwiseAND(F.col("_mask")) == F.col("_mask")).alias("_maybe"))


def set_digest(hashes: Column) -> Column:
    """One hash for an array of hashes (distinct, sorted, newline-joined). For arrays whose size
    is bounded by construction; for groups of any size use ``group_digest``."""
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(hashes)), "\n"), 256)


def group_digest(df: DataFrame, keys: Sequence[str], hash_col: str, name: str = "digest") -> DataFrame:
    """One digest per group over the group's distinct SHA-256 values, whatever their number and
    order: the hashes' eight 32-bit lanes are summed, so partial sums combine before the shuffle
    and no group is ever gathered. A hash is shuffled as its 32 bytes; any other text as it is."""
    printed = F.col(hash_col).rlike(r"^[0-9a-f]{64}\z")
    packed = df.select(*keys, F.when(printed, F.unhex(hash_col)).alias("_b"), F.when(~printed, F.col(hash_col)).alias("_t")).distinct()
    h = F.coalesce(F.lower(F.hex("_b")), "_t")
    lanes = [F.sum(F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("decimal(20,0)")).alias(f"_l{i}")
             for i in range(8)]
    sums = packed.groupBy(*keys).agg(F.count("*").alias("_n"), *lanes)
    text = F.concat_ws(":", F.col("_n").cast("string"), *[F.col(f"_l{i}").cast("string") for i in range(8)])
    return sums.select(*keys, F.sha2(text, 256).alias(name))


def canonical_digest(*cols: str) -> Column:
    """SHA-256 of the row as JSON with sorted keys and no spaces."""
    return F.sha2(F.to_json(F.struct(*sorted(cols))), 256)


def top_share(totals: DataFrame, keys: Sequence[str], amount: str, tie: str, counts: Sequence[Column] = ()) -> DataFrame:
    """Concentration per group over one row per member: members, total, top-10 and top-1 share."""
    overall = totals.groupBy(*keys).agg(F.count("*").alias("n_suppliers"), *counts,
                                        F.sum(amount).alias("supplier_eur"))
    first = top_k(totals.select(*keys, tie, amount), keys, [F.col(amount).desc_nulls_last(), F.col(tie)], 10)
    best = first.groupBy(*keys).agg(F.sum(amount).alias("_top10"), F.max(F.when(F.col("rk") == 1, F.col(amount))).alias("_top1"))
    share = lambda c: F.try_divide(F.col(c).cast("double"), F.col("supplier_eur").cast("double"))
    return (overall.join(best, list(keys), "left")
            .withColumns({"top10_share": share("_top10"), "top1_share": share("_top1")}).drop("_top10", "_top1"))


def without_nearby(right: DataFrame, left: DataFrame, keys: Sequence[str], left_date: str, right_date: str,
                   days: int) -> DataFrame:
    """Rows of ``right`` with no row of ``left`` of the same keys within ``days`` (inclusive) of
    their date. Null keys match nothing and stay.

    Time is cut into buckets of ``days + 1``: a left date in the same bucket is always near; from
    the bucket before only its last date, from the one after only its first can be. So three
    facts per key and bucket decide, and the join meets at most one row per right row: a hot id
    costs no more than its distinct buckets."""
    width = days + 1
    bucket = lambda d: F.floor(F.datediff(F.col(d), F.lit("1970-01-01").cast("date")) / F.lit(width))
    have = (left.groupBy(*keys, bucket(left_date).alias("_b"))
            .agg(F.min(left_date).alias("_first"), F.max(left_date).alias("_last")))
    none = F.lit(None).cast("date")
    facts = F.explode(F.array(
        F.struct(F.col("_b").alias("b"), F.lit(True).alias("same"), none.alias("before"), none.alias("after")),
        F.struct((F.col("_b") + 1).alias("b"), F.lit(None).cast("boolean").alias("same"), F.col("_last").alias("before"), none.alias("after")),
        F.struct((F.col("_b") - 1).alias("b"), F.lit(None).cast("boolean").alias("same"), none.alias("before"), F.col("_first").alias("after"))))
    near = (have.select(*keys, facts.alias("f"))
            .groupBy(*[F.col(k).alias(f"_n_{k}") for k in keys], F.col("f.b").alias("_nb"))
            .agg(F.max("f.same").alias("_same"), F.max("f.before").alias("_before"), F.min("f.after").alias("_after")))
    r = right.withColumn("_b", bucket(right_date))
    cond = F.col("_b") == F.col("_nb")
    for k in keys:
        cond = cond & (r[k] == F.col(f"_n_{k}"))
    d = F.col(right_date)
    is_near = (F.coalesce(F.col("_same"), F.lit(False))
               | F.coalesce(F.col("_before") >= F.date_sub(d, days), F.lit(False))
               | F.coalesce(F.col("_after") <= F.date_add(d, days), F.lit(False)))
    return r.join(near, cond, "left").filter(~is_near).select(*right.columns)

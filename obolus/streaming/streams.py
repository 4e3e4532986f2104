"""The same operators over streams: landing with versions, seam de-duplication, the gate with its
quarantine, classification against static rules, totals with late edits, and the ±60-day check.

Stateful queries carry a watermark and run in append or update mode, so state is bounded by the
lateness allowed, not by the stream. Checkpoint folders are the caller's, on storage every executor can reach."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from obolus.operators import gates
from obolus.operators.classify import is_remittance, payee_class
from obolus.operators.shape import without_nearby
from obolus.sources.landing import land_versioned

c = F.col


#: Folders of a landed table by the hash of the key: a batch reads those that its keys fall into.
BUCKETS = 256


def land_stream(incoming: DataFrame, table: str, checkpoint: str, kind: str | None = None, buckets: int = BUCKETS) -> DataStreamWriter:
    """Land (key, digest, seq, ...) append-only below ``table``: each micro-batch is compared with
    what is landed by digest, so a replayed batch appends nothing, also from a new checkpoint.

    The table lies in folders by a bucket of the key. A batch reads key and digest of the buckets that its
    own keys fall into and no others; more buckets for a table that outgrows them."""
    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        df = df.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")).persist()
        try:
            touched = [r["bucket"] for r in df.select("bucket").distinct().collect()]  # as many as there are buckets
            rows = land_versioned(df, _landed(spark, table, df, touched), kind)
            rows.drop("outcome").write.mode("append").option("compression", "zstd").partitionBy("bucket").parquet(table)
        finally:
            df.unpersist()
    return incoming.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def _landed(spark, table: str, like: DataFrame, buckets: list[int]) -> DataFrame:
    """Keys and digests that are landed in some buckets; none before the first batch."""
    try:
        return spark.read.schema(like.schema).parquet(table).filter(c("bucket").isin(*buckets)).select("key", "digest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0).select("key", "digest")


def dedupe_stream(records: DataFrame, key: str, time: str, lateness: str) -> DataFrame:
    """The first sighting of each key; a repeat within ``lateness`` (a window's seam) is dropped."""
    return records.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])


def gate_stream(pages: DataFrame, accepted: str, quarantine: str, checkpoint: str,
                check: Callable[[DataFrame], DataFrame] = gates.check_page_records) -> DataStreamWriter:
    """Pages that pass go to ``accepted``, the others with their reasons to ``quarantine``."""
    def batch(df: DataFrame, _: int) -> None:
        checked = check(df).persist()
        try:
            ok, bad = gates.split_gate(checked)
            ok.write.mode("append").parquet(accepted)
            bad.write.mode("append").parquet(quarantine)
        finally:
            checked.unpersist()
    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def classify_stream(lines: DataFrame, family_ids: DataFrame) -> DataFrame:
    """Payment lines with their class: a stateless join with the registry's ids (``afm``)."""
    family = family_ids.select(c("afm").alias("_id"), F.lit(True).alias("_family"))
    out = lines.join(family, c("afm") == c("_id"), "left")
    klass = payee_class(c("name"), c("subject"), c("kae"), is_remittance(c("subject"), c("kae")), c("_family"))
    return out.withColumn("payee_class", klass).drop("_id", "_family")


def month_totals_stream(lines: DataFrame, keys: list[str], time: str, amount: str, lateness: str) -> DataFrame:
    """Totals by key and day, with the month. Late lines correct a day until the watermark has passed
    it. In update mode each batch gives the days it changed, and state is as long as ``lateness``."""
    month = F.date_format(F.trunc(time, "month"), "yyyy-MM")
    span = F.window(c(time), "1 day")
    daily = lines.withWatermark(time, lateness).groupBy(span, *keys, month.alias("month")).agg(F.count("*").alias("n"), F.sum(amount).alias("total"))
    return daily.select(F.to_date("window.start").alias("day"), *keys, "month", "n", "total")


def without_nearby_stream(right: DataFrame, left: DataFrame, keys: list[str], left_time: str, right_time: str, days: int, lateness: str) -> DataFrame:
    """Right rows with no left row of the same keys within ``days``. A row is given out when the
    watermark says nothing that near can still come; ``finish_without_nearby`` gives those that a
    stream still holds when it is stopped."""
    l = left.withWatermark(left_time, lateness).select(*[c(k).alias(f"_l_{k}") for k in keys], c(left_time).alias("_l_time"))
    r = right.withWatermark(right_time, lateness)
    near: Column = c("_l_time").between(c(right_time) - F.expr(f"INTERVAL {days} DAYS"), c(right_time) + F.expr(f"INTERVAL {days} DAYS"))
    for k in keys:
        near = near & (c(k) == c(f"_l_{k}"))
    return r.join(l, near, "leftOuter").filter(c("_l_time").isNull()).select(*right.columns)


def finish_without_nearby(given: DataFrame, right: DataFrame, left: DataFrame, keys: list[str], left_time: str, right_time: str, days: int, lateness_days: int) -> DataFrame:
    """The whole answer once the input has ended: what the stream gave out up to its last watermark,
    and the batch operator's answer for the rows after it. One date is read from the input."""
    last = [df.agg(F.max(t)).first()[0] for df, t in ((left, left_time), (right, right_time))]
    if None in last:
        return right
    horizon = min(last) - timedelta(days=days + lateness_days + 1)
    near = left.filter(c(left_time) >= F.lit(horizon - timedelta(days=days + 1))).withColumn("_day", F.to_date(left_time))
    late = right.filter(c(right_time) >= F.lit(horizon)).withColumn("_on", F.to_date(right_time))
    rest = without_nearby(late, near, keys, "_day", "_on", days).drop("_on")
    return given.filter(c(right_time) < F.lit(horizon)).unionByName(rest)

"""Append-only landing: versions by digest, content addressing, audit log, curated writes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obolus.functions.codes import valid_key
from obolus.operators.shape import group_digest
from obolus.session import written

c = F.col


def version_outcomes(incoming: DataFrame, landed: DataFrame) -> DataFrame:
    """Outcome of landing ``incoming`` (key, digest, seq, ...) on ``landed`` (key, digest):
    'new' for an unseen key, 'unchanged' for a digest already held as any version of the key,
    'changed' for another digest. Within one batch the order of ``seq`` decides.

    Firsts are aggregates per (key, digest) and per key, joined back: a key that arrives a
    million times is one row on the right side."""
    held = landed.select("key", "digest").distinct().withColumn("_held", F.lit(True))
    seen = landed.select("key").distinct().withColumn("_seen", F.lit(True))
    per_digest = incoming.groupBy("key", "digest").agg(F.min("seq").alias("_first_digest"))
    per_key = incoming.groupBy("key").agg(F.min("seq").alias("_first_key"))
    facts = (per_digest.join(held, ["key", "digest"], "left").join(seen, "key", "left").join(per_key, "key"))
    outcome = (F.when(c("_held").isNotNull() | (c("seq") > c("_first_digest")), F.lit("unchanged"))
               .when(c("_seen").isNull() & (c("seq") == c("_first_key")), F.lit("new"))
               .otherwise(F.lit("changed")))
    return incoming.join(facts, ["key", "digest"]).withColumn("outcome", outcome).select(*incoming.columns, "outcome")


def land_versioned(incoming: DataFrame, landed: DataFrame, kind: str | None = None) -> DataFrame:
    """Rows to append (new and changed). Keys of the wrong shape never land."""
    ok = incoming if kind is None else incoming.filter(valid_key(c("key"), kind))
    return version_outcomes(ok, landed).filter(c("outcome") != "unchanged")


def refused_keys(incoming: DataFrame, kind: str) -> DataFrame:
    """The quarantine side of ``land_versioned``."""
    return incoming.filter(~valid_key(c("key"), kind))


def content_digest(body: Column, volatile: Sequence[str] = ()) -> Column:
    """Digest of a struct less its volatile fields, as canonical JSON."""
    return F.sha2(F.to_json(body.dropFields(*volatile) if volatile else body), 256)


def land_content_addressed(incoming: DataFrame, landed: DataFrame, body: str, volatile: Sequence[str] = ()) -> DataFrame:
    """One row per body not yet held: the first by ``seq`` of each digest."""
    d = incoming.withColumn("digest", content_digest(c(body), volatile))
    rest = [x for x in d.columns if x != "digest"]
    first = d.groupBy("digest").agg(F.min_by(F.struct(*rest), "seq").alias("_r"))
    return first.join(landed.select("digest"), "digest", "left_anti").select("digest", *[c(f"_r.{x}").alias(x) for x in rest])


def first_captures(landed: DataFrame, order: str = "captured_at") -> DataFrame:
    """The first version of every key (a hash aggregate)."""
    rest = [x for x in landed.columns if x != "key"]
    return (landed.groupBy("key").agg(F.min_by(F.struct(*rest), F.struct(order, "digest")).alias("_r"))
            .select("key", *[c(f"_r.{x}").alias(x) for x in rest]))


def find_by_key(landed: DataFrame, keys: DataFrame) -> DataFrame:
    """First captures of the asked keys; the filter comes before the aggregate."""
    return first_captures(landed.join(keys.select("key").distinct(), "key", "left_semi"))


def append_audit(records: DataFrame, path: str) -> None:
    """Append run records with their UTC time."""
    records.withColumn("ts", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).write.mode("append").json(path)


def read_audit(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema + ", ts string").json(path)


# the order every curated table is kept in
SORT_KEYS: dict[str, tuple[str, ...]] = {
    "act": ("entity", "date", "ada"), "payment": ("entity", "date", "payment_id"), "commitment": ("entity", "date", "commitment_id"),
    "award": ("entity", "date", "award_id"), "counterparty": ("afm",), "entity": ("uid",),
    "budget_line": ("entity", "period_end", "side", "service", "kae"), "procurement": ("entity", "endpoint", "ref"),
    "procurement_party": ("entity", "endpoint", "ref", "role", "afm"), "grant_decision": ("date", "ada"),
    "grant_line": ("date", "grant_line_id"), "acceptance": ("entity", "date", "ada"),
}


def write_curated(df: DataFrame, path: str, keys: Iterable[str], columns: Sequence[str] | None = None,
                  partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """The table in its declared columns, range-partitioned and sorted by its keys, zstd. Row
    groups then carry narrow key ranges, so later filters on the keys skip most of the file."""
    keys = [k for k in keys if k in df.columns]
    out = df.select(*columns) if columns else df
    # the folders' columns come first: the writer would sort by them again and lose the order of the keys
    out = out.repartitionByRange(*[c(k) for k in keys]).sortWithinPartitions(*partition_by, *keys) if keys else out
    writer = out.write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def stamp_lineage(df: DataFrame, derived_at: Column, version: str) -> DataFrame:
    """When and by which version a row was derived."""
    return df.withColumns({"derived_at": derived_at, "pipeline_version": F.lit(version)})


def stored_release(release, tables: Sequence[str] | None = None):
    """The release with each of ``tables`` (none given: all) written to the shared folder when a view first asks for it:
    what several views, counts or a manifest read is derived once. Leave out those that lie there as they are, or
    that are columns of what does."""
    from obolus.plans.views import Release
    held: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if tables is not None and name not in tables:
            return getattr(release, name)
        if name not in held:
            held[name] = written(getattr(release, name))
        return held[name]
    return Release(table, home=release.home)


def register_release(spark: SparkSession, release, meta: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """Temp views for the 12 tables and the 29 views (and ``meta``); returns the row counts of all of
    them as one frame (table, n), one aggregate each. Give it a ``stored_release`` where tables are derived."""
    from obolus.plans.views import TABLES, VIEWS
    counts = None
    for name in (*TABLES, *VIEWS):
        df = getattr(release, name) if name in TABLES else release.view(name)
        df.createOrReplaceTempView(prefix + name)
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        counts = one if counts is None else counts.unionByName(one)
    if meta is not None:
        meta.createOrReplaceTempView(prefix + "meta")
    return counts


#: What a manifest counts by: table and column.
TALLIES = {"payment": ("payee_class", "payroll_kind"), "grant_line": ("validation",), "grant_decision": ("read_status",), "procurement": ("endpoint",), "procurement_party": ("role",)}


def build_manifest(release, excluded_pending: DataFrame | None = None, sources: DataFrame | None = None, refused: DataFrame | None = None, settings: dict[str, object] | None = None,
                   views: tuple[str, ...] = ()) -> DataFrame:
    """(metric, key, value): rows per table, lines by class, validation, endpoint and role, all counts of a table
    from one pass over it; and where given: acts left out as pending (type, n), the number and set digest of
    the source documents (sha256), refused documents by reason (doc_id, reason), the rules' settings,
    and rows per view."""
    from obolus.plans.views import TABLES
    spark = release.act.sparkSession
    told = lambda metric, key, value: F.struct(F.lit(metric).alias("metric"), key.cast("string").alias("key"), value.cast("bigint").alias("value"))
    one = F.lit(1)
    counts = spark.createDataFrame([("rows", t, 0) for t in TABLES], "metric string, key string, value bigint")  # a table without rows has its count, too
    for t in TABLES:
        each = [told("rows", F.lit(t), one), *[told(f"{t}.{col}", F.coalesce(c(col), F.lit("none")), one) for col in TALLIES.get(t, ())]]
        counts = counts.unionByName(getattr(release, t).select(F.explode(F.array(*each)).alias("x")).select("x.*"))
    if excluded_pending is not None:
        counts = counts.unionByName(excluded_pending.select(told("excluded_pending", c("type"), c("n")).alias("x")).select("x.*"))
    if refused is not None:
        counts = counts.unionByName(refused.select(told("refused", c("reason"), one).alias("x")).select("x.*"))
    if sources is not None:
        counts = counts.unionByName(sources.select(told("sources", F.lit("count"), one).alias("x")).select("x.*"))
    for name in views:
        counts = counts.unionByName(release.view(name).select(told("view_rows", F.lit(name), one).alias("x")).select("x.*"))
    out = counts.groupBy("metric", "key").agg(F.sum("value").cast("string").alias("value"))
    if sources is not None:
        digest = group_digest(sources.select(F.lit("digest").alias("key"), "sha256"), ["key"], "sha256", "value")
        out = out.unionByName(digest.select(F.lit("sources").alias("metric"), "key", "value"))
    if settings:
        out = out.unionByName(spark.createDataFrame([("setting", k, str(v)) for k, v in settings.items()], "metric string, key string, value string"))
    return out

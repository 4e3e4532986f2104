"""Quality gates over landed pages and windows: what the executed search must have been, and
what to do with a page that is not it. Row-local checks stay row-local (no shuffle); counts are
two-step aggregates, so a window holding most records is no hot task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.functions.codes import iso_day, valid_key
from obolus.functions.text import issue_day
from obolus.operators.shape import lookup_left

c = F.col


# ---- planning windows -----------------------------------------------------------------------------
def plan_windows_halfopen(spans: DataFrame, start: str, end: str, days: int, clamp: int) -> DataFrame:
    """Half-open windows [window_from, window_to) of at most ``days`` covering [start, end]."""
    if days > clamp:
        raise ValueError(f"{days} days exceed the {clamp}-day clamp")
    stop = F.date_add(end, 1)
    starts = F.explode(F.sequence(c(start), c(end), F.expr(f"INTERVAL {days} DAYS")))
    return spans.withColumn("window_from", starts).withColumn("window_to", F.least(F.date_add("window_from", days), stop))


def plan_windows_inclusive(spans: DataFrame, start: str, end: str, days: int, clamp: int) -> DataFrame:
    """Consecutive inclusive windows: ``days`` apart, no gap, no overlap."""
    if days > clamp:
        raise ValueError(f"{days} days exceed the {clamp}-day clamp")
    starts = F.explode(F.sequence(c(start), c(end), F.expr(f"INTERVAL {days + 1} DAYS")))
    return spans.withColumn("window_from", starts).withColumn("window_to", F.least(F.date_add("window_from", days), c(end)))


def plan_year_halves(spans: DataFrame, start: str, end: str) -> DataFrame:
    """Per calendar year: the span clipped to the range, and its half-year windows."""
    day = lambda y, m, d: F.make_date(y, F.lit(m), F.lit(d))
    y = c("year")
    years = spans.withColumn("year", F.explode(F.sequence(F.year(start), F.year(end))))
    halves = F.explode(F.array(F.struct(day(y, 1, 1).alias("a"), day(y, 6, 30).alias("b")), F.struct(day(y, 7, 1).alias("a"), day(y, 12, 31).alias("b"))))
    out = years.withColumns({"span_from": F.greatest(c(start), day(y, 1, 1)), "span_to": F.least(c(end), day(y, 12, 31))}).withColumn("_h", halves)
    return (out.withColumns({"window_from": F.greatest(c("span_from"), c("_h.a")), "window_to": F.least(c("span_to"), c("_h.b"))})
            .drop("_h").filter(c("window_from") <= c("window_to")))


# ---- pages against their request ---------------------------------------------------------------------
def reasons(*pairs: tuple[Column, Column | str]) -> Column:
    """Array of the messages whose condition holds (a null condition counts as a violation)."""
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), m if isinstance(m, Column) else F.lit(m)) for bad, m in pairs]))


def split_gate(df: DataFrame, problems: str = "problems") -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined)."""
    bad = F.size(problems) > 0
    return df.filter(~bad).drop(problems), df.filter(bad)


def parse_echo(q: Column) -> dict[str, Column]:
    got = lambda p, i: F.nullif(F.regexp_extract(q, p, i), F.lit(""))
    return {"org": got(fv.ECHO_ORG, 1), "issue_from": F.substring(got(fv.ECHO_BOUNDS, 1), 1, 10),
            "issue_to": F.substring(got(fv.ECHO_BOUNDS, 2), 1, 10), "status": got(fv.ECHO_STATUS, 1)}


def check_echo(pages: DataFrame, query: str = "query") -> DataFrame:
    """Adds ``problems``: the executed organisation, bounds, status and page against the request
    (org, date_from, date_to, status_all, page, returned_page)."""
    e = parse_echo(c(query))
    none = F.coalesce(c(query), F.lit("")) == ""
    differs = lambda got, want: ~got.eqNullSafe(want)
    want_status = F.when(~c("status_all"), F.lit(fv.ECHO_PUBLISHED))
    found = reasons((differs(e["org"], c("org")), "org"), (differs(e["issue_from"], c("date_from").cast("string")), "issue_from"),
                    (differs(e["issue_to"], c("date_to").cast("string")), "issue_to"), (differs(e["status"], want_status), "status"),
                    (F.coalesce(c("returned_page") != c("page"), F.lit(False)), "page"))
    return pages.withColumn("problems", F.when(none, F.array(F.lit("no_echo"))).otherwise(found))


def _per_record(records: Column, check) -> Column:
    return F.flatten(F.transform(records, check))


def check_page_records(pages: DataFrame) -> DataFrame:
    """Adds ``problems`` to procurement pages (doc, org, date_from, date_to, page): envelope, page
    number, and each record's organisation, reference and date."""
    doc = c("doc")
    envelope = doc["content"].isNull() | doc["totalElements"].isNull()
    lo, hi = c("date_from").cast("string"), c("date_to").cast("string")

    def record(r: Column) -> Column:
        day = F.coalesce(F.substring(r["submissionDate"], 1, 10), F.lit(""))
        return F.array_compact(F.array(
            F.when(F.coalesce(r["referenceNumber"], F.lit("")) == "", F.lit("no_reference")),
            F.when(~r["organization"]["key"].eqNullSafe(c("org")), F.lit("organisation")),
            F.when((day < lo) | (day > hi), F.lit("outside_window"))))

    page = F.array_compact(F.array(F.when(~doc["number"].eqNullSafe(c("page")), F.lit("page"))))
    return pages.withColumn("problems", F.when(envelope, F.array(F.lit("not_a_page"))).otherwise(
        F.concat(page, F.coalesce(_per_record(doc["content"], record), F.array().cast("array<string>")))))


def issuers_of(r: Column) -> Column:
    co = F.coalesce(F.transform(r["cooperatingOrganizations"], lambda x: x["uid"]), F.array().cast("array<string>"))
    return F.array_compact(F.concat(F.array(r["organization"]["uid"]), co))


def check_search_page(pages: DataFrame) -> DataFrame:
    """Adds ``problems`` to search pages (doc, org, date_from, date_to, page, size)."""
    doc, info = c("doc"), c("doc.info")
    envelope = info.isNull() | doc["decisions"].isNull() | info["total"].isNull()
    n = F.size(doc["decisions"])
    keys = F.transform(doc["decisions"], lambda r: r["ada"])
    good = F.filter(keys, lambda k: valid_key(k, "decision"))

    def record(r: Column) -> Column:
        day = issue_day(r["issueDate"])
        safe = valid_key(r["ada"], "decision")
        return F.array_compact(F.array(
            F.when(~safe, F.lit("unusable_key")),
            F.when(safe & ~F.coalesce(F.array_contains(issuers_of(r), c("org")), F.lit(False)), F.lit("issuer")),
            F.when(safe & day.isNull(), F.lit("unreadable_date")),
            F.when(safe & ((day < c("date_from")) | (day > c("date_to"))), F.lit("outside_window"))))

    marks = F.coalesce(F.map_keys(doc["highlighting"]), F.array().cast("array<string>"))
    page = reasons((info["query"].isNotNull(), "echo_appeared"), (~info["page"].eqNullSafe(c("page")), "page"),
                   (~info["size"].eqNullSafe(c("size")), "size"),
                   (~info["actualSize"].eqNullSafe(n) | (n > c("size")), "actual_size"),
                   (F.size(F.array_distinct(good)) != F.size(good), "repeated_key"),
                   (F.size(F.array_except(marks, good)) > 0, "stray_highlight"))
    return pages.withColumn("problems", F.when(envelope, F.array(F.lit("not_a_page"))).otherwise(F.concat(page, _per_record(doc["decisions"], record))))


# ---- counts over pages ----------------------------------------------------------------------------------
def check_paging(records: DataFrame, window: list[str]) -> DataFrame:
    """Per window: its total held over its pages, and as many distinct keys as the total says.
    ``records``: window columns, key, total."""
    keys = records.groupBy(*window, "key").agg(F.min("total").alias("lo"), F.max("total").alias("hi"))
    return (keys.groupBy(*window).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("key").alias("n_keys"))
            .select(*window, c("hi").alias("total"), "n_keys", (c("lo") == c("hi")).alias("total_held"), (c("n_keys") == c("hi")).alias("complete")))


def check_control_count(counts: DataFrame, window: list[str], control: str) -> DataFrame:
    """A term must change the count against the control term's, unless both found nothing."""
    base = counts.filter(c("term") == control).select(*window, c("total").alias("control_total"))
    return (counts.filter(c("term") != control).join(base, window)
            .withColumn("accepted", (c("total") != c("control_total")) | ((c("total") == 0) & (c("control_total") == 0))))


def check_rollup_counts(whole: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """A whole span's total must be the sum of its windows' totals."""
    parts = windows.groupBy(*keys).agg(F.sum("total").alias("window_total"))
    return (whole.select(*keys, "total").join(parts, keys, "full")
            .withColumn("accepted", F.coalesce(c("total") == c("window_total"), F.lit(False))))


def dedupe_seams(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Each record with its fate: 'first', 'dup' (also in an earlier window) or 'no_key'. The first
    sighting per key is an aggregate joined back."""
    o = F.struct(*order)
    first = records.filter(c(key).isNotNull()).groupBy(key).agg(F.min(o).alias("_first"))
    fate = F.when(c(key).isNull(), F.lit("no_key")).when(o == c("_first"), F.lit("first")).otherwise(F.lit("dup"))
    salt = [x for x in order if x != key] or list(order)
    return lookup_left(records, first, key, *salt).withColumn("fate", fate).drop("_first")


def window_tallies(records: DataFrame, window: list[str]) -> DataFrame:
    """Per window: records by outcome and by status. ``records``: window, outcome, status."""
    n = lambda o: F.count_if(c("outcome") == o).alias(f"n_{o}")
    return records.groupBy(*window, "status").agg(*[n(o) for o in ("new", "changed", "unchanged", "dup")], F.count("*").alias("n"))


# ---- privacy of pages --------------------------------------------------------------------------------------
def redact_page_records(pages: DataFrame, doc: str, keep: str) -> DataFrame:
    """Records outside the ``keep`` array keep only what the gates check, and say so; highlights
    stay only for kept keys."""
    d = c(doc)
    none = F.lit(None).cast("string")

    def cut(r: Column) -> Column:
        bare = r.withField("subject", none).withField("protocolNumber", none).withField("submissionTimestamp", none) \
            .withField("decisionType", F.lit(None).cast("struct<uid:string,label:string>")).withField("documentUrl", none) \
            .withField("organization", F.struct(r["organization"]["uid"].alias("uid"), none.alias("label"))).withField("redacted", F.lit(True))
        return F.when(F.array_contains(c(keep), r["ada"]), r).otherwise(bare)

    marks = F.map_filter(d["highlighting"], lambda k, _: F.array_contains(c(keep), k))
    return pages.withColumn(doc, d.withField("decisions", F.transform(d["decisions"], cut)).withField("highlighting", marks))


def purge_plan(personal: DataFrame, pages: DataFrame, holdings: DataFrame) -> dict[str, DataFrame]:
    """What a purge of ``personal`` (ada) deletes and what blocks it. ``pages`` (page_id, slot) are
    the captures; ``holdings`` (page_id, ada) the records a page holds whole. A page goes only when
    a later capture of its slot, holding nothing personal whole, is stored; pages of the slots in
    ``blocked`` stay, and so do the records that such a page holds whole."""
    doomed = holdings.join(personal.select("ada").distinct(), "ada", "left_semi").select("page_id").distinct()
    slots = (pages.join(doomed.withColumn("_doomed", F.lit(1)), "page_id", "left").groupBy("slot")
             .agg(F.count("*").alias("captures"), F.sum(F.coalesce("_doomed", F.lit(0))).alias("doomed")))
    blocked = slots.filter((c("doomed") > 0) & (c("captures") == c("doomed"))).select("slot", "captures")
    held = pages.join(blocked.select("slot"), "slot", "left_semi").join(doomed, "page_id", "left_semi").select("page_id").distinct()
    waiting = holdings.join(held, "page_id", "left_semi").select("ada").distinct()
    return {"pages": pages.join(doomed, "page_id", "left_semi").join(held, "page_id", "left_anti"), "blocked": blocked,
            "records": personal.select("ada").distinct().join(waiting, "ada", "left_anti")}


# ---- status of the landing zone -------------------------------------------------------------------------------
def landing_status(files: DataFrame, keys: list[str], key: str) -> DataFrame:
    """Files and distinct keys per group, in two steps."""
    return (files.groupBy(*keys, key).agg(F.count("*").alias("n")).groupBy(*keys)
            .agg(F.sum("n").alias("n_files"), F.count(key).alias("n_keys")))


def last_record(audit: DataFrame) -> DataFrame:
    """Runs and the last record of the audit log, one row."""
    per_run = audit.groupBy("run").agg(F.count("*").alias("n"), F.max(F.struct("ts", "org", "status")).alias("last"))
    return per_run.agg(F.count("run").alias("n_runs"), F.sum("n").alias("n_records"), F.max("last").alias("l")).select(
        "n_runs", "n_records", c("l.ts").alias("last_ts"), c("l.org").alias("last_org"), c("l.status").alias("last_status"))


def document_coverage(decisions: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept decisions and how many have their document, by issuer and year; the decisions without)."""
    held = documents.select("ada").distinct().withColumn("_h", F.lit(1))
    joined = decisions.join(held, "ada", "left")
    return (joined.groupBy("issuer", "year").agg(F.count("*").alias("n_kept"), F.count("_h").alias("n_with_document")),
            joined.filter(c("_h").isNull()).drop("_h"))


def registry_drift(registry: DataFrame, source: DataFrame) -> DataFrame:
    """Registry rows that differ from the source's list, with what differs."""
    s = source.select(c("uid"), *[c(x).alias(f"s_{x}") for x in ("afm", "parent", "category", "name")], F.lit(True).alias("_s"))
    differs = lambda x: c(x).isNotNull() & ~c(x).eqNullSafe(c(f"s_{x}"))
    out = registry.join(s, "uid", "left").withColumn("drift", F.when(c("_s").isNull(), F.array(F.lit("missing"))).otherwise(
        reasons(*[(differs(x), x) for x in ("afm", "parent", "category", "name")])))
    return out.filter(F.size("drift") > 0).select("uid", "drift")


def scope_guard(requests: DataFrame, registry: DataFrame, key: str = "uid") -> tuple[DataFrame, DataFrame]:
    """(requests for bodies in scope, the others with the reason)."""
    r = registry.select(c("uid").alias(key), "in_scope")
    j = requests.join(r, key, "left")
    why = F.when(c("in_scope").isNull(), F.lit("unknown")).otherwise(F.lit("out_of_scope"))
    return j.filter(c("in_scope")).drop("in_scope"), j.filter(~F.coalesce("in_scope", F.lit(False))).withColumn("refused", why).drop("in_scope")

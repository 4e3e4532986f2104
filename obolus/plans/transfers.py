"""Tables of public-investment transfers: sections that end at a total, each checked against it, and
the rows of a section that pay a body of ours.

A document's lines are rows. Which amounts a section's total adds up is not known beforehand: there
are ranked candidates (the total's column, lines with a project code, numbered rows, everything from
the table's first row), each a set of cells summed by section; the first that adds up is taken, else
the first that has any, unvalidated. Windows and groups have the document, or a section of it, as
their partition."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.functions.money import amounts_at_locale, cents_eu, words_to_cents_lenient
from obolus.functions.text import flat_fold, fold, symbol_repair
from obolus.operators.rules import first_match
from obolus.operators.shape import once
from obolus.plans.documents import extract_validated_amounts
from obolus.plans.readers import WORDS_FIG

c = F.col

# ---- fixed values: amounts as «8.000,00» and as «8,000.00», totals, codes, rows ----------------------------
GREEK = fv.AMOUNT_EU
GREEK_THOUSANDS, ENGLISH_THOUSANDS = r"(?<![\d.,])\d{1,3}(?:\.\d{3})+,\d{2}(?![\d%])", r"(?<![\d.,])\d{1,3}(?:,\d{3})+\.\d{2}(?![\d%])"
TOTAL = "ΣΥΝΟΛ|ΣΤΝΟΛ"
STATED = rf"ΣΥΝΟΛΙΚΟΥ ΠΟΣΟΥ\s+({GREEK})"
PROJECT_CODE = r"20\d\d[Α-Ω]{2}\d{8}"
PAYMENT_LINE = r"^\s*\d{8,9}\s"
NUMBERED = r"^\s*\d{1,3}(?:\.\d{1,2})?\s"
#: Columns by which an amount may end beside its total, narrow first.
NEAR = (3, 8)
OUT = ("doc_id", "line", "amount", "recipient", "validation", "how")


class Payee(NamedTuple):
    """A body of ours in these tables: its tax id, its name's pattern on folded text, its project codes."""
    uid: str
    tax_id: str
    name: str
    codes: tuple[str, ...] = ()


def _named(folded: Column, payees: Sequence[Payee]) -> Column:
    """The body a line names, by name or id, else by a project code of its."""
    out = F.lit(None).cast("string")
    for p in reversed(payees):
        for code in p.codes:
            out = F.when(F.contains(folded, F.lit(code)), p.uid).otherwise(out)
    for p in reversed(payees):
        out = F.when(folded.rlike(f"{p.tax_id}|{p.name}"), p.uid).otherwise(out)
    return out


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, j, raw, folded, amounts, is_total, total, column, held, stated): held marks a line whose amount is a
    total's; the first line has the total amounts that the text states."""
    text = F.translate(symbol_repair(c("text")), "΢", "Σ")
    stated = F.transform(F.regexp_extract_all(flat_fold(c("text")), F.lit(STATED), 1), cents_eu)
    d = once(docs.select("doc_id", text.alias("t"), stated.alias("stated")), "english", F.regexp_count("t", F.lit(ENGLISH_THOUSANDS)) > F.regexp_count("t", F.lit(GREEK_THOUSANDS)))
    d = d.select("doc_id", "english", "stated", F.posexplode(F.split("t", r"\r?\n", -1)).alias("j", "raw")).withColumn("stated", F.when(c("j") == 0, c("stated")))
    d = once(once(d, "folded", fold(c("raw"))), "amounts", amounts_at_locale(c("raw"), c("english"))).drop("english")
    w = Window.partitionBy("doc_id").orderBy("j")
    d = d.withColumns({"_before": F.lag("amounts").over(w), "_above": F.lag("raw").over(w)})
    marked, own = c("folded").rlike(TOTAL), F.size("amounts") > 0
    above = marked & ~own & (F.size("_before") == 1) & ~c("_above").rlike(r"\p{L}")
    of = F.when(marked & own, F.element_at("amounts", -1)).when(above, F.element_at("_before", 1))
    d = d.withColumns({"is_total": F.coalesce(marked & own | above, F.lit(False)), "_of": of, "_lends": F.coalesce(above, F.lit(False)), "marked": marked})
    d = d.withColumn("held", (c("marked") & own) | F.coalesce(F.lead("_lends").over(w), F.lit(False)))
    return d.select("doc_id", "j", "raw", "folded", "amounts", "marked", "is_total", c("_of.cents").alias("total"), c("_of.end").alias("column"), "held", "stated")


def transfer_rows(docs: DataFrame, payees: Sequence[Payee]) -> DataFrame:
    """(doc_id, line, amount, recipient, validation, how) of the rows of transfer tables in ``docs`` (doc_id, text)
    that pay one of ``payees`` (tried in order). A payment order whose lines add up to an amount that it
    states is read by its lines alone. The lines are derived and dealt out once: sums of a document and of
    a section, and the rows beside a row, are windows over one document's lines."""
    lines = _lines(docs).filter(c("doc_id").isNotNull())
    document, section = Window.partitionBy("doc_id"), Window.partitionBy("doc_id", "section")
    w = document.orderBy("j")
    last = F.element_at("amounts", -1)
    pays = c("raw").rlike(PAYMENT_LINE) & (F.size("amounts") > 0)
    # a line belongs to the section of the next total; what is after the last total belongs to none
    s = lines.withColumns({"section": F.coalesce(F.sum(c("is_total").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
                           **{f"f{k}": F.lead("folded", k).over(w) for k in (1, 2, 3)}, "pays": pays, "paid": F.sum(F.when(pays, last["cents"])).over(document)})
    s = s.withColumn("is_order", F.coalesce(F.bool_or(F.array_contains("stated", c("paid"))).over(document), F.lit(False)))
    starts = ~c("is_total") & (c("raw").rlike(NUMBERED) | c("folded").rlike(PROJECT_CODE))
    of = F.struct(c("j").alias("hi"), c("total").alias("sum_to"), c("column").alias("at"))
    s = s.withColumns({"of": F.max(F.when(c("is_total"), of)).over(section), "first": F.min(F.when(starts, c("j"))).over(section)})
    in_table = ~c("is_total") & c("of").isNotNull() & ~c("held") & ~c("marked") & (F.size("amounts") > 0)
    s = s.filter(F.when(c("is_order"), c("pays")).otherwise(in_table)).select("doc_id", "section", "j", "raw", "folded", "amounts", "f1", "f2", "f3", "is_order", "of.*", "first")
    one, none = F.array(F.element_at("amounts", -1)), F.filter("amounts", lambda a: F.lit(False))
    sets = [(f"the total's column (±{d})", F.filter("amounts", lambda a, d=d: F.abs(a["end"] - c("at")) <= d)) for d in NEAR]
    sets += [("lines with a project code", F.when(c("folded").rlike(PROJECT_CODE), one).otherwise(none)), ("numbered rows", F.when(c("raw").rlike(NUMBERED), one).otherwise(none)),
             ("every amount of the table", F.when(c("j") >= c("first") - 3, c("amounts")).otherwise(none))]
    s = once(s, "sets", F.array(*[cells for _, cells in sets]))
    zero = F.lit(0).cast("bigint")
    added = lambda x: F.when(F.exists(x, lambda a: a["cents"].isNotNull()), F.aggregate(x, zero, lambda n, a: n + F.coalesce(a["cents"], zero)))
    s = once(s, "sums", F.transform("sets", added))
    # the first candidate that adds up; else the first of all, though it has no cell
    s = s.withColumns({f"_s{i}": F.sum(c("sums")[i]).over(section) for i in range(len(sets))})
    s = s.withColumn("good", F.coalesce(*[F.when(c(f"_s{i}") == c("sum_to"), F.lit(i)) for i in range(len(sets))]))
    s = s.withColumn("cells", F.when(c("is_order"), one).otherwise(F.get("sets", F.coalesce("good", F.lit(0))))).filter(F.size("cells") > 0)
    later = section.orderBy(c("j").desc()).rangeBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("next", F.min("j").over(later))
    until = F.least(c("j") + 4, F.coalesce("next", "hi"), "hi")
    named = _named(c("folded"), payees)
    paid = named
    for p in reversed(payees):
        own = rf"(?<!\d){p.tax_id}(?!\d)"
        hit = c("folded").rlike(own)
        for k in (1, 2, 3):
            hit = hit | (F.coalesce(c(f"f{k}").rlike(own), F.lit(False)) & (c("j") + k < until))
        paid = F.when(hit, p.uid).otherwise(paid)
    names = F.array(*[F.lit(how) for how, _ in sets])
    how = F.when(c("is_order"), F.lit("payment lines")).otherwise(F.element_at(names, F.coalesce("good", F.lit(0)) + 1))
    rows = s.withColumn("recipient", F.when(c("is_order"), named).otherwise(paid)).filter(c("recipient").isNotNull())
    return rows.select("doc_id", c("j").alias("line"), F.explode("cells").alias("cell"), "recipient", F.when(c("is_order") | c("good").isNotNull(), F.lit("stated_amount")).alias("validation"), how.alias("how")) \
        .withColumn("amount", c("cell.cents")).select(*OUT)


def read_transfers(docs: DataFrame, payees: Sequence[Payee], manager: str) -> DataFrame:
    """(doc_id, amount, recipient, method, validation, status) of transfer documents (doc_id, subject, text):
    'absent' where no payee is named, else its table's rows, else, where the payee manages the
    project's account (``manager`` on folded text) or the project is its own, the letter's amount."""
    flat = once(docs.select("doc_id", "subject", "text"), "flat", flat_fold(c("text")))
    who = _named(F.concat_ws(" ", "flat", fold(c("subject"))), payees)
    known = once(flat, "who", who)
    rows = transfer_rows(docs, payees)
    rows = rows.join(known.filter(c("who").isNotNull()).select("doc_id"), "doc_id", "left_semi")
    table = rows.select("doc_id", "amount", "recipient", F.lit("table").alias("method"), "validation", F.lit("read").alias("status"))
    codes = [x for p in payees for x in p.codes]
    own = c("flat").rlike(manager)
    for code in codes:
        own = own | F.contains(F.concat_ws(" ", "flat", "subject"), F.lit(code))
    rest = known.join(table.select("doc_id").distinct(), "doc_id", "left_anti").withColumn("own", F.coalesce(own, F.lit(False)))
    letters = extract_validated_amounts(rest.filter(c("who").isNotNull() & c("own")).select("doc_id", "text"), {"amount": WORDS_FIG})
    out = rest.select("doc_id", "who").join(letters.select("doc_id", "amount", "validation", c("status").alias("_read")), "doc_id", "left")
    read = c("_read") == "read"
    return table.unionByName(out.select("doc_id", F.when(read, c("amount")).alias("amount"), F.when(read, c("who")).alias("recipient"), F.when(read, F.lit("letter")).alias("method"),
                                        F.when(read, c("validation")).alias("validation"), F.when(c("who").isNull(), F.lit("absent")).otherwise(F.coalesce("_read", F.lit("not_found"))).alias("status")))


# ---- fixed values: decisions of the other grantors ------------------------------------------------------------
OPERATIVE = "ΑΠΟΦΑΣΙ[ΖΗ]|ΚΑΤΑΝΕΜΟΥΜΕ|ΣΑΣ ΠΑΡΑΚΑΛΟΥΜΕ"
FIGURES = r"\d{1,3}(?:\.\d{3})+,\d{2}|\d+,\d{2}"
IN_WORDS = rf"(?:ΠΟΣΟ[\p{{L}}\p{{N}}_]*|ΥΨΟΥΣ)\s+(?:ΤΩΝ\s+|ΤΟΥ\s+)?([^()\d]{{3,300}}?)\s*\(\s*({FIGURES})\s*€?\s*\)"
STATES = rf"(?:ΠΟΣΟΥ|ΠΟΣΟ)\s+€?\s*(?:{FIGURES})|(?:ΣΥΝΟΛΟ|ΣΥΝΟΛΙΚΟΥ ΠΟΣΟΥ)[\s(€):]{{0,80}}(?:{FIGURES})"
TOTALS_IN = rf"(?:ΣΥΝΟΛΟ|ΣΥΝΟΛΙΚΟΥ ΠΟΣΟΥ)[\s(€):]{{0,80}}({FIGURES})"
CELL = rf"(?<![\d.,])(?:{FIGURES})(?![\d,])"


def other_grants(docs: DataFrame, bodies: Sequence[tuple[str, str]], tax_ids: dict[str, str], home: str, home_uid: str) -> DataFrame:
    """(doc_id, amount, recipient, method, validation, status, how) of other grantors' decisions (doc_id, subject, text).

    The recipient is the first of ``bodies`` (uid, pattern) that the operative part names, else the
    subject, else the body whose tax id is quoted first, else the home body by name. The amount is
    one in words and figures; else what adds up to an amount the document states: the cells in a
    total's column, all cells, or the longest run of rows from the first, summed as windows over the
    document's lines."""
    text = F.translate(symbol_repair(c("text")), "΢", "Σ")
    d = once(docs.select("doc_id", "subject", text.alias("t")), "flat", F.replace(fold(c("t")), F.lit("ΣΤΝΟΛΟ"), F.lit("ΣΥΝΟΛΟ")))
    d = once(d, "body", F.regexp_replace("flat", f"^.*(?:{OPERATIVE})", ""))
    quoted = F.filter(F.regexp_extract_all("body", F.lit(r"(?<!\d)(\d{9})(?!\d)"), 1), lambda x: x.isin(*tax_ids))
    by_id = F.try_element_at(F.create_map(*[F.lit(x) for kv in tax_ids.items() for x in kv]), F.get(quoted, F.lit(0)))
    who = F.coalesce(first_match(F.substring("body", 1, 600), bodies), first_match(fold(F.coalesce("subject", F.lit(""))), bodies), by_id,
                     F.when(c("body").rlike(rf"ΔΗΜΟ[\p{{L}}\p{{N}}_]? {home}"), F.lit(home_uid)))
    d = once(d, "recipient", who)
    figures = F.nullif(F.regexp_extract("body", IN_WORDS, 2), F.lit(""))
    d = d.withColumns({"fig": cents_eu(figures), "words": words_to_cents_lenient(F.regexp_extract("body", IN_WORDS, 1), folded=True)})
    last = lambda x: cents_eu(F.regexp_extract(x, rf"({FIGURES})$", 1))
    said = F.transform(F.concat(F.regexp_extract_all("flat", F.lit(f"({STATES})"), 1), F.regexp_extract_all(fold(F.coalesce("subject", F.lit(""))), F.lit(f"({STATES})"), 1)), last)
    open_ones = d.filter(c("recipient").isNotNull() & c("fig").isNull()).select("doc_id", "t", said.alias("said"))

    lines = open_ones.select("doc_id", F.posexplode(F.split("t", r"\r?\n", -1)).alias("j", "raw"))
    lines = once(lines, "line", F.replace(fold(c("raw")), F.lit("ΣΤΝΟΛΟ"), F.lit("ΣΥΝΟΛΟ")))
    starts = lines.groupBy("doc_id").agg(F.coalesce(F.max(F.when(c("line").rlike(OPERATIVE), c("j"))), F.lit(0)).alias("start"))
    lines = lines.join(starts, "doc_id").filter(c("j") > c("start"))
    total = F.regexp_extract("line", TOTALS_IN, 1)
    columns = lines.filter(total != "").groupBy("doc_id").agg(F.collect_set(F.length("raw") - F.length(F.call_function("substring_index", c("raw"), total, F.lit(-1)))).alias("columns"))  # as many as a document has total lines
    body = lines.filter(~c("line").rlike(STATES) & ~c("line").rlike("ΣΥΝΟΛΟ|ΥΠΟΛΟΙΠΟ"))
    found = F.regexp_extract_all("raw", F.lit(f"({CELL})"), 1)
    gaps = F.slice(F.split("raw", CELL, -1), F.lit(1), F.size("found"))
    body = once(body, "found", found).filter(F.size("found") > 0)
    sizes = F.zip_with(gaps, "found", lambda g, x: F.length(g) + F.length(x))
    body = once(body, "sizes", sizes)
    cells = body.select("doc_id", "j", F.size("found").alias("of"), "sizes", F.posexplode("found").alias("k", "amount")).select(
        "doc_id", "j", "k", (c("k") + 1 == c("of")).alias("last"), cents_eu(c("amount")).alias("amount"), F.aggregate(F.slice("sizes", F.lit(1), c("k") + 1), F.lit(0), lambda a, n: a + n).alias("end"))
    cells = cells.join(columns, "doc_id", "left")
    in_column = F.coalesce(F.exists("columns", lambda x: F.abs(x - c("end")) <= 2), F.lit(False))
    sums = cells.groupBy("doc_id").agg(F.sum(F.when(in_column, c("amount"))).alias("s1"), F.count_if(in_column).alias("n1"), F.sum("amount").alias("s2"), F.count("*").alias("n2"))
    runs = cells.filter("last").select("doc_id", "j", F.sum("amount").over(Window.partitionBy("doc_id").orderBy("j")).alias("sum"), F.row_number().over(Window.partitionBy("doc_id").orderBy("j")).alias("n"))
    runs = runs.join(open_ones.select("doc_id", "said"), "doc_id").filter(F.array_contains("said", c("sum"))).groupBy("doc_id").agg(F.max_by("sum", "n").alias("s3"))
    best = sums.join(open_ones.select("doc_id", "said"), "doc_id").join(runs, "doc_id", "left")
    fits = lambda x: F.coalesce(F.array_contains("said", c(x)), F.lit(False))
    how = F.when(fits("s1"), F.lit("column")).when(fits("s2"), F.lit("table")).when(c("s3").isNotNull(), F.lit("rows"))
    best = best.select("doc_id", how.alias("how"), F.when(fits("s1"), c("s1")).when(fits("s2"), c("s2")).otherwise(c("s3")).alias("sum")).filter(c("how").isNotNull())
    out = d.select("doc_id", "recipient", "fig", "words").join(best, "doc_id", "left")
    amount = F.coalesce("fig", "sum")
    return out.select("doc_id", F.when(c("recipient").isNotNull(), amount).alias("amount"), F.when(amount.isNotNull(), c("recipient")).alias("recipient"),
                      F.when(c("recipient").isNull(), None).when(c("fig").isNotNull(), F.lit("letter")).when(c("sum").isNotNull(), F.lit("table")).alias("method"),
                      F.when(c("recipient").isNull(), None).when(c("fig").isNotNull(), F.when(c("words") == c("fig"), F.lit("words_and_figures"))).when(c("sum").isNotNull(), F.lit("stated_amount")).alias("validation"),
                      F.when(c("recipient").isNotNull() & amount.isNotNull(), F.lit("read")).otherwise(F.lit("not_found")).alias("status"), "how")

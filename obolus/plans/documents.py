"""Document text -> validated amounts, as jobs over lines.

One row per line; what a line is, is a regular expression; where it stands, is a running window
inside its document (a partition is one document and as long as it); whether the document may be
used, is a sum per document. Every job gives rows and refusals. Amounts are cents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.functions.money import cents_eu, format_amount_eu, words_to_cents, words_to_cents_lenient
from obolus.functions.text import collapse, flat_fold, fold, letter_tokens, symbol_repair, upper_plain
from obolus.operators.rules import first_match
from obolus.operators.shape import latest_per_key, once
from obolus.session import written

c = F.col
A = fv.AMOUNT_EU


def running_sections(df: DataFrame, keys: list[str], order: list[str], boundary: Column, name: str = "section") -> DataFrame:
    """Running count of boundary rows: the section each row stands in. A partition is one
    document, so it is as long as the document and no longer."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.when(boundary, 1).otherwise(0)).over(w))


def document_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, line, raw), symbols repaired."""
    rest = [x for x in docs.columns if x not in (text,)]
    return docs.select(*rest, F.posexplode(F.split(symbol_repair(c(text)), r"\r?\n", -1)).alias("line", "raw"))


# ---- execution statements ---------------------------------------------------------------------------
ROW = rf"^\s*(\d{{4}})\s+(.*?)\s+({A})\s+({A})\s+({A})\s*$"
SIDE_TOTAL = rf"ΣΥΝΟΛΟ (ΕΣΟΔΩΝ|ΕΞΟΔΩΝ)\s+({A})\s+({A})\s+({A})"
GRAND_TOTAL = rf"ΓΕΝΙΚΟ ΣΥΝΟΛΟ\s+({A})\s+({A})\s+({A})"
PERIOD = r"Περίοδος:\s*(\S+)\s+(\d{4})"
SECTION = r"ΚΑΤΑΣΤΑΣΗ ΕΚΤΕΛΕΣΗΣ ΠΡΟΫΠΟΛΟΓΙΣΜΟΥ (ΕΣΟΔΩΝ|ΔΑΠΑΝΩΝ) ΕΩΣ (\d{1,2})/(\d{1,2})/(\d{4})"
REVENUE_START = r"^(\d{4})\s"
SPENDING_START = r"^(?:(\d{2})-)?(\d{4})\s"
CHART_START = r"^(\d{3})\.(\d{7}(?:\d{3})?)\s"


def detect_layout(text: Column) -> Column:
    """'standard', 'cumulative', 'sections' (2025 and 2026) or null."""
    return _layout_of(symbol_repair(text))


def _layout_of(t: Column) -> Column:
    """The layout of a text whose symbols are repaired."""
    period = t.rlike(PERIOD)
    return (F.when(t.contains("Στοιχεία Εκτέλεσης Προϋπολογισμού") & period, F.lit("standard"))
            .when(t.contains("ΑΠΟΛΟΓΙΣΤΙΚΑ ΣΤΟΙΧΕΙΑ") & period, F.lit("cumulative"))
            .when(t.rlike(SECTION), F.lit("sections")))


def _period_of(t: Column) -> Column:
    """Last day of the month a repaired text names; null for an unknown month."""
    month = F.array_position(F.array(*[F.lit(m) for m in fv.MONTHS]), F.regexp_extract(t, PERIOD, 1)).cast("int")
    return F.when(month > 0, F.last_day(F.make_date(F.regexp_extract(t, PERIOD, 2).try_cast("int"), month, F.lit(1))))


def _side_of(code: Column) -> Column:
    return F.when(F.substring(code, 1, 1).isin(*"012345"), F.lit("revenue")).otherwise(F.lit("spending"))


AMOUNTS = ("budgeted", "assessed_or_warranted", "collected_or_paid")
OUT = ("doc_id", "layout", "period_end", "side", "service", "kae", "description", *AMOUNTS)
LINE = f"struct<side:string,service:string,kae:string,description:string,{','.join(a + ':bigint' for a in AMOUNTS)}>"
TOTAL = "struct<side:string,t0:bigint,t1:bigint,t2:bigint>"


def _line(side: Column, service: Column, kae: Column, description: Column, values: list[Column]) -> Column:
    return F.struct(side.alias("side"), service.alias("service"), kae.alias("kae"), description.alias("description"),
                    *[v.alias(a) for v, a in zip(values, AMOUNTS)]).cast(LINE)


def _total(side: Column, values: list[Column]) -> Column:
    return F.struct(side.alias("side"), *[v.alias(f"t{i}") for i, v in enumerate(values)]).cast(TOTAL)


def _printed(raw: Column, pattern: str, first: int) -> list[Column]:
    return [cents_eu(F.regexp_extract(raw, pattern, first + i)) for i in range(3)]


def _first_reason(*pairs: tuple[Column, str]) -> Column:
    out = None
    for bad, why in pairs:
        out = (F.when if out is None else out.when)(F.coalesce(bad, F.lit(False)), F.lit(why))
    return out


def _amounts_from(offset: Column) -> Column:
    """array<struct<end,cents>> of a line's amounts from ``offset`` on, ends counted on the line."""
    rest = F.substring(c("raw"), offset + 1, F.length("raw"))
    found = F.regexp_extract_all(rest, F.lit(f"({fv.AMOUNT_IN_STATEMENT})"), 1)
    gaps = F.slice(F.split(rest, fv.AMOUNT_IN_STATEMENT, -1), 1, F.size(found))
    lengths = F.zip_with(gaps, found, lambda g, m: F.length(g) + F.length(m))
    none = F.array().cast("array<int>")
    ends = F.aggregate(lengths, none, lambda acc, n: F.concat(acc, F.array(n + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)))))
    return F.zip_with(found, ends, lambda m, e: F.struct((e + offset).alias("end"), cents_eu(m).alias("cents")))


def statement_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, layout, line, raw, period, and what the line is): the lines that count of statements of every layout, and
    each document's first line, so that no document is lost. One pass over the texts: which lines
    are rows, headers and totals is chosen by the layout; a section's side is carried forward."""
    d = once(docs.select("doc_id", "text"), "repaired", symbol_repair(c("text")))
    d = once(d, "layout", _layout_of(c("repaired")))
    d = once(d, "period", F.when(c("layout").isin("standard", "cumulative"), _period_of(c("repaired"))))
    raws = F.when(c("layout").isNull(), F.array(F.lit(""))).otherwise(F.split(c("repaired"), r"\r?\n", -1))
    lines = d.select("doc_id", "layout", "period", F.posexplode(raws).alias("line", "raw"))
    by_line = Window.partitionBy("doc_id").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    sections = F.coalesce(c("layout") == "sections", F.lit(False))
    head = sections & c("raw").rlike(SECTION)
    side = F.when(F.regexp_extract("raw", SECTION, 1) == "ΕΣΟΔΩΝ", F.lit("revenue")).otherwise(F.lit("spending"))
    number = lambda i: F.regexp_extract("raw", SECTION, i).try_cast("int")
    lines = lines.withColumns({"_head": head, "side": F.last(F.when(head, side), ignorenulls=True).over(by_line), "_end": F.when(head, F.make_date(number(4), number(3), number(2)))})
    inside = sections & c("side").isNotNull()
    total = (F.when(c("layout") == "standard", c("raw").rlike(SIDE_TOTAL)).when(c("layout") == "cumulative", c("raw").rlike(GRAND_TOTAL))
             .otherwise(inside & ~c("_head") & c("raw").contains("ΓΕΝΙΚΟ ΣΥΝΟΛΟ")))
    own = F.when(c("side") == "revenue", c("raw").rlike(REVENUE_START)).otherwise(c("raw").rlike(SPENDING_START))
    coded = inside & ~c("_head") & own
    lines = lines.withColumns({"_total": F.coalesce(total, F.lit(False)), "_chart": inside & ~coded & c("raw").rlike(CHART_START)})
    begins = F.when(sections, inside & ~c("_head") & ~c("_total") & (coded | c("_chart"))).otherwise(c("layout").isNotNull() & ~c("_total") & c("raw").rlike(ROW))
    lines = lines.withColumn("_start", F.coalesce(begins, F.lit(False)))
    return lines.filter((c("line") == 0) | F.when(sections, inside).otherwise(c("_start") | c("_total")))


def parse_statements(docs: DataFrame) -> DataFrame:
    """(doc_id, layout, period_end, rows, reason): every document with its rows, as long as it is, and
    why it may not be used (null: it may).

    standard: a code printed twice on a side refuses. cumulative: rows are summed per code; the first grand
    total is revenue's, the second spending's, a third refuses. Sections (2025 and 2026): a row may wrap, its
    amounts are those up to the next row, header or total, three exactly. Every window and group has the
    document as its partition."""
    lines = running_sections(statement_lines(docs), ["doc_id"], ["line"], c("_head") | c("_total") | c("_start"), "row_id")
    sections = F.coalesce(c("layout") == "sections", F.lit(False))
    width = lambda p: F.length(F.regexp_extract("raw", p, 0))
    prefix = F.when(c("_chart"), width(CHART_START)).when(c("side") == "revenue", width(REVENUE_START)).otherwise(width(SPENDING_START))
    lines = once(lines, "_offset", F.when(c("_start"), prefix).otherwise(F.lit(0)))
    none = F.array().cast("array<struct<end:int,cents:bigint>>")
    lines = once(lines, "found", F.when(sections & c("side").isNotNull(), _amounts_from(c("_offset"))).otherwise(none))
    rest = F.substring(c("raw"), c("_offset") + 1, F.length("raw"))
    text = F.when(sections, F.nullif(collapse(F.regexp_replace(rest, fv.AMOUNT_IN_STATEMENT, " ")), F.lit("")))
    in_row = Window.partitionBy("doc_id", "row_id").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumns({"_text": text, "_before": F.coalesce(F.sum(F.size("found")).over(in_row), F.lit(0))})
    # a row's lines: as many as the layout wraps it over
    groups = lines.groupBy("doc_id", "row_id").agg(
        F.min("layout").alias("layout"), F.min("period").alias("period"), F.bool_or("_start").alias("is_row"), F.bool_or("_total").alias("is_total"), F.bool_or("_chart").alias("chart"),
        F.min("side").alias("side"), F.min_by("raw", "line").alias("raw"), F.min("_end").alias("_end"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("line", "found"))), lambda x: x["found"])).alias("found"), F.min_by("found", "line").alias("own"),
        F.min_by("_text", F.when(c("_text").isNotNull() & (c("_before") < 3), c("line"))).alias("description"))
    by_end = c("chart") & (F.size(F.array_distinct(F.transform("found", lambda x: x["end"]))) == 3)
    groups = once(groups, "_v", F.transform(F.when(by_end, F.array_sort("found")).otherwise(c("found")), lambda x: x["cents"]))
    part = lambda p, i: F.regexp_extract("raw", p, i)
    service = F.when(c("chart"), part(CHART_START, 1)).when(c("side") == "spending", F.nullif(part(SPENDING_START, 1), F.lit("")))
    kae = F.when(c("chart"), part(CHART_START, 2)).when(c("side") == "revenue", part(REVENUE_START, 1)).otherwise(part(SPENDING_START, 2))
    wrapped = _line(c("side"), service, kae, F.coalesce("description", F.lit("")), [F.get("_v", F.lit(i)) for i in range(3)])
    # a row's parts by one search: the pattern takes the whole line, the text comes last as it may hold any sign
    groups = once(groups, "_p", F.when(c("is_row") & ~sections, F.split(F.regexp_replace("raw", ROW, "$1\t$3\t$4\t$5\t$2"), "\t", 5)))
    code = F.get("_p", F.lit(0))
    plain = _line(_side_of(code), F.lit(None).cast("string"), code, collapse(F.get("_p", F.lit(4))), [cents_eu(F.get("_p", F.lit(i))) for i in (1, 2, 3)])
    of_side = F.when(part(SIDE_TOTAL, 1) == "ΕΣΟΔΩΝ", F.lit("revenue")).otherwise(F.lit("spending"))
    stated = (F.when(sections, _total(c("side"), [F.get("own", F.lit(i))["cents"] for i in range(3)])).when(c("layout") == "standard", _total(of_side, _printed(c("raw"), SIDE_TOTAL, 2)))
              .otherwise(_total(F.lit(None).cast("string"), _printed(c("raw"), GRAND_TOTAL, 1))))
    three, own3 = F.size("found") == 3, F.size("own") == 3
    groups = once(groups, "row", F.when(c("is_row"), F.when(sections, wrapped).otherwise(plain)))
    groups = once(groups, "stated", F.when(c("is_total") & (own3 | ~sections), stated))
    # a cumulative statement's rows of one code are one line, where the first of them stands; other rows are their own
    key = F.when((c("layout") == "cumulative") & c("is_row"), c("row.kae")).otherwise(c("row_id").cast("string"))
    summed = F.struct(*[F.min_by(f"row.{x}", "row_id").alias(x) for x in ("side", "service", "kae", "description")], *[F.sum(f"row.{x}").alias(x) for x in AMOUNTS]).cast(LINE)
    each = groups.withColumn("_key", key).groupBy("doc_id", "_key", "is_row").agg(
        F.min("row_id").alias("row_id"), F.min("layout").alias("layout"), F.min("period").alias("period"), summed.alias("row"), F.first("stated", ignorenulls=True).alias("stated"), F.min("_end").alias("_end"), F.max("_end").alias("_hi"),
        F.bool_or(sections & c("is_row") & ~three).alias("_short"), F.bool_or(sections & c("is_total") & ~own3).alias("_no_total"),
        F.bool_or(c("is_row") & c("chart")).alias("_new"), F.bool_or(sections & c("is_row") & ~c("chart")).alias("_old"))
    # a document's rows: as many as it prints
    d = each.groupBy("doc_id").agg(
        F.min("layout").alias("_layout"), F.min("period").alias("period"), F.transform(F.array_sort(F.collect_list(F.when(c("is_row"), F.struct("row_id", c("row").alias("r"))))), lambda x: x["r"]).alias("rows"),
        F.transform(F.array_sort(F.collect_list(F.when(c("stated").isNotNull(), F.struct("row_id", c("stated").alias("t"))))), lambda x: x["t"]).alias("_stated"),
        *[F.bool_or(x).alias(x) for x in ("_short", "_no_total", "_new", "_old")], F.min("_end").alias("_lo"), F.max("_hi").alias("_hi"))
    by_order = F.transform("_stated", lambda t, i: F.struct(F.when(i == 0, F.lit("revenue")).otherwise(F.lit("spending")).alias("side"), *[t[f"t{k}"].alias(f"t{k}") for k in range(3)]).cast(TOTAL))
    d = once(d, "totals", F.when(c("_layout") == "cumulative", by_order).otherwise(c("_stated")))
    codes = F.transform("rows", lambda x: F.concat(x["side"], x["kae"]))
    dated, std, cum = c("_layout").isin("standard", "cumulative"), c("_layout") == "standard", c("_layout") == "cumulative"
    bad = _first_reason((c("_layout").isNull(), "unknown layout"), (dated & c("period").isNull(), "unknown month"), (std & (F.size(F.array_distinct(codes)) != F.size("rows")), "code appears twice"),
                        (cum & (F.size("totals") > 2), "more than two grand totals"), (c("_short"), "a row without three amounts"), (c("_no_total"), "a total without three amounts"),
                        (c("_lo") != c("_hi"), "sections end on different dates"), (c("_new") & c("_old"), "rows of both charts"))
    layout = F.when(c("_layout") == "sections", F.when(c("_new"), F.lit("2026")).otherwise(F.lit("2025"))).otherwise(c("_layout"))
    known = c("_layout").isNotNull()
    return d.select("doc_id", layout.alias("layout"), F.when(c("_layout") == "sections", c("_lo")).otherwise(c("period")).alias("period_end"), F.when(known, c("rows")).alias("rows"),
                    F.coalesce(bad, validate_statement(c("rows"), c("totals"))).alias("reason"))


def validate_statement(rows: Column, totals: Column) -> Column:
    """Why a statement may not be used: on each side all three columns must equal, to the cent, the
    document's own (last) total. Null when they do."""
    zero = F.lit(0).cast("bigint")
    out = None
    for side in ("revenue", "spending"):
        mine = F.filter(rows, lambda x: x["side"] == side)
        said = F.try_element_at(F.filter(totals, lambda t: t["side"] == side), F.lit(-1))
        off = reduce(lambda a, b: a | b, [F.aggregate(mine, zero, lambda acc, x: acc + x[a]) != said[f"t{i}"] for i, a in enumerate(AMOUNTS)])
        out = (F.when if out is None else out.when)(said.isNull(), F.lit(f"no total of {side}")).when(off, F.lit(f"{side} does not add up"))
    return out


def extract_statements(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines of every statement that is read exactly, {document: reason} of the rest)."""
    parsed = parse_statements(docs)
    rows = (parsed.filter(c("reason").isNull()).select("doc_id", "layout", "period_end", F.explode("rows").alias("r"))
            .select("doc_id", "layout", "period_end", "r.*").select(*OUT))
    return rows, parsed.filter(c("reason").isNotNull()).select("doc_id", "reason")


# ---- budget lines ------------------------------------------------------------------------------------------
def letterheads(docs: DataFrame) -> DataFrame:
    """Adds ``body``: the distinct words of the body a letterhead names, the first line with text under the
    republic's. A text is folded once, all its lines together."""
    d = once(docs, "_lines", F.transform(F.split(c("text"), r"\r?\n", -1), lambda x: F.trim(x)))
    d = once(d, "_upper", F.split(upper_plain(F.array_join("_lines", "\n")), "\n", -1))
    d = once(d, "_at", F.array_position(F.transform("_upper", lambda x: x.startswith("ΕΛΛΗΝΙΚΗ ΔΗΜΟΚΡΑΤΙΑ")), True).cast("int"))
    below = F.filter(F.slice("_lines", c("_at") + 1, F.greatest(F.size("_lines"), F.lit(1))), lambda x: x != "")
    d = once(d, "_body", F.when(c("_at") > 0, F.get(below, F.lit(0))))
    return once(d, "body", letter_tokens(c("_body"))).drop("_lines", "_upper", "_at", "_body")


def names_by_word(names: DataFrame) -> DataFrame:
    """(uid, words, w) of names (uid, words: distinct and sorted), one row for each set of words: the smallest id
    that has it and the one of its words that the fewest sets have."""
    each = names.groupBy("words").agg(F.min("uid").alias("uid")).select("uid", "words", F.explode("words").alias("w"))
    times = each.groupBy("w").agg(F.count("*").alias("times"))
    return each.join(times, "w").groupBy("uid", "words").agg(F.min_by("w", F.struct("times", "w")).alias("w"))


def foreign_letterheads(statements: DataFrame, names: DataFrame) -> DataFrame:
    """(doc_id, other) of statements a body posted under another body's letterhead. A name is met when
    all its words stand in the letterhead; the poster's own name is tried first, by the poster's id. Bodies whose
    names have the same words are one name, of the smallest id; a name is joined on the one of its words that
    the fewest names have, so that a letterhead meets names, not all bodies that share one."""
    s = written(letterheads(statements.select("doc_id", "entity", "text")).filter(F.size("body") > 0).select("doc_id", "entity", "body"))  # read twice
    n = names.select("uid", letter_tokens(c("name")).alias("words")).filter(c("uid").isNotNull() & (F.size("words") > 0)).withColumn("words", F.array_sort("words"))
    own = (s.join(n.select(c("uid").alias("entity"), "words").distinct(), "entity").filter(F.size(F.array_except("words", "body")) == 0).select("doc_id").distinct())
    hits = (s.filter(c("entity").isNotNull()).select("doc_id", "entity", "body", F.explode("body").alias("w")).join(names_by_word(n), "w")
            .filter(F.size(F.array_except("words", "body")) == 0))
    return hits.join(own, "doc_id", "left_anti").groupBy("doc_id").agg(F.min("uid").alias("other"))


def revenue_category(code: Column, description: Column, by_code: dict[str, str], by_name: tuple, state_codes: tuple[str, ...], fixed: dict[str, str]) -> Column:
    """Category of a revenue line: a fixed code, the new chart's map, only the grant groups of the
    old chart, its state-grant codes, then the line's name."""
    from obolus.operators.rules import lookup
    d = fold(description)
    grant_group = code.startswith("0") | code.startswith("1") | code.startswith("43")
    return F.coalesce(lookup(code, fixed), lookup(code, by_code),
                      F.when(grant_group & code.isin(*state_codes), F.lit("state_grants")).when(grant_group, first_match(d, by_name)))


def budget_lines(statements: DataFrame, names: DataFrame, category: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(budget lines, refusals) of published statements (doc_id, entity, statement_date, text)."""
    rows, refused = extract_statements(statements.select("doc_id", "text"))
    foreign = foreign_letterheads(statements, names).select("doc_id", F.concat(F.lit("the statement of "), c("other")).alias("reason"))
    rows = rows.join(foreign, "doc_id", "left_anti").join(statements.select("doc_id", "entity", "statement_date"), "doc_id")
    out = rows.withColumnRenamed("doc_id", "statement_ada").withColumns({
        "period_year": F.year("period_end"), "period_month": F.month("period_end"), "is_year_end": F.date_format("period_end", "MM-dd") == "12-31",
        "kae_group": F.substring("kae", 1, 2)})
    if category is not None:
        out = out.withColumn("grant_category", F.when(c("side") == "revenue", category))
    return out, refused.unionByName(foreign.join(refused, "doc_id", "left_anti"))


# ---- amounts a document states twice -------------------------------------------------------------------------
LETTER = rf"ΠΟΣΟ[\p{{L}}\p{{N}}_]*\s+(?:ΤΩΝ\s+|ΤΟΥ\s+)?([^()]{{3,300}}?)\s*\(\s*({A})\s*€?\s*\)"


def _pairs(flat: Column, pattern: str) -> Column:
    """array<struct<words,figures>> of every place the pattern matches."""
    return F.zip_with(F.regexp_extract_all(flat, F.lit(pattern), 1), F.regexp_extract_all(flat, F.lit(pattern), 2),
                      lambda w, f: F.struct(w.alias("words"), f.alias("figures")))


def letter_amounts(docs: DataFrame, manager: str, pattern: str = LETTER, lenient: bool = False) -> DataFrame:
    """(doc_id, i, amount, words, ours, validation): amounts a letter states in words and figures,
    validated when both agree; ``manager`` is the pattern of our bodies as the account's manager."""
    flat = once(docs.select("doc_id", "text"), "flat", flat_fold(c("text")))
    parse = words_to_cents_lenient if lenient else words_to_cents
    rows = flat.select("doc_id", c("flat").rlike(manager).alias("ours"), F.posexplode(_pairs(c("flat"), pattern)).alias("i", "p"))
    rows = once(rows, "words", parse(c("p.words"), folded=True)).select("doc_id", "i", "ours", "words", cents_eu(c("p.figures")).alias("amount"))
    return rows.withColumn("validation", F.when(c("words") == c("amount"), F.lit("words_and_figures")))


def stated_amounts(flat: Column, pattern: str, group: int = 1) -> Column:
    """Distinct amounts (cents) at the places a pattern names."""
    return F.array_distinct(F.transform(F.regexp_extract_all(flat, F.lit(pattern), group), cents_eu))


def rows_against_total(rows: DataFrame, totals: DataFrame, keys: list[str], tolerance: Column | None = None) -> DataFrame:
    """Adds ``adds_up`` to rows (keys, amount): whether their group's sum is its stated total, within
    ``tolerance`` (a column over ``n``, the number of rows) where one is given."""
    sums = rows.groupBy(*keys).agg(F.sum("amount").alias("sum"), F.count("*").alias("n"))
    slack = tolerance if tolerance is not None else F.lit(0)
    ok = sums.join(totals, keys, "left").withColumn("adds_up", F.coalesce(F.abs(c("sum") - c("total")) <= slack, F.lit(False)))
    return rows.join(ok.select(*keys, "sum", "n", "total", "adds_up"), keys)


def rounding_tolerance(n: Column) -> Column:
    """Half a cent for each row, ten cents at least."""
    return F.greatest(F.lit(fv.ROUNDING_CENTS), F.floor((n + 1) / 2))


def section_rows(docs: DataFrame, row: str, total: str, ours: str) -> DataFrame:
    """(doc_id, section, amount, validation) of our rows in tables closed by a section total.
    ``row`` and ``total`` are patterns on the folded line whose last group is the amount."""
    from obolus.functions.text import fold_in_place
    lines = once(document_lines(docs.select("doc_id", "text")), "up", fold_in_place(c("raw")))
    kinds = lines.withColumns({"is_row": c("up").rlike(row), "is_total": F.trim("up").rlike(total)}).filter(c("is_row") | c("is_total"))
    before = running_sections(kinds, ["doc_id"], ["line"], c("is_total"), "_closed")
    at = before.filter(c("doc_id").isNotNull()).withColumn("section", c("_closed") - F.when(c("is_total"), 1).otherwise(0))
    at = at.withColumns({"amount": F.when(c("is_row"), cents_eu(F.regexp_extract("up", row, 1))), "total": F.when(c("is_total"), cents_eu(F.regexp_extract(F.trim("up"), total, 1)))})
    # a section has one total, the line that closes it; its rows and total lie beside each other
    section = Window.partitionBy("doc_id", "section")
    at = at.withColumns({"closed": F.bool_or("is_total").over(section), "adds_up": F.sum("amount").over(section) == F.max("total").over(section)})
    rows = at.filter(c("is_row") & c("closed")).filter(fold(c("raw")).rlike(ours))
    return rows.select("doc_id", "section", "line", "amount", F.when(c("adds_up"), F.lit("stated_amount")).alias("validation"))


STATED = rf"ΠΟΣΟ[\p{{L}}\p{{N}}_]*\s+(?:ΤΩΝ\s+|ΤΟΥ\s+)?({A})"
ID_ROW = rf"(?<!\d)(\d{{9}})(?!\d).*?({A})\s*€?\s*(?:\S.*)?$"


def id_rows(docs: DataFrame, our_id: str) -> DataFrame:
    """(doc_id, line, amount, validation) of rows keyed by our tax id; all id-keyed rows together must
    be an amount the text states."""
    flat = once(docs.select("doc_id", "text"), "flat", flat_fold(c("text"))).select("doc_id", stated_amounts(c("flat"), STATED).alias("stated"))
    lines = once(document_lines(docs.select("doc_id", "text")), "up", fold(c("raw"))).filter(c("up").rlike(ID_ROW))
    rows = lines.select("doc_id", "line", F.regexp_extract("up", ID_ROW, 1).alias("id"), cents_eu(F.regexp_extract("up", ID_ROW, 2)).alias("amount"))
    sums = rows.groupBy("doc_id").agg(F.sum("amount").alias("sum")).join(flat, "doc_id")
    ok = sums.select("doc_id", F.array_contains("stated", c("sum")).alias("ok"))
    return rows.filter(c("id") == our_id).join(ok, "doc_id").select("doc_id", "line", "amount", F.when(c("ok"), F.lit("stated_amount")).alias("validation"))


def stated_lines(docs: DataFrame, ours: str) -> DataFrame:
    """(doc_id, line, amount): amounts on lines naming us that the text states elsewhere as a sum."""
    flat = once(docs.select("doc_id", "text"), "flat", flat_fold(c("text"))).select("doc_id", stated_amounts(c("flat"), STATED).alias("stated"))
    lines = document_lines(docs.select("doc_id", "text")).filter(fold(c("raw")).rlike(ours))
    found = lines.select("doc_id", "line", F.explode(F.regexp_extract_all("raw", F.lit(f"({fv.AMOUNT_IN_LINE})"), 1)).alias("a")).select("doc_id", "line", cents_eu(c("a")).alias("amount"))
    return found.join(flat, "doc_id").filter(F.array_contains("stated", c("amount"))).select("doc_id", "line", "amount", F.lit("stated_amount").alias("validation"))


# ---- one amount per document, by configuration ------------------------------------------------------------------
def extract_validated_amounts(docs: DataFrame, config: dict) -> DataFrame:
    """(doc_id, amount, net, words, status, validation) of documents of one kind."""
    flat = once(docs.select("doc_id", "text", F.lit("").alias("kind")), "flat", flat_fold(c("text")))
    return amounts_by_kind(flat, {"": config}).select("doc_id", "amount", "net", "words", "status", "validation")


def amounts_by_kind(d: DataFrame, configs: dict[str, dict], kind: str = "kind") -> DataFrame:
    """Adds (amount, net, words, status, validation) to rows of documents (kind, flat: the folded text), each
    by the configuration of its kind, in one pass; rows of other kinds get nulls.

    A configuration is data: ``anchor`` (the operative part starts after its last match) or ``first`` (at its
    first match) or ``last`` (at its last), ``payee`` (a pattern whose group is the payee's id), ``payee_name`` (accepted instead
    of the id; with ``payee_required`` an id must be printed all the same), ``ids`` (ours), ``present``
    (a pattern without which the document is not ours), ``amount`` (words in group 1, figures in
    group 2), ``figures`` (figures alone), ``total``, ``gross_withheld_net`` (three groups), ``net``,
    ``withheld``, ``net_printed`` (what is paid, where printed), ``share`` (total, part, number),
    ``repeated`` (accept a figure the text states that often), ``subject`` (accept figures that the column
    ``subject`` states, too), ``read_empty`` (ours without an amount is read all the same),
    ``absent_unless`` (without a payee, a text that lacks this id is not ours).
    Validators in order: words = figures; share x number = total; gross - withheld = net;
    figures = stated total; stated often enough; the subject's figures. None: no validation."""
    def by(of, kind_of: str) -> Column:
        out = None
        for k, config in configs.items():
            value = of(config)
            if value is not None:
                out = (F.when if out is None else out.when)(c(kind) == k, value)
        return F.lit(None).cast(kind_of) if out is None else out.cast(kind_of)

    def get(config: dict, name: str, i: int = 1) -> Column:
        return F.nullif(F.regexp_extract("body", config[name], i), F.lit("")) if config.get(name) else F.lit(None).cast("string")

    def body(config: dict) -> Column:
        if config.get("anchor"):
            return F.regexp_replace("flat", rf"^.*(?:{config['anchor']})", "")
        if config.get("first"):
            return F.regexp_replace("flat", rf"^.*?(?={config['first']})", "")
        return F.regexp_replace("flat", rf"^.*(?={config['last']})", "") if config.get("last") else c("flat")

    def ours(config: dict) -> Column:
        if config.get("present"):
            return c("flat").rlike(config["present"])
        if not config.get("payee"):
            return F.lit(True)
        by_name = c("body").rlike(config["payee_name"]) if config.get("payee_name") else F.lit(False)
        return F.coalesce(c("_payee").isin(*config.get("ids", ("",))), F.lit(False)) | by_name

    def figures(config: dict) -> Column:
        return F.coalesce(*[cents_eu(get(config, n, i)) for n, i in (("share", 2), ("gross_withheld_net", 1), ("amount", 2), ("figures", 1))])

    def phrase(config: dict) -> Column:
        out = get(config, "words") if config.get("words") else get(config, "amount")
        for short, full in config.get("abbreviations", {}).items():
            out = F.regexp_replace(out, short, full)
        return out

    def validation(config: dict) -> Column:
        three, share = config.get("gross_withheld_net"), config.get("share")
        adds = cents_eu(get(config, "gross_withheld_net", 1)) - cents_eu(get(config, "gross_withheld_net", 2)) == cents_eu(get(config, "gross_withheld_net", 3)) if three else F.lit(True)
        out = F.when(F.coalesce((c("words") == c("amount")) & adds, F.lit(False)), F.lit("words_and_figures"))
        stated = F.lit("stated_amount")
        if share:
            return out.when(F.coalesce(cents_eu(get(config, "share", 2)) * get(config, "share", 3).try_cast("bigint") == cents_eu(get(config, "share", 1)), F.lit(False)), stated)
        if not three:
            out = out.when(F.coalesce(cents_eu(get(config, "total")) == c("amount"), F.lit(False)), stated)
        if config.get("repeated"):
            out = out.when(times_printed(c("flat"), c("amount")) >= config["repeated"], stated)
        return out.when(F.contains(fold(c("subject")), format_amount_eu(c("amount"))), stated) if config.get("subject") else out

    def paid(config: dict) -> Column:
        if config.get("gross_withheld_net"):
            return cents_eu(get(config, "gross_withheld_net", 3))
        if config.get("net"):
            net = cents_eu(get(config, "net"))
            return F.when(c("amount") - F.coalesce(cents_eu(get(config, "withheld")), F.lit(0)) == net, net)
        return F.coalesce(cents_eu(get(config, "net_printed")), c("amount"))

    def status(config: dict) -> Column:
        missing, found = F.lit("not_found"), F.lit("read")
        out = None
        if config.get("payee"):
            unnamed = c("_payee").isNull() if config.get("payee_required") else c("_payee").isNull() & ~c("ours")
            out = F.when(unnamed, F.when(F.contains("flat", F.lit(config["absent_unless"])), missing).otherwise(F.lit("absent")) if config.get("absent_unless") else missing)
        elif config.get("present"):
            out = F.when(~c("ours"), F.lit("absent"))
        if not config.get("read_empty"):
            out = (F.when if out is None else out.when)(c("amount").isNull(), missing)
        return (F.when if out is None else out.when)(~c("ours"), F.lit("absent")).otherwise(found)

    d = once(d, "body", by(body, "string"))
    d = d.withColumn("_payee", by(lambda x: get(x, "payee") if x.get("payee") else None, "string"))
    d = d.withColumns({"ours": by(ours, "boolean"), "amount": by(figures, "bigint")})
    d = once(d, "words", words_to_cents_lenient(by(phrase, "string"), folded=True))
    d = d.withColumns({"status": by(status, "string"), "validation": by(validation, "string"), "net": by(paid, "bigint")})
    read = F.coalesce(c("status") == "read", F.lit(False))
    return d.withColumns({name: F.when(read, c(name)) for name in ("amount", "net", "words", "validation")}).drop("body", "_payee", "ours")


def times_printed(flat: Column, cents: Column) -> Column:
    """How often a text prints an amount."""
    return F.size(F.split(flat, F.concat(F.lit(r"\Q"), format_amount_eu(cents), F.lit(r"\E")), -1)) - 1

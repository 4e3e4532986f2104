"""Allocation tables in document text: rows keyed by a five-digit code, read into columns, placed,
summed and set against the table's own total line.

Neighbouring lines are found by lead and lag inside the document, tables by running counts of the
segments that begin them, so the document is the unit of shuffle and every check on a table is inside its row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.functions.money import amounts_at, amounts_in, cents_eu, number_cents
from obolus.functions.text import collapse, fold, symbol_repair
from obolus.operators.shape import once
from obolus.plans.documents import document_lines, letter_amounts, running_sections, section_rows, stated_lines
from obolus.session import written

c = F.col
# fixed values: shapes of rows, of total lines and of stated amounts
ROW = r"^\s*(?:(\d{1,4})\s+)?(\d{1,5})(?:\s+((?:[-–]\s*)?\p{L}.*))?\s*$"
UNCODED = r"^\s*(\d{1,4})\s+(\p{L}.*)$"
TOTAL_WORD = "ΣΥΝΟΛ"
STATED = rf"#\s*({fv.AMOUNT_EU})\s*€?\s*#"
PLACE_WITHIN = 4  # characters between a cell's right edge and its column's

R = "struct<number:int,code:string,name:string,amounts:array<bigint>,ends:array<int>>"


def _elements(docs: DataFrame) -> DataFrame:
    """(doc_id, line, kind, number, code, name, found): rows with their amounts (their own line's or an
    unclaimed neighbour's up to two lines away, the next before the previous), numbered lines
    without a code, and total lines."""
    lines = once(document_lines(docs.select("doc_id", "text")), "amts", amounts_at(c("raw")))
    g = lambda i: F.regexp_extract("raw", ROW, i)
    some = F.size("amts") > 0
    number, code, name = g(1), g(2), g(3)
    is_row = c("raw").rlike(ROW) & (((name != "") & ((F.length(code) == 5) | (number != ""))) | ((number != "") & (F.length(code) == 5)))
    kind = F.when(is_row, F.lit("row")).when(some & c("raw").contains(TOTAL_WORD), F.lit("total")).when(some, F.lit("amounts")).otherwise(F.lit(""))
    lines = once(lines, "kind", kind)
    lines = lines.withColumn("needs", (c("kind") == "row") & ((name == "") | ~some))
    w = Window.partitionBy("doc_id").orderBy("line")
    after, before = (lambda col, n: F.lead(col, n).over(w)), (lambda col, n: F.lag(col, n).over(w))
    lines = lines.withColumns({"k1": after("kind", 1), "k2": after("kind", 2), "p1": before("kind", 1), "p2": before("kind", 2)})
    lines = lines.withColumn("to_next", F.when(c("needs"), F.when(c("k1") == "amounts", 1).when((c("k1") == "") & (c("k2") == "amounts"), 2)))
    lines = lines.withColumn("claimed", (c("kind") == "amounts") & (F.coalesce(before("to_next", 1) == 1, F.lit(False)) | F.coalesce(before("to_next", 2) == 2, F.lit(False))))
    lines = lines.withColumns({"c1": F.coalesce(before("claimed", 1), F.lit(False)), "c2": F.coalesce(before("claimed", 2), F.lit(False)),
                               "n1": F.coalesce(after("needs", 1), F.lit(False)), "n2": F.coalesce(after("needs", 2), F.lit(False))})
    to_prev = F.when(c("needs") & c("to_next").isNull(), F.when((c("p1") == "amounts") & ~c("c1"), 1)
                     .when(((c("p1") == "") | ((c("p1") == "amounts") & c("c1"))) & (c("p2") == "amounts") & ~c("c2"), 2))
    found = (F.when((c("kind") == "row") & ~c("needs"), c("amts")).when(c("to_next") == 1, after("amts", 1)).when(c("to_next") == 2, after("amts", 2))
             .when(to_prev == 1, before("amts", 1)).when(to_prev == 2, before("amts", 2)).when(c("kind") != "row", c("amts")))
    lone = (c("kind") == "amounts") & ~c("claimed") & c("raw").rlike(UNCODED) & ~c("n1") & ~c("n2")
    lines = lines.withColumns({"found": found, "lone": lone}).filter(((c("kind") == "row") & (F.size("found") > 0)) | (c("kind") == "total") | c("lone"))
    text = lambda p, i: collapse(F.regexp_replace(F.regexp_extract("raw", p, i), fv.COLUMN_TOKEN, " "))
    row = F.struct(F.when(c("lone"), F.regexp_extract("raw", UNCODED, 1)).otherwise(g(1)).try_cast("int").alias("number"), F.when(c("lone"), F.lit("")).otherwise(g(2)).alias("code"),
                   F.when(c("lone"), text(UNCODED, 2)).otherwise(text(ROW, 3)).alias("name"), F.transform("found", lambda x: x["cents"]).alias("amounts"),
                   F.transform("found", lambda x: x["end"]).alias("ends")).cast(R)
    return lines.select("doc_id", "line", F.when(c("lone"), F.lit("lone")).otherwise(c("kind")).alias("kind"), row.alias("row"))


#: Rows that a fold keeps in one array before it puts them away: so no array is copied whole at every row.
PILE = 256


def _in_sequence(number: Column, lone: Column) -> Column:
    """Of numbered lines without a code those that go on counting from ``number``, in their order."""
    none = F.array().cast(f"array<{R}>")
    start = F.struct((number + 1).alias("next"), F.array().cast(f"array<array<{R}>>").alias("done"), none.alias("open"))

    def step(s: Column, e: Column) -> Column:
        hit = F.coalesce(e["row"]["number"] == s["next"], F.lit(False))
        full = F.size(s["open"]) >= PILE
        return F.struct(F.when(hit, s["next"] + 1).otherwise(s["next"]).alias("next"), F.when(hit & full, F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]).alias("done"),
                        F.when(hit, F.concat(F.when(full, none).otherwise(s["open"]), F.array(e["row"]))).otherwise(s["open"]).alias("open"))
    return F.aggregate(lone, start, step, lambda s: F.flatten(F.concat(s["done"], F.array(s["open"]))))


def allocation_tables(docs: DataFrame) -> DataFrame:
    """(doc_id, table, rows, totals): the coded tables of each document, blank cells placed.

    A coded row or a total line begins a segment; the numbered lines without a code after a row belong to it
    as far as they go on counting. A table ends at a total line, or where a row's number is 1 again: tables
    are running counts of such segments, so a document's lines are sorted once and no state grows with it."""
    e = _elements(docs).withColumn("mark", c("kind") != "lone")
    e = running_sections(e, ["doc_id"], ["line"], c("mark"), "segment").filter("segment > 0")
    # the lines of one segment, and below the rows of one table: as many as the document prints there
    lone = F.array_sort(F.collect_list(F.when(~c("mark"), F.struct("line", "row"))))
    segments = e.groupBy("doc_id", "segment").agg(F.min_by(F.struct("kind", "row"), "line").alias("head"), lone.alias("lone"))
    is_row = c("head.kind") == "row"
    segments = once(segments, "more", F.when(is_row, _in_sequence(c("head.row.number"), c("lone"))))
    w = Window.partitionBy("doc_id").orderBy("segment")
    segments = segments.withColumn("last", c("head.row.number") + F.size("more")).withColumns({"kind": c("head.kind"), "before": F.lag("head.kind").over(w), "before_last": F.lag("last").over(w)})
    again = (c("before") == "row") & (c("head.row.number") == 1) & (F.coalesce("before_last", F.lit(0)) > 1)
    starts = is_row & (c("before").isNull() | (c("before") == "total") | F.coalesce(again, F.lit(False)))
    tabled = running_sections(segments, ["doc_id"], ["segment"], starts, "tables").withColumn("table", (c("tables") - 1).cast("int"))
    closes = (c("kind") == "total") & (c("before") == "row")
    rows = F.flatten(F.transform(F.array_sort(F.collect_list(F.when(c("kind") == "row", F.struct("segment", F.concat(F.array("head.row"), c("more")).alias("rows"))))), lambda x: x["rows"]))
    each = tabled.filter("table >= 0").groupBy("doc_id", "table").agg(rows.alias("rows"), F.first(F.when(closes, c("head.row.amounts")), ignorenulls=True).alias("totals"))
    return fill_blank_cells(each)


# fixed values: any number is a column of a table keyed by names (whole euros, counts, amounts)
NUMBER = r"\d{1,3}(?:\.\d{3})+(?:,\d{1,2})?|\d+(?:,\d{1,2})?"
NAMED_ROW = rf"^\s*(?:(\d{{1,4}})\s+)?(?:(\d{{4,5}})\s+)?(\p{{L}}[^\d€]*?)\s+((?:(?:{NUMBER})\s*€?\s*)+)$"
NUMBER_TOKEN = rf"(?<![\d.,])(?:{NUMBER})(?![\d.,%])"
ENDS_TRIED = 3


def named_tables(docs: DataFrame, name: str, code: str) -> DataFrame:
    """(doc_id, table, rows, totals) and the columns of ``validate_tables``: the table of each document that
    holds a row named ``name`` (a pattern on the folded name), read by name; that row gets ``code``.

    Rows are lines that end in as many numbers as ours, numbered if ours is, else with a name in
    capitals. The table starts after the total line before our row and ends at one of the three
    after it: the first whose numbers the rows add up to, else the first."""
    tokens = lambda x: F.transform(F.regexp_extract_all(x, F.lit(f"({NUMBER_TOKEN})"), 1), number_cents)
    lines = document_lines(docs.select("doc_id", "text"))
    part = lambda i: F.regexp_extract("raw", NAMED_ROW, i)
    lines = once(lines, "m", F.struct(part(1).alias("number"), part(2).alias("code"), F.trim(part(3)).alias("name"), tokens(part(4)).alias("amounts")))
    lines = lines.withColumns({"parsed": F.length("m.name") > 0, "summed": c("raw").contains(TOTAL_WORD)})
    lines = lines.withColumn("closes", c("summed") & c("raw").rlike(NUMBER_TOKEN))
    lines = once(lines, "ours", c("parsed") & fold(c("m.name")).rlike(name))
    at = lines.filter("ours").groupBy("doc_id").agg(F.min(F.struct("line", F.size("m.amounts").alias("k"), (F.length("m.number") > 0).alias("numbered"))).alias("at"))
    totals = lines.filter("closes").join(at, "doc_id").select("doc_id", "line", "at", tokens(F.substring_index("raw", TOTAL_WORD, -1)).alias("totals"))
    # a document's total lines: as many as it prints
    spans = totals.groupBy("doc_id").agg(F.max(F.when(c("line") < c("at.line"), c("line"))).alias("start"), F.array_sort(F.collect_list(F.when(c("line") > c("at.line"), F.struct("line", "totals")))).alias("ends"))
    nothing = F.lit(None).cast("struct<line:int,totals:array<bigint>>")
    ends = F.when(F.size("ends") > 0, F.slice("ends", 1, ENDS_TRIED)).otherwise(F.array(nothing))
    tried = at.join(spans, "doc_id", "left").select("doc_id", "at", F.coalesce("start", F.lit(-1)).alias("start"), F.posexplode(ends).alias("try", "end"))
    rows = lines.filter(c("parsed") & ~c("summed")).join(tried, "doc_id").filter((c("line") > c("start")) & (c("end").isNull() | (c("line") < c("end.line"))) & (F.size("m.amounts") == c("at.k"))
                                                                               & F.when(c("at.numbered"), F.length("m.number") > 0).otherwise(c("m.name") == F.upper("m.name")))
    row = F.struct(F.nullif(c("m.number"), F.lit("")).try_cast("int").alias("number"), F.when(c("line") == c("at.line"), F.lit(code)).otherwise(c("m.code")).alias("code"), c("m.name").alias("name"),
                   c("m.amounts").alias("amounts"), F.array().cast("array<int>").alias("ends")).cast(R)
    each = rows.groupBy("doc_id", "try").agg(F.transform(F.array_sort(F.collect_list(F.struct("line", row.alias("row")))), lambda x: x["row"]).alias("rows"), F.first("end.totals").alias("totals"))
    stated = docs.select("doc_id", F.concat(F.transform(F.regexp_extract_all(symbol_repair(c("text")), F.lit(STATED), 1), cents_eu), amounts_in(F.coalesce("subject", F.lit("")))).alias("stated"))
    checked = validate_tables(each.withColumn("table", c("try")).join(stated, "doc_id"), "stated").drop("stated")
    best = checked.groupBy("doc_id").agg(F.min(F.struct(c("validation").isNull().alias("bad"), c("try"))).alias("b")).select("doc_id", c("b.try").alias("try"))
    return checked.join(best, ["doc_id", "try"], "left_semi").drop("try")


def fill_blank_cells(tables: DataFrame) -> DataFrame:
    """Rows shorter than the table's usual width get their amounts placed by the right edges of the
    nearest complete row's columns; the other cells are zero."""
    widths = F.transform("rows", lambda r: F.size(r["amounts"]))
    t = once(tables, "_w", widths)
    usual = F.array_max(F.transform(F.array_distinct("_w"), lambda x: F.struct(F.size(F.filter("_w", lambda y: y == x)).alias("n"), (-F.array_position("_w", x)).alias("first"), x.alias("w"))))["w"]
    t = once(t, "_k", usual)
    t = once(t, "_full", F.filter(F.transform("rows", lambda r, i: F.struct(i.alias("i"), F.size(r["amounts"]).alias("n"), r["ends"].alias("ends"))), lambda x: x["n"] == c("_k")))

    def placed(r: Column, i: Column) -> Column:
        near = F.array_min(F.transform(c("_full"), lambda x: F.struct(F.abs(x["i"] - i).alias("d"), x["i"].alias("i"), x["ends"].alias("ends"))))["ends"]
        cols = F.transform(r["ends"], lambda e: F.array_min(F.transform(near, lambda x, j: F.struct(F.abs(x - e).alias("d"), j.alias("j")))))
        fits = ~F.exists(cols, lambda x: x["d"] > PLACE_WITHIN) & (F.size(F.array_distinct(F.transform(cols, lambda x: x["j"]))) == F.size(cols))
        at = F.transform(cols, lambda x: x["j"])
        zero = F.lit(0).cast("bigint")
        cells = F.transform(F.sequence(F.lit(0), c("_k") - 1), lambda j: F.when(F.array_contains(at, j), F.get(r["amounts"], (F.array_position(at, j) - 1).cast("int"))).otherwise(zero))
        short = (F.size(r["amounts"]) < c("_k")) & (F.size(c("_full")) > 0)
        return F.when(short & F.coalesce(fits, F.lit(False)), r.withField("amounts", cells).withField("ends", near)).otherwise(r)

    return t.select(*[x for x in tables.columns if x != "rows"], F.transform("rows", placed).alias("rows"))


def _gap(v: Column, signs: Column) -> Column:
    middle = F.slice(v, 2, F.size(v) - 2)
    zero = F.lit(0).cast("bigint")
    signed = F.aggregate(F.zip_with(middle, signs, lambda x, s: x * s), zero, lambda a, x: a + x)
    return F.abs(F.element_at(v, -1) - F.element_at(v, 1) - signed)


def solve_signs(totals: Column, complete: Column) -> Column:
    """Signs of the middle columns such that the first column and the signed middle ones make the
    last, on the totals and on every complete row; fewest zeros first, at most seven columns."""
    m = F.size(totals) - 2
    codes = F.sequence(F.lit(0), F.pow(F.lit(3), m).cast("int") - 1)
    digits = lambda code: F.transform(F.sequence(F.lit(1), m), lambda p: F.element_at(
        F.array(F.lit(-1), F.lit(1), F.lit(0)), (F.floor(code / F.pow(F.lit(3), m - p)) % 3).cast("int") + 1))
    good = F.filter(F.transform(codes, lambda x: F.struct(F.size(F.filter(digits(x), lambda d: d == 0)).alias("zeros"), x.alias("code"), digits(x).alias("signs"))),
                    lambda s: (_gap(totals, s["signs"]) <= fv.ROUNDING_CENTS) & F.forall(complete, lambda a: _gap(a, s["signs"]) <= 2))
    return F.when((m >= 1) & (m <= 7), F.array_min(good)["signs"])


def validate_tables(tables: DataFrame, stated: str | None = None) -> DataFrame:
    """Adds width, sums, valid_columns, layout, signs and validation. ``stated`` names an array of
    amounts the document states, for one-column tables without a total line."""
    zero = F.lit(0).cast("bigint")
    t = once(tables, "width", F.when(F.size(F.array_distinct(F.transform("rows", lambda r: F.size(r["amounts"])))) == 1, F.size(F.element_at("rows", 1)["amounts"])))
    column = lambda j: F.transform("rows", lambda r: F.get(r["amounts"], j))
    sums = F.transform(F.sequence(F.lit(0), F.coalesce("width", F.lit(1)) - 1), lambda j: F.when(~F.exists(column(j), lambda x: x.isNull()), F.aggregate(column(j), zero, lambda a, x: a + x)))
    t = once(t, "sums", F.when(c("width").isNotNull(), sums))
    slack = F.greatest(F.lit(fv.ROUNDING_CENTS), F.floor((F.size("rows") + 1) / 2))
    readable = c("totals").isNotNull() & ~F.exists(F.coalesce("totals", F.array().cast("array<bigint>")), lambda x: x.isNull())
    usable = c("width").isNotNull() & readable
    partial = usable & (F.size("totals") < c("width"))
    last = F.when(partial, F.concat(F.array_repeat(F.lit(None).cast("bigint"), F.greatest(c("width") - F.size("totals"), F.lit(0))), c("totals"))) \
        .when(usable, F.slice("totals", -c("width"), c("width")))
    t = once(t, "column_totals", last)
    valid = F.zip_with("sums", "column_totals", lambda s, x: F.coalesce(F.abs(s - x) <= slack, F.lit(False)))
    t = once(t, "valid_columns", F.when(c("column_totals").isNotNull(), valid))
    complete = F.filter(F.transform("rows", lambda r: r["amounts"]), lambda a: ~F.exists(a, lambda x: x.isNull()))
    t = once(t, "_complete", complete)
    off_sum = lambda v: F.abs(F.element_at(v, -1) - F.aggregate(F.slice(v, 1, F.size(v) - 1), zero, lambda a, x: a + x))
    full = usable & ~partial
    is_sum = full & (c("width") > 1) & (off_sum(c("column_totals")) <= fv.ROUNDING_CENTS) & F.forall("_complete", lambda a: off_sum(a) <= 2)
    t = once(t, "_sum", F.coalesce(is_sum, F.lit(False)))
    t = once(t, "signs", F.when(full & (c("width") > 2) & ~c("_sum"), solve_signs(c("column_totals"), c("_complete"))))
    in_stated = F.coalesce(F.array_contains(stated, F.element_at("sums", 1)), F.lit(False)) if stated else F.lit(False)
    alone = c("totals").isNull() & (c("width") == 1)
    every = F.forall("valid_columns", lambda x: x)
    layout = (F.when(c("width").isNull(), F.lit("columns")).when(alone, F.lit("single")).when(c("totals").isNull() | ~readable, F.when(c("width") == 1, F.lit("single")).otherwise(F.lit("columns")))
              .when(partial, F.lit("last")).when(c("width") == 1, F.lit("single")).when(c("_sum"), F.lit("sum")).when(c("signs").isNotNull(), F.lit("net")).otherwise(F.lit("columns")))
    validation = (F.when(alone & in_stated, F.lit("stated_amount")).when(partial & F.element_at("valid_columns", -1), F.lit("column_totals"))
                  .when(full & every, F.lit("column_totals")))
    return t.withColumns({"layout": layout, "validation": validation,
                          "valid_columns": F.when(alone & in_stated, F.array(F.lit(True))).otherwise(c("valid_columns"))}).drop("_complete", "_sum")


def target_lines(tables: DataFrame, code: str) -> DataFrame:
    """Our row of each table with the amount its layout implies: the only column, the last after its
    components, or the first before what is withheld; validated if that column is."""
    at = F.when(c("layout").isin("single", "net"), F.lit(1)).when(c("layout").isin("sum", "last"), F.lit(-1))
    rows = tables.select("doc_id", "table", "layout", "validation", "valid_columns", F.size("rows").alias("n_rows"), at.alias("at"), F.explode("rows").alias("r")).filter(c("r.code") == code)
    amount = F.when(c("at").isNotNull(), F.try_element_at("r.amounts", c("at")))
    ok = F.coalesce(F.try_element_at("valid_columns", c("at")), F.lit(False))
    return rows.select("doc_id", "table", c("r.number").alias("number"), "n_rows", "layout", amount.alias("amount"),
                       F.when(c("layout") == "net", F.try_element_at("r.amounts", F.lit(-1))).otherwise(amount).alias("net"),
                       F.when(amount.isNotNull() & ok, F.coalesce("validation", F.lit("column_totals"))).alias("validation"))


def read_tables(docs: DataFrame) -> DataFrame:
    """Validated tables of documents (doc_id, subject, text)."""
    s = once(docs, "stated", F.concat(F.transform(F.regexp_extract_all(symbol_repair(c("text")), F.lit(STATED), 1), cents_eu),
                                      amounts_in(F.coalesce("subject", F.lit(""))))).select("doc_id", "stated")
    return validate_tables(allocation_tables(docs).join(s, "doc_id"), "stated").drop("stated")


def read_decisions(docs: DataFrame, code: str, manager: str, ours: str | None = None, sections: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, amount, net, method, validation, status): tables before letters, then lines naming us (the
    pattern ``ours``) whose amount the text states elsewhere, then our rows in tables closed by section
    totals (``sections``: patterns of rows and totals); 'absent' where every table is validated and
    none holds us, 'not_found' where nothing could be read."""
    # each way of reading takes the texts, and what they found decides twice: texts, tables and finds are derived once
    docs = written(docs.select("doc_id", "subject", "text"))
    tables = written(read_tables(docs).select("doc_id", "table", "rows", "layout", "validation", "valid_columns"))
    found = target_lines(tables, code).select("doc_id", F.lit(1).alias("rank"), "amount", "net", F.lit("table").alias("method"), "validation")
    more = [(2, "letter", letter_amounts(docs, manager).filter(c("ours")))]
    if ours:
        more.append((3, "stated_line", stated_lines(docs, ours)))
    if ours and sections:
        more.append((4, "section", section_rows(docs, *sections, ours)))
    for rank, method, df in more:
        found = found.unionByName(df.select("doc_id", F.lit(rank).alias("rank"), "amount", c("amount").alias("net"), F.lit(method).alias("method"), "validation"))
    found = written(found)
    best = found.groupBy("doc_id").agg(F.min("rank").alias("rank"))
    read = found.join(best, ["doc_id", "rank"], "left_semi").drop("rank").withColumn("status", F.lit("read"))
    seen = tables.groupBy("doc_id").agg(F.bool_and(c("validation").isNotNull()).alias("all_valid"))
    rest = (docs.select("doc_id").join(best, "doc_id", "left_anti").join(seen, "doc_id", "left")
            .select("doc_id", *[F.lit(None).cast(t).alias(n) for n, t in (("amount", "bigint"), ("net", "bigint"), ("method", "string"), ("validation", "string"))],
                    F.when(c("all_valid"), F.lit("absent")).otherwise(F.lit("not_found")).alias("status")))
    return read.unionByName(rest)

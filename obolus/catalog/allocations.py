"""EX7-EX12 and EX15: allocation tables printed from the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from obolus.catalog.documents import eu
from obolus.catalog.landing import q
from obolus.catalog.registry import query
from obolus.plans import allocations as al

c = F.col


def tables(b):
    """A table per order: one column, components and total, gross-withheld-net, a blank cell, or a
    total that is ten euros off; our row is the one coded 58000."""
    x = (c("price") * 100).cast("bigint")
    p = c("o_orderpriority")
    cell = lambda v: F.lpad(eu(v) if not isinstance(v, str) else F.lit(v), 18, " ")
    row = lambda n, code, name, *v: q(f"  {n}  {code}  {name}   ΝΟΜΟΣ ", *[cell(i) for i in v], "\n")
    total = lambda *v: q("          ΣΥΝΟΛΟ           ", *[cell(i) for i in v], "\n")
    one = q(row(1, "50100", "ΑΛΦΑΣ  ", x), row(2, "58000", "ΝΗΣΙΔΟΣ", x + 100), total(x + x + 100))
    added = q(row(1, "50100", "ΑΛΦΑΣ  ", x, x + 7, x + x + 7), row(2, "58000", "ΝΗΣΙΔΟΣ", x + 5, x, x + x + 5), total(x + x + 5, x + x + 7, x * 4 + 12))
    net = q(row(1, "50100", "ΑΛΦΑΣ  ", x + 5000, F.lit(1234), x + 3766), "     ΚΑΙ ΑΛΛΩΝ\n", row(2, "58000", "ΝΗΣΙΔΟΣ", x, F.lit(1000), x - 1000), total(x + x + 5000, F.lit(2234), x + x + 2766))
    blank = q(row(1, "50100", "ΑΛΦΑΣ  ", x, F.lit(500), x + 500), row(2, "58000", "ΝΗΣΙΔΟΣ", x, "", x), total(x + x, F.lit(500), x + x + 500))
    off = q(row(1, "50100", "ΑΛΦΑΣ  ", x), row(2, "58000", "ΝΗΣΙΔΟΣ", x + 100), total(x + x + 1100))
    text = F.when(p == "1-URGENT", one).when(p == "2-HIGH", added).when(p == "3-MEDIUM", net).when(p == "4-NOT SPECIFIED", blank).otherwise(off)
    return b.decisions.select(c("ada").alias("doc_id"), F.lit(None).cast("string").alias("subject"), text.alias("text"))


X = {"x": "SELECT ada AS doc_id, o_orderpriority AS p, CAST(price * 100 AS BIGINT) AS x FROM decisions"}
LAYOUT = "CASE p WHEN '2-HIGH' THEN 'sum' WHEN '3-MEDIUM' THEN 'net' WHEN '4-NOT SPECIFIED' THEN 'sum' ELSE 'single' END"
AMOUNT = "CASE p WHEN '2-HIGH' THEN x + x + 5 WHEN '3-MEDIUM' THEN x WHEN '4-NOT SPECIFIED' THEN x ELSE x + 100 END"


@query("ex07_allocation_rows", "SELECT doc_id, CAST(2 AS BIGINT) AS n_rows, CAST(CASE WHEN p IN ('1-URGENT', '5-LOW') THEN 1 ELSE 3 END AS BIGINT) AS width FROM x", X)
def _(b):
    return al.allocation_tables(tables(b)).select("doc_id", F.size("rows").alias("n_rows"), F.size(F.element_at("rows", 2)["amounts"]).alias("width"))


@query("ex10_table_layouts", f"SELECT doc_id, {LAYOUT} AS layout, CASE WHEN p <> '5-LOW' THEN 'column_totals' END AS validation, CASE WHEN p = '3-MEDIUM' THEN '-1' END AS signs FROM x", X)
def _(b):
    return al.read_tables(tables(b)).select("doc_id", "layout", "validation", "signs")


@query("ex12_target_lines", f"SELECT doc_id, {LAYOUT} AS layout, CAST({AMOUNT} AS BIGINT) AS amount, CAST(CASE WHEN p = '3-MEDIUM' THEN x - 1000 ELSE {AMOUNT} END AS BIGINT) AS net, CASE WHEN p <> '5-LOW' THEN 'column_totals' END AS validation FROM x", X)
def _(b):
    return al.target_lines(al.read_tables(tables(b)), "58000").select("doc_id", "layout", "amount", "net", "validation")


@query("ex08_named_tables", """SELECT doc_id, layout, CAST(amount AS BIGINT) AS amount, validation, CAST(n AS BIGINT) AS n_rows FROM (
    SELECT doc_id, 'sum' AS layout, x + x + 7 AS amount, 'column_totals' AS validation, 2 AS n FROM x WHERE p IN ('1-URGENT', '2-HIGH')
    UNION ALL SELECT doc_id, 'single', x, 'column_totals', 3 FROM x WHERE p = '3-MEDIUM' UNION ALL SELECT doc_id, 'single', x, NULL, 2 FROM x WHERE p = '4-NOT SPECIFIED')""", X)
def _(b):
    """Names in capitals under a first table, numbered rows with an end that does not add up before the one
    that does, a total that is off; the rest has no row of ours."""
    x = (c("price") * 100).cast("bigint")
    p = c("o_orderpriority")
    caps = q("ΠΙΝΑΚΑΣ\nΣΥΝΟΛΟ 5,00\n ΑΛΦΑΣ ", eu(x), "  ", eu(x), "  ", eu(x + x), "\n ΝΗΣΙΔΟΣ ", eu(x), "  ", eu(x + 7), "  ", eu(x + x + 7), "\n Σημείωση ", eu(x), "  ", eu(x), "  ", eu(x), "\n ΣΥΝΟΛΟ ", eu(x + x), "  ", eu(x + x + 7), "  ", eu(x * 4 + 7), "\n")
    numbered = q("1 50100 Άλφας ", eu(x), "\n2 58000 Νήσιδος ", eu(x), "\nΜΕΡΙΚΟ ΣΥΝΟΛΟ 1,00\n3 50300 Βήτα 7,00\nΣΥΝΟΛΟ ", eu(x + x + 700), "\n")
    off = q(" ΑΛΦΑΣ ", eu(x), "\n ΝΗΣΙΔΟΣ ", eu(x), "\n ΣΥΝΟΛΟ ", eu(x + x + 1000), "\n")
    text = F.when(p.isin("1-URGENT", "2-HIGH"), caps).when(p == "3-MEDIUM", numbered).when(p == "4-NOT SPECIFIED", off).otherwise(F.lit(" ΑΛΦΑΣ 5,00\n ΣΥΝΟΛΟ 5,00"))
    docs = b.decisions.select(c("ada").alias("doc_id"), F.lit(None).cast("string").alias("subject"), text.alias("text"))
    return al.target_lines(al.named_tables(docs, r"(?<!\p{L})ΝΗΣΙΔΟΣ(?!\p{L})", "58000"), "58000").select("doc_id", "layout", "amount", "validation", "n_rows")


@query("ex15_read_decision", f"""SELECT doc_id, CAST(CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN {AMOUNT} WHEN p = '3-MEDIUM' THEN 6000000 WHEN p = '4-NOT SPECIFIED' AND x % 2 = 0 THEN x + 1 WHEN p = '4-NOT SPECIFIED' THEN x END AS BIGINT) AS amount,
    CASE WHEN p <> '5-LOW' THEN 'read' WHEN x % 2 = 0 THEN 'absent' ELSE 'not_found' END AS status, CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN 'table' WHEN p = '3-MEDIUM' THEN 'letter' WHEN p = '4-NOT SPECIFIED' AND x % 2 = 0 THEN 'stated_line' WHEN p = '4-NOT SPECIFIED' THEN 'section' END AS method FROM x""", X)
def _(b):
    """Tables, letters, stated lines, section rows, a table without us, and nothing."""
    x = (c("price") * 100).cast("bigint")
    p, even = c("o_orderpriority"), x % 2 == 0
    letter = F.lit("το ποσό των εξήντα χιλιάδων ευρώ (60.000,00 €) με υπόλογο διαχειριστή το ΔΗΜΟ ΝΗΣΙΔΟΣ")
    stated = q("μεταφορά ποσού ", eu(x + 1), " για έργα\n  ΔΗΜΟΣ ΝΗΣΙΔΟΣ   ", eu(x + 1), "\n")
    section = q("α. ΔΗΜΟΣ ΝΗΣΙΔΟΣ έργο ", eu(x), "\nβ. ΔΗΜΟΣ ΑΛΛΟΣ έργο ", eu(x), "\nΣΥΝΟΛΑ ", eu(x + x), "\n")
    others = q("  1  50100  ΑΛΦΑΣ   ", F.lpad(eu(x), 18, " "), "\n  2  50200  ΒΗΤΑΣ   ", F.lpad(eu(x), 18, " "), "\n   ΣΥΝΟΛΟ  ", F.lpad(eu(x + x), 18, " "), "\n")
    rest = F.when(p == "3-MEDIUM", letter).when((p == "4-NOT SPECIFIED") & even, stated).when(p == "4-NOT SPECIFIED", section).when((p == "5-LOW") & even, others).otherwise(F.lit("χωρίς ποσά"))
    docs = tables(b).join(b.decisions.select(c("ada").alias("doc_id"), "o_orderpriority", "price"), "doc_id").withColumn("text", F.when(p.isin("1-URGENT", "2-HIGH"), c("text")).otherwise(rest)).select("doc_id", "subject", "text")
    amount = r"(\d{1,3}(?:\.\d{3})*,\d{2})"
    return al.read_decisions(docs, "58000", "ΔΙΑΧΕΙΡΙΣΤ[^.]{0,80}ΝΗΣΙΔΟΣ", "ΔΗΜΟΣ ΝΗΣΙΔΟΣ", (rf"^[ΑΒ]\. ΔΗΜΟΣ .* {amount}$", rf"^ΣΥΝΟΛΑ {amount}$")).select("doc_id", "amount", "status", "method")

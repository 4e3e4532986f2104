"""EX14, EX18-EX28 and JN17: documents of single kinds written from the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from obolus.catalog.documents import eu
from obolus.catalog.landing import q
from obolus.catalog.registry import query
from obolus.plans import allocations as al
from obolus.plans import readers as rd
from obolus.plans import transfers as tr
from obolus.plans.bindings import by_value
from obolus.session import written

c = F.col
BODY = "ΝΗΣΙΔΟΣ"
KINDS = {"1-URGENT": "region_payment", "2-HIGH": "fund_order", "3-MEDIUM": "union_share", "4-NOT SPECIFIED": "organisation_payment", "5-LOW": "circular"}


def cents():
    return (c("price") * 100).cast("bigint")


def payments(b):
    """Each order as a document of its priority's kind; the revoked orders' say something else: another
    payee, another total, another share, another net."""
    x, bad = cents(), c("o_orderstatus") == "P"
    off = F.when(bad, 1).otherwise(0)
    region = q("Δίνεται εντολή πληρωμής ευρώ: #", eu(x), "# (χίλια Ευρώ) στο δικαιούχο ΔΗΜΟΣ ΝΗΣΙΔΟΣ Διεύθυνση: Χώρα ΑΦΜ: ", F.when(bad, F.lit("111222333")).otherwise(F.lit("999000111")),
               " ΣΥΝΟΛΟ ΚΡΑΤΗΣΕΩΝ: 10,50 ΕΝΤΕΛΛΟΜΕΝΟ ΠΟΣΟ ΣΤΟ ΔΙΚΑΙΟΥΧΟ: ", eu(x - 1050))
    fund = q("συνολικού ποσού ", eu(x), " ευρώ ΣΥΝΟΛΙΚΗ ΑΞΙΑ ΠΑΡΑΣΤΑΤΙΚΟΥ ", eu(x + off), " Δικαιούχου/ων: ΔΗΜΟΣ ΝΗΣΙΔΟΣ (ΑΦΜ: 999000111)")
    share = q("Α Π Ο Φ Α Σ Ι Ζ Ε Ι δαπάνη ", eu(x * 4 + off), " ευρώ (", eu(x), " ευρώ χ 4 Δήμοι)")
    org = q("ΔΙΚΑΙΟΥΧΟΣ : ΔΗΜΟΣ ΝΗΣΙΔΟΣ ( ΑΦΜ:888000111 )\nΕΝΤΕΛΛΟΜΕΝΟ  ΣΥΝΟΛΟ  ΠΛΗΡΩΤΕΟ ", F.when(bad, F.lit("12.000,01")).otherwise(F.lit("12.000,00")), " 360,00 11.640,00 ΣΥΝΟΛΟ ΕΝΤΑΛΜΑΤΟΣ : Δώδεκα Χιλιάδες Ευρώ")
    p = c("o_orderpriority")
    text = F.when(p == "1-URGENT", region).when(p == "2-HIGH", fund).when(p == "3-MEDIUM", share).when(p == "4-NOT SPECIFIED", org).otherwise(F.lit("εγκύκλιος ποσού 5,00"))
    return b.decisions.select(c("ada").alias("doc_id"), by_value(p, KINDS).alias("kind"), text.alias("text"))


X = {"x": "SELECT ada AS doc_id, o_orderpriority AS p, o_orderstatus = 'P' AS bad, CAST(price * 100 AS BIGINT) AS x, c_mktsegment AS seg FROM decisions"}


@query("ex18_readers_by_kind", """SELECT doc_id, CAST(CASE WHEN p = '1-URGENT' AND bad THEN NULL WHEN p = '4-NOT SPECIFIED' THEN CASE WHEN bad THEN 1200001 ELSE 1200000 END WHEN p = '5-LOW' THEN NULL ELSE x END AS BIGINT) AS amount,
    CAST(CASE WHEN p = '1-URGENT' THEN CASE WHEN NOT bad THEN x - 1050 END WHEN p = '4-NOT SPECIFIED' THEN 1164000 WHEN p = '5-LOW' THEN NULL ELSE x END AS BIGINT) AS net,
    CASE WHEN p = '5-LOW' THEN 'listed' WHEN p = '1-URGENT' AND bad THEN 'absent' ELSE 'read' END AS status,
    CASE WHEN p IN ('2-HIGH', '3-MEDIUM') AND NOT bad THEN 'stated_amount' WHEN p = '4-NOT SPECIFIED' AND NOT bad THEN 'words_and_figures' WHEN p = '1-URGENT' AND NOT bad AND x = 100000 THEN 'words_and_figures' END AS validation FROM x""", X)
def _(b):
    return rd.read_by_kind(payments(b), rd.configurations(BODY, "999000111", ("888000111",)))


@query("ex20_decision_items", """SELECT doc_id, '1' AS recipient, 6000000 AS amount, 'words_and_figures' AS validation, seg = 'BUILDING' AS statutory FROM x WHERE seg <> 'MACHINERY'
    UNION ALL SELECT doc_id, '2', x, 'figures_only', false FROM x""", X)
def _(b):
    seg = c("c_mktsegment")
    first = q("καταβολή ποσού εξήντα χιλιάδων ευρώ (60.000,00 €) στον Δήμο ", F.when(seg == "MACHINERY", F.lit("Άνδρου")).otherwise(F.lit("Νησίδος")), F.when(seg == "BUILDING", F.lit(", τακτική επιχορήγηση ")).otherwise(F.lit(" ")))
    text = q("Η επιτροπή αποφασίζει: 1) ", first, "2) καταβολή ποσού ", eu(cents()), " έναντι στη Σχολική Επιτροπή")
    items = rd.decision_items(b.decisions.select(c("ada").alias("doc_id"), text.alias("text")), (("2", "ΣΧΟΛΙΚ[Α-Ω]* ΕΠΙΤΡΟΠ"),), BODY, "1")
    return items.select("doc_id", "recipient", "amount", "validation", "statutory")


@query("ex23_escrow", """SELECT doc_id, unnest(['escrow_release', 'escrow_deposit']) AS method, unnest([x, x + 700]) AS amount, unnest([CASE WHEN NOT bad THEN 'stated_amount' END, 'stated_amount']) AS validation FROM x""", X)
def _(b):
    x = cents()
    off = F.when(c("o_orderstatus") == "P", 1).otherwise(0)
    text = q("με προϋπολογισμού ", eu(x + x + 700 + off), " € ομόφωνα αποφασίζουν Να εκταμιεύσει από τον λογαριασμό το ποσό των ", eu(x), " € σύστασης παρακαταθήκης υπέρ του Δήμου Νησίδος ποσού ύψους ", eu(x + 700),
             " € εξόφλησης παρακαταθήκης υπέρ του Δήμου Νησίδος ποσού ύψους ", eu(x + 700), " €")
    return rd.escrow_amounts(b.decisions.select(c("ada").alias("doc_id"), text.alias("text")), BODY)


@query("ex14_split_two_purpose", """SELECT doc_id, unnest([x, x + 5]) AS amount, unnest([NULL, 'kap_supplementary']) AS family FROM x WHERE NOT bad UNION ALL SELECT doc_id, x + x + 5, NULL FROM x WHERE bad""", X)
def _(b):
    x = cents()
    other = F.when(c("o_orderstatus") == "P", 7).otherwise(0)
    cell = lambda v: F.lpad(eu(v), 18, " ")
    text = q("για το ποσό των ", eu(x + 12 + x + other), "€ σε χρέωση του λογαριασμού με τίτλο «Κεντρικοί Αυτοτελείς Πόροι»:\n  1  50100  ΑΛΦΑΣ  Α ", cell(x + 11), cell(x + 7), cell(x + x + 18),
             "\n  2  58000  ΝΗΣΙΔΟΣ  Β ", cell(x), cell(x + 5), cell(x + x + 5), "\n    ΣΥΝΟΛΟ   ", cell(x + x + 11), cell(x + x + 12), cell(x * 4 + 23), "\n")
    docs = written(b.decisions.select(c("ada").alias("doc_id"), F.lit(None).cast("string").alias("subject"), text.alias("text")))
    tables = written(al.read_tables(docs))  # lines and tables are both read from it
    return rd.split_two_purpose(al.target_lines(tables, "58000"), tables, docs, "58000", "kap_supplementary").select("doc_id", "amount", "family")


@query("jn17_containment_join", """SELECT ada AS doc_id FROM decisions WHERE EXISTS (SELECT 1 FROM part WHERE contains('ΣΥΜΒΑΣΗ ΓΙΑ ' || upper(p_name) || ' ' || upper(p_type) || ' ΤΕΛΟΣ', CASE o_orderstatus WHEN 'F' THEN 'RED WIDGET PROMO' WHEN 'P' THEN 'BLUE BOLT' ELSE 'GREEN NO SUCH' END))
    AND o_orderstatus <> 'P'""")
def _(b):
    sub = F.when(c("o_orderstatus") == "F", F.lit("red  widget promo")).when(c("o_orderstatus") == "P", F.lit("blue bolt")).otherwise(F.lit("green no such"))
    agreements = b.star.part.select(q("Σύμβαση για ", c("p_name"), " ", c("p_type"), " τέλος").alias("subject"))
    return rd.under_agreement(b.decisions.select(c("ada").alias("doc_id"), sub.alias("sub_project")), agreements)


@query("jn18_letterheads", "SELECT ada AS doc_id, '9' AS other FROM decisions WHERE entity = '3' UNION ALL SELECT ada, '0' FROM decisions WHERE entity = '9'")
def _(b):
    from obolus.plans.documents import foreign_letterheads
    text = F.when(c("entity") == "3", F.lit("ΕΛΛΗΝΙΚΗ ΔΗΜΟΚΡΑΤΙΑ\n\n  ΜΟΥΣΕΙΟ ΧΑΛΚΙΝΟΥ ΑΛΟΓΟΥ\nx")).otherwise(F.lit("Ελληνική Δημοκρατία\n ΔΗΜΟΣ ΝΗΣΙΔΟΣ\n"))
    names = b.entity.select("uid", F.when(c("uid") == "9", F.lit("Μουσείο Χάλκινου Αλόγου")).when(c("uid") == "3", F.lit("Λιμενικό Ταμείο Νησίδος")).otherwise(F.lit("Δήμος Νησίδος")).alias("name"))
    return foreign_letterheads(b.decisions.select(c("ada").alias("doc_id"), "entity", text.alias("text")), names)


TABLE_PAYEES = (tr.Payee("2", "800111222", r"Δ\.?Λ\.?Τ\.? ΝΗΣΙΔΟΣ"), tr.Payee("1", "999000111", "ΔΗΜΟ[ΣΥ]? ΝΗΣΙΔΟΣ", ("2019ΣΕ05510009",)))


@query("ex25_transfer_rows", """SELECT doc_id, CAST(line AS BIGINT) AS line, amount, recipient, validation, how FROM (
    SELECT doc_id, 1 AS line, x AS amount, '1' AS recipient, CASE WHEN NOT bad THEN 'stated_amount' END AS validation, 'the total''s column (±3)' AS how FROM x WHERE seg IN ('AUTOMOBILE', 'BUILDING')
    UNION ALL SELECT doc_id, 3, x + 5, '2', CASE WHEN NOT bad THEN 'stated_amount' END, 'the total''s column (±3)' FROM x WHERE seg IN ('AUTOMOBILE', 'BUILDING')
    UNION ALL SELECT doc_id, 0, x, '1', 'stated_amount', 'payment lines' FROM x WHERE seg = 'MACHINERY' AND NOT bad
    UNION ALL SELECT doc_id, 1, x, '1', 'stated_amount', 'lines with a project code' FROM x WHERE seg = 'FURNITURE' AND NOT bad)""", X)
def _(b):
    """Tables in columns (also with English figures), payment lines, rows told by their codes alone. The
    revoked orders' totals do not add up."""
    x, seg = cents(), c("c_mktsegment")
    off = F.when(c("o_orderstatus") == "P", 1).otherwise(0)
    english = lambda v: F.translate(F.concat(F.format_string("%,d", F.floor(v / 100).cast("bigint")), F.lit(";"), F.lpad((v % 100).cast("string"), 2, "0")), ";", ".")

    def table(show):
        cell = lambda v: F.lpad(show(v), 18, " ")
        return q("ΠΙΝΑΚΑΣ\n  1  2019ΣΕ05510001  ΔΗΜΟΣ ΝΗΣΙΔΟΣ   ", cell(x), "\n      συνέχεια του έργου\n  2  2019ΣΕ05510002  ΑΛΛΟΣ ΦΟΡΕΑΣ    ", cell(x + 5), "\n      ΑΦΜ 800111222\n  3  2019ΣΕ05510003  ΤΡΙΤΟΣ ΔΗΜΟΣ    ", cell(x),
                 "\n     ΣΥΝΟΛΟ                          ", cell(x * 3 + 5 + off), "\nτέλος")

    orders = q("79262223  ΔΗΜΟΣ ΝΗΣΙΔΟΣ  ", eu(x), "\n79262224  ΑΛΛΟΣ ΔΗΜΟΣ  ", eu(x), "\nσυνολικού ποσού ", eu(x * 2 + off), " ευρώ")
    coded = q("ΠΙΝΑΚΑΣ προϋπολογισμού 1,00\n2019ΣΕ05510009 έργο ", eu(x), "\nάλλο ποσό 3,00 μεταξύ των γραμμών\n2019ΣΕ05510004 έργο ", eu(x), "\nΣΥΝΟΛΟ των έργων όλης της συλλογικής απόφασης αυτής ", eu(x * 2 + off))
    text = F.when(seg == "AUTOMOBILE", table(english)).when(seg == "BUILDING", table(eu)).when(seg == "MACHINERY", orders).when(seg == "FURNITURE", coded).otherwise(F.lit("χωρίς πίνακα"))
    return tr.transfer_rows(b.decisions.select(c("ada").alias("doc_id"), text.alias("text")), TABLE_PAYEES).withColumn("line", c("line").cast("bigint"))


@query("ex21_other_grantors", """SELECT doc_id, CAST(CASE seg WHEN 'HOUSEHOLD' THEN NULL WHEN 'AUTOMOBILE' THEN 6000000 WHEN 'BUILDING' THEN CASE WHEN NOT bad THEN x + x + 5 END WHEN 'FURNITURE' THEN CASE WHEN NOT bad THEN x + 7 END ELSE x + 3 END AS BIGINT) AS amount,
    CASE WHEN seg = 'HOUSEHOLD' OR (bad AND seg IN ('BUILDING', 'FURNITURE')) THEN NULL WHEN seg = 'AUTOMOBILE' THEN '2' WHEN seg = 'MACHINERY' THEN '1' ELSE '3' END AS recipient,
    CASE WHEN seg = 'HOUSEHOLD' OR (bad AND seg IN ('BUILDING', 'FURNITURE')) THEN NULL WHEN seg = 'AUTOMOBILE' THEN CASE WHEN NOT bad THEN 'words_and_figures' END ELSE 'stated_amount' END AS validation,
    CASE WHEN seg = 'AUTOMOBILE' OR seg = 'MACHINERY' OR (seg IN ('BUILDING', 'FURNITURE') AND NOT bad) THEN 'read' ELSE 'not_found' END AS status,
    CASE WHEN seg = 'BUILDING' AND NOT bad THEN 'column' WHEN seg = 'FURNITURE' AND NOT bad THEN 'table' WHEN seg = 'MACHINERY' THEN 'rows' END AS how FROM x""", X)
def _(b):
    """A letter, a table with its total's column, a table stated as a whole, a run of rows, and nothing of ours;
    the revoked orders' words or totals are off."""
    x, seg = cents(), c("c_mktsegment")
    bad = c("o_orderstatus") == "P"
    off = F.when(bad, 1).otherwise(0)
    cell = lambda v: F.lpad(eu(v), 18, " ")
    letter = q("αποφασίζουμε την επιχορήγηση ύψους ", F.when(bad, F.lit("εξήντα μίας")).otherwise(F.lit("εξήντα")), " χιλιάδων ευρώ (60.000,00 €) στη Σχολική Επιτροπή")
    column = q("Σας παρακαλούμε για το ΑΦΜ 800111222:\nτιμολόγιο 1 ", cell(x), "   9,99\nτιμολόγιο 2 ", cell(x + 5), "   8,88\n    ΣΥΝΟΛΟ  ", cell(x + x + 5 + off), "\nΥΠΟΛΟΙΠΟ 1,23")
    table = q("Κατανέμουμε ποσό ", eu(x + 7 + off), " στο ΑΦΜ 800111222\n α ", eu(x), "\n β 0,04 και 0,03\n")
    rows = q("Σας παρακαλούμε μεταφορά ποσού € ", eu(x + 3), " στο Δήμο Νησίδος\n α ", eu(x), "\n β 5,55 ακυρώθηκε, ισχύει 0,03\n γ ", eu(x), "\n")
    text = F.when(seg == "AUTOMOBILE", letter).when(seg == "BUILDING", column).when(seg == "FURNITURE", table).when(seg == "MACHINERY", rows).otherwise(F.lit("αποφασίζουμε για άλλους ποσό 5,00"))
    docs = b.decisions.select(c("ada").alias("doc_id"), F.lit(None).cast("string").alias("subject"), text.alias("text"))
    return tr.other_grants(docs, (("2", "ΣΧΟΛΙΚ[Α-Ω]* ΕΠΙΤΡΟΠ"),), {"800111222": "3"}, BODY, "1").select("doc_id", "amount", "recipient", "validation", "status", "how")


@query("ex26_transfer_letters", """SELECT doc_id, CAST(CASE WHEN seg = 'BUILDING' THEN x WHEN seg = 'AUTOMOBILE' THEN 6000000 END AS BIGINT) AS amount, CASE WHEN seg IN ('BUILDING', 'AUTOMOBILE') THEN '1' END AS recipient,
    CASE seg WHEN 'BUILDING' THEN 'table' WHEN 'AUTOMOBILE' THEN 'letter' END AS method, CASE WHEN seg = 'BUILDING' AND NOT bad THEN 'stated_amount' WHEN seg = 'AUTOMOBILE' AND NOT bad THEN 'words_and_figures' END AS validation,
    CASE WHEN seg IN ('BUILDING', 'AUTOMOBILE') THEN 'read' WHEN seg = 'MACHINERY' THEN 'not_found' ELSE 'absent' END AS status FROM x""", X)
def _(b):
    """A table, a letter to the account that the home body manages, one that names it without either, others'."""
    x, seg = cents(), c("c_mktsegment")
    bad = c("o_orderstatus") == "P"
    table = q("  1  έργο ΔΗΜΟΣ ΝΗΣΙΔΟΣ ", F.lpad(eu(x), 18, " "), "\n     ΣΥΝΟΛΟ" + " " * 13, F.lpad(eu(x + F.when(bad, 1).otherwise(0)), 18, " "))
    letter = q("μεταφορά ποσού ", F.when(bad, F.lit("εξήντα μίας")).otherwise(F.lit("εξήντα")), " χιλιάδων ευρώ (60.000,00 €) με υπόλογο διαχειριστή το Δήμο Νησίδος, ΑΦΜ 999000111")
    text = F.when(seg == "BUILDING", table).when(seg == "AUTOMOBILE", letter).when(seg == "MACHINERY", F.lit("για το ΔΗΜΟ ΝΗΣΙΔΟΣ χωρίς ποσό")).otherwise(F.lit("άλλος φορέας ποσού 5,00"))
    docs = b.decisions.select(c("ada").alias("doc_id"), F.lit(None).cast("string").alias("subject"), text.alias("text"))
    return tr.read_transfers(docs, TABLE_PAYEES, r"ΥΠΟΛΟΓΟ[\p{L}]*.{0,3}ΔΙΑΧΕΙΡΙΣΤ[\p{L}]*.{0,80}?ΔΗΜΟ[\p{L}]* ΝΗΣΙΔΟΣ")

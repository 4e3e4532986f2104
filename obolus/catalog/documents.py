"""EX: documents generated from the orders, so that what must be read is known from the order."""

from __future__ import annotations

from pyspark.sql import functions as F

from obolus.catalog.landing import q
from obolus.catalog.oracle import pick
from obolus.catalog.registry import query
from obolus.functions.money import format_amount_eu
from obolus.plans import documents as dx

c = F.col


def eu(cents):
    return format_amount_eu(cents)


def statements(b):
    """A statement per order in one of the layouts; the low-priority ones are off by a cent."""
    x = (c("price") * 100).cast("bigint")
    y, z = x + 100, x + 250
    p = c("o_orderpriority")
    row = lambda code, name, *a: q(code, "     ", name, *[s for v in a for s in ("      ", eu(v))], "\n")
    off = F.when(p == "5-LOW", 1).otherwise(0)
    standard = q("Στοιχεία Εκτέλεσης Προϋπολογισµού\n  Περίοδος: ∆εκέµβριος ", c("year").cast("string"), "\n", row("0111", "Μισθώματα  ακινήτων", x, y, z), row("0129", "Λοιπά έσοδα", y, z, x),
                 "   ΣΥΝΟΛΟ ΕΣΟΔΩΝ  ", eu(x + y), "  ", eu(y + z), "  ", eu(z + x + off), "\n", row("6011", "Αποδοχές", z, x, y), "   ΣΥΝΟΛΟ ΕΞΟΔΩΝ  ", eu(z), "  ", eu(x), "  ", eu(y), "\n")
    cumulative = q("ΑΠΟΛΟΓΙΣΤΙΚΑ ΣΤΟΙΧΕΙΑ\n Περίοδος: Φεβρουάριος ", c("year").cast("string"), "\n", row("0", "ΤΑΚΤΙΚΑ", x, y, z), row("0111", "Μισθώματα", x, y, z), row("0111.0001", "Μισθώματα", x, y, z),
                   "-   ΓΕΝΙΚΟ ΣΥΝΟΛΟ  ", eu(x), "  ", eu(y), "  ", eu(z), "\n", row("6056", "Εισφορά", x, y, z), row("6056", "Εισφορά άλλης υπηρεσίας", y, z, x), "-  ΓΕΝΙΚΟ ΣΥΝΟΛΟ  ", eu(x + y), "  ", eu(y + z), "  ", eu(z + x), "\n")
    s2025 = q("  ΚΑΤΑΣΤΑΣΗ ΕΚΤΕΛΕΣΗΣ ΠΡΟΫΠΟΛΟΓΙΣΜΟΥ ΕΣΟΔΩΝ ΕΩΣ 31/12/", c("year").cast("string"), "\n0111      Μισθώματα\n        ", eu(x), "\n     παρ. 5 του άρ.", eu(y), "\n        ν. 4635/2019,", eu(z), "\n   ΓΕΝΙΚΟ ΣΥΝΟΛΟ:  ",
              eu(x), "  ", eu(y), "  ", eu(z), "\n Σελίδα 3\n  ΚΑΤΑΣΤΑΣΗ ΕΚΤΕΛΕΣΗΣ ΠΡΟΫΠΟΛΟΓΙΣΜΟΥ ΔΑΠΑΝΩΝ ΕΩΣ 31/12/", c("year").cast("string"), "\n00-6031              ", eu(z), "\n     Αποδοχές (άρθρα 230,242)   ", eu(x), "   ", eu(y),
              "\n9111   Αποθεματικό   ", eu(x), "   0,00   0,00\n    ΓΕΝΙΚΟ ΣΥΝΟΛΟ:  ", eu(z + x), "   ", eu(x), "   ", eu(y), "\n")
    pad = F.lpad(eu(y), 60, " ")
    s2026 = q("  ΚΑΤΑΣΤΑΣΗ ΕΚΤΕΛΕΣΗΣ ΠΡΟΫΠΟΛΟΓΙΣΜΟΥ ΕΣΟΔΩΝ ΕΩΣ 31/3/", c("year").cast("string"), "\n010.1310101   ΚΑΠ για γενικές ανάγκες  ", eu(x), "    ", eu(y), "   ", eu(z), "\n ΓΕΝΙΚΟ ΣΥΝΟΛΟ:  ", eu(x), "  ", eu(y), "  ", eu(z),
              "\n  ΚΑΤΑΣΤΑΣΗ ΕΚΤΕΛΕΣΗΣ ΠΡΟΫΠΟΛΟΓΙΣΜΟΥ ΔΑΠΑΝΩΝ ΕΩΣ 31/3/", c("year").cast("string"), "\n255.2130102001   Αμοιβές\n", F.lpad(eu(x), 30, " "), "\n", F.lpad(q("ενιαίου μισθολογίου ", eu(z)), 90, " "), " και το\n", pad,
              "\n ΓΕΝΙΚΟ ΣΥΝΟΛΟ:  ", eu(x), "  ", eu(y), "  ", eu(z), "\n")
    text = F.when(p == "2-HIGH", cumulative).when(p == "3-MEDIUM", s2025).when(p == "4-NOT SPECIFIED", s2026).otherwise(standard)
    return b.decisions.select(c("ada").alias("doc_id"), "entity", c("date").alias("statement_date"), text.alias("text"))


X = {"x": "SELECT ada AS doc_id, entity, year, o_orderpriority AS p, CAST(price * 100 AS BIGINT) AS x, CAST(price * 100 AS BIGINT) + 100 AS y, CAST(price * 100 AS BIGINT) + 250 AS z FROM decisions",
     "read": """SELECT doc_id, 'standard' AS layout, make_date(year, 12, 31) AS period_end, 'revenue' AS side, NULL AS service, '0111' AS kae, 'Μισθώματα ακινήτων' AS description, x AS b, y AS a, z AS c FROM x WHERE p = '1-URGENT'
    UNION ALL SELECT doc_id, 'standard', make_date(year, 12, 31), 'revenue', NULL, '0129', 'Λοιπά έσοδα', y, z, x FROM x WHERE p = '1-URGENT' UNION ALL SELECT doc_id, 'standard', make_date(year, 12, 31), 'spending', NULL, '6011', 'Αποδοχές', z, x, y FROM x WHERE p = '1-URGENT'
    UNION ALL SELECT doc_id, 'cumulative', last_day(make_date(year, 2, 1)), 'revenue', NULL, '0111', 'Μισθώματα', x, y, z FROM x WHERE p = '2-HIGH' UNION ALL SELECT doc_id, 'cumulative', last_day(make_date(year, 2, 1)), 'spending', NULL, '6056', 'Εισφορά', x + y, y + z, z + x FROM x WHERE p = '2-HIGH'
    UNION ALL SELECT doc_id, '2025', make_date(year, 12, 31), 'revenue', NULL, '0111', 'Μισθώματα', x, y, z FROM x WHERE p = '3-MEDIUM' UNION ALL SELECT doc_id, '2025', make_date(year, 12, 31), 'spending', '00', '6031', 'Αποδοχές (άρθρα 230,242)', z, x, y FROM x WHERE p = '3-MEDIUM'
    UNION ALL SELECT doc_id, '2025', make_date(year, 12, 31), 'spending', NULL, '9111', 'Αποθεματικό', x, 0, 0 FROM x WHERE p = '3-MEDIUM'
    UNION ALL SELECT doc_id, '2026', make_date(year, 3, 31), 'revenue', '010', '1310101', 'ΚΑΠ για γενικές ανάγκες', x, y, z FROM x WHERE p = '4-NOT SPECIFIED' UNION ALL SELECT doc_id, '2026', make_date(year, 3, 31), 'spending', '255', '2130102001', 'Αμοιβές', x, y, z FROM x WHERE p = '4-NOT SPECIFIED'"""}
COLS = "doc_id layout period_end:d side service kae description budgeted:i assessed_or_warranted:i collected_or_paid:i"


@query("ex01_statement_lines", pick(COLS, "(SELECT * EXCLUDE (a, b, c), b AS budgeted, a AS assessed_or_warranted, c AS collected_or_paid FROM read)"), X)
def _(b):
    return dx.extract_statements(statements(b))[0]


@query("ex04_detect_layout", "SELECT doc_id, CASE WHEN p = '2-HIGH' THEN 'cumulative' WHEN p IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'sections' ELSE 'standard' END AS layout FROM x", X)
def _(b):
    return statements(b).select("doc_id", dx.detect_layout(c("text")).alias("layout"))


@query("ex05_refused_statements", "SELECT doc_id, 'revenue does not add up' AS reason FROM x WHERE p = '5-LOW'", X)
def _(b):
    return dx.extract_statements(statements(b))[1]


@query("ex06_budget_lines", pick("statement_ada entity period_year:i period_month:i is_year_end side kae_group collected_or_paid:i",
       "(SELECT r.doc_id AS statement_ada, x.entity, year(period_end) AS period_year, month(period_end) AS period_month, month(period_end) = 12 AS is_year_end, side, substr(kae, 1, 2) AS kae_group, c AS collected_or_paid FROM read r JOIN x USING (doc_id) WHERE x.entity NOT IN ('3', '9'))"), X)
def _(b):
    """Entity 3 posts under entity 9's letterhead, entity 9 under another's."""
    head = F.when(c("entity") == "3", F.lit("ΕΛΛΗΝΙΚΗ ΔΗΜΟΚΡΑΤΙΑ\n\n  ΜΟΥΣΕΙΟ ΧΑΛΚΙΝΟΥ ΑΛΟΓΟΥ\n")).otherwise(F.lit("Ελληνική Δημοκρατία\n ΔΗΜΟΣ ΝΗΣΙΔΟΣ\n"))
    names = b.entity.select("uid", F.when(c("uid") == "9", F.lit("Μουσείο Χάλκινου Αλόγου")).when(c("uid") == "3", F.lit("Λιμενικό Ταμείο Νησίδος")).otherwise(F.lit("Δήμος Νησίδος")).alias("name"))
    docs = statements(b).withColumn("text", F.concat(head, "text"))
    return dx.budget_lines(docs, names)[0].select("statement_ada", "entity", "period_year", "period_month", "is_year_end", "side", "kae_group", "collected_or_paid")


def letters(b):
    """A transfer letter per line item: quantity thousand and some euros, in words and figures; the
    returned ones' words say another amount."""
    from obolus.catalog.functions import HUNDREDS, spelled
    qty = c("l_quantity").cast("int")
    hundred = F.array(*[F.lit(x) for x in HUNDREDS])[c("l_linenumber")]
    said = F.when(c("l_returnflag") == "R", qty + 1).otherwise(qty)
    fig = eu((qty * 1000 + c("l_linenumber") * 100) * 100)
    who = F.when(c("l_linestatus") == "F", F.lit("Διαχειριστής είναι ο Δήμος Νησίδος")).otherwise(F.lit("Διαχειριστής είναι άλλος"))
    text = q("με το ποσό των ", spelled(said), " χιλιάδων ", hundred, "\n ευρώ (", fig, " €). ", who)
    key = F.concat_ws("-", c("ada"), c("l_linenumber").cast("string"), c("l_partkey").cast("string"), c("l_suppkey").cast("string"), qty.cast("string"), c("l_extendedprice").cast("string"))
    return b.lines.select(key.alias("doc_id"), text.alias("text"))


@query("ex13_letter_amounts", """SELECT amount, ours, validation, count(*) AS n FROM (SELECT (CAST(l_quantity AS BIGINT) * 1000 + l_linenumber * 100) * 100 AS amount, l_linestatus = 'F' AS ours,
    CASE WHEN l_returnflag <> 'R' THEN 'words_and_figures' END AS validation FROM lines) GROUP BY ALL""")
def _(b):
    return dx.letter_amounts(letters(b), r"ΔΙΑΧΕΙΡΙΣΤ[^.]{0,80}ΝΗΣΙΔΟΣ").groupBy("amount", "ours", "validation").agg(F.count("*").alias("n"))


def section_tables(b):
    x = (c("price") * 100).cast("bigint")
    off = F.when(c("o_orderstatus") == "P", 1).otherwise(0)
    row = lambda i, name, v: q("  ", str(i), "   Δήμος ", name, "     18053    Έργο  υποδομής      ", eu(v), "     ΔΟΥ\n")
    text = q("Νομός\n", row(1, "Άνδρου", x), row(2, "Νησίδος", x + 5), "ΣΥΝΟΛΑ   Αριθμός φορέων: 2    ", eu(x + x + 5 + off), "\n", row(1, "Νησίδος", x + 7), "ΣΥΝΟΛΑ   Αριθμός φορέων: 1    ", eu(x + 7), "\n")
    return b.decisions.select(c("ada").alias("doc_id"), text.alias("text"))


SECTION_ROW = rf"^\s*\d{{1,4}}\s+ΔΗΜΟΣ\s.*?\s\d{{2,6}}\s{{2,}}\S.*?\s({dx.A})\s{{2,}}\S+\s*$"
SECTION_TOTAL = rf"^ΣΥΝΟΛΑ\s.*ΑΡΙΘΜΟΣ ΦΟΡΕΩΝ.*?\s({dx.A})\s*$"


@query("ex16_section_tables", """SELECT ada AS doc_id, CAST(s AS BIGINT) AS section, CAST(price * 100 AS BIGINT) + CASE s WHEN 0 THEN 5 ELSE 7 END AS amount, CASE WHEN s = 1 OR o_orderstatus <> 'P' THEN 'stated_amount' END AS validation
    FROM (SELECT *, unnest([0, 1]) AS s FROM decisions)""")
def _(b):
    return dx.section_rows(section_tables(b), SECTION_ROW, SECTION_TOTAL, r"(?<!\p{L})ΝΗΣΙΔΟΣ(?!\p{L})").select("doc_id", "section", "amount", "validation")


@query("ex17_id_rows", """SELECT ada AS doc_id, CAST(price * 100 AS BIGINT) AS amount, CASE WHEN o_orderstatus <> 'P' THEN 'stated_amount' END AS validation FROM decisions""")
def _(b):
    x = (c("price") * 100).cast("bigint")
    off = F.when(c("o_orderstatus") == "P", 1).otherwise(0)
    text = q("συνολικό ποσό των ", eu(x + x + 9 + off), " €\nΔήμος Νησίδος 999000111  ", eu(x), "\nάλλος 888000111  ", eu(x + 9), " €\n")
    return dx.id_rows(b.decisions.select(c("ada").alias("doc_id"), text.alias("text")), "999000111").select("doc_id", "amount", "validation")


@query("ex17_stated_lines", "SELECT ada AS doc_id, CAST(price * 100 AS BIGINT) AS amount FROM decisions")
def _(b):
    x = (c("price") * 100).cast("bigint")
    text = q("κατανομή ποσού ", eu(x), "\nΝησίδος  ", eu(x), "  ", eu(x + 3), "\nΆνδρου  ", eu(x))
    return dx.stated_lines(b.decisions.select(c("ada").alias("doc_id"), text.alias("text")), r"(?<!\p{L})ΝΗΣΙΔΟΣ(?!\p{L})").select("doc_id", "amount")


@query("ex10_validate_columns", """SELECT o_custkey, count(*) AS n, bool_and(ok) AS adds_up FROM (SELECT o_custkey, (sum(CAST(price * 100 AS BIGINT)) OVER w % 40) <= greatest(10, (count(*) OVER w + 1) // 2) AS ok FROM decisions WINDOW w AS (PARTITION BY o_custkey)) GROUP BY 1""")
def _(b):
    """Tables per customer whose printed total misses the rows' sum by its last digits."""
    rows = b.decisions.select("o_custkey", (c("price") * 100).cast("bigint").alias("amount"))
    totals = rows.groupBy("o_custkey").agg(F.sum("amount").alias("s")).select("o_custkey", (c("s") - F.pmod(c("s"), F.lit(40))).alias("total"))
    checked = dx.rows_against_total(rows, totals, ["o_custkey"], dx.rounding_tolerance(c("n")))
    return checked.groupBy("o_custkey").agg(F.count("*").alias("n"), F.bool_and("adds_up").alias("adds_up"))

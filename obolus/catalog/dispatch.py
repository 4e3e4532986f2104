"""EX13, EX19, EX20, EX22, EX23, EX24 and EX28: decisions of every kind of issuer, written from the orders
and read in one pass. The SQL is told from the order what each must give."""

from __future__ import annotations

from pyspark.sql import functions as F

from obolus.catalog.documents import eu
from obolus.catalog.landing import q
from obolus.catalog.registry import query
from obolus.operators.shape import once
from obolus.plans import dispatch as dp

c = F.col
HOME = dp.Home("ΝΗΣΙΔΟΣ", "1", "999000111", ("888000111",), (("2", "ΣΧΟΛΙΚ[Α-Ω]* ΕΠΙΤΡΟΠ"),), fund_id="090111222", code="58000")
SHORE = "προστασία ακτής νότιας"


def decisions(b):
    """25 kinds of decision by priority and segment; the revoked orders' have another payee, total or purpose."""
    p, seg, x = c("o_orderpriority"), c("c_mktsegment"), (c("price") * 100).cast("bigint")
    bad = c("o_orderstatus") == "P"
    off = F.when(bad, 1).otherwise(0)
    pick = lambda good, other: F.when(bad, F.lit(other)).otherwise(F.lit(good))
    payee = pick("999000111", "111222333")
    board = lambda *item: q("το ΔΣ Α Π Ο Φ Α Σ Ι Ζ Ε Ι 1. ", *item, " 2. Ορίζει υπεύθυνο για ποσό 9,99")
    credit = q("Έγκριση πίστωσης ", eu(x), " € σε βάρος του έργου")
    kinds = {
        ("1-URGENT", "AUTOMOBILE"): ("region", F.lit("ENTAΛMA ΠΛΗΡΩΜΗΣ"), q("Δίνεται εντολή πληρωμής ευρώ: #", eu(x), "# (χίλια Ευρώ) στο δικαιούχο ΔΗΜΟΣ ΝΗΣΙΔΟΣ Διεύθυνση: Χώρα ΑΦΜ: ", payee,
                                     " Για: προγραμματική σύμβαση ΣΥΝΟΛΟ ΚΡΑΤΗΣΕΩΝ: 10,50 ΕΝΤΕΛΛΟΜΕΝΟ ΠΟΣΟ ΣΤΟ ΔΙΚΑΙΟΥΧΟ: ", eu(x - 1050))),
        ("1-URGENT", "BUILDING"): ("region", credit, q("η πίστωση θα μεταβιβαστεί ", pick("στο Δήμο Νησίδος", "στο Π.Τ.Α., υπόλογο του έργου"))),
        ("1-URGENT", "FURNITURE"): ("region", q("Έγκριση πίστωσης ", eu(x), " € σε βάρος έργου της περιφέρειας"), F.lit("θα μεταβιβαστεί στο Περιφερειακό Ταμείο Ανάπτυξης")),
        ("1-URGENT", "MACHINERY"): ("region", F.lit(f"Προγραμματική σύμβαση: {SHORE} περιοχής"), F.lit("κείμενο")),
        ("1-URGENT", "HOUSEHOLD"): ("region", F.lit("ENTAΛMA ΠΛΗΡΩΜΗΣ"), F.lit(None).cast("string")),
        ("2-HIGH", "AUTOMOBILE"): ("region_fund", F.lit("Εντολή πληρωμής"), q("συνολικού ποσού ", eu(x), " ευρώ ΣΥΝΟΛΙΚΗ ΑΞΙΑ ΠΑΡΑΣΤΑΤΙΚΟΥ ", eu(x + off), f" ΤΙΤΛΟΣ ΥΠΟΕΡΓΟΥ: {SHORE} ΚΩΔΙΚΟΣ ΝΟΜΙΚΗΣ δέσμευσης Δικαιούχου/ων: ΔΗΜΟΣ ΝΗΣΙΔΟΣ (ΑΦΜ: 999000111)")),
        ("2-HIGH", "BUILDING"): ("region_fund", F.lit("Εντολή πληρωμής"), q("Την έγκριση δαπάνης ποσού ", pick("εξήντα", "εξήντα μίας"), " χιλιάδων ευρώ (60.000,00 €) του υποέργου «ένα άλλο έργο μόνο». Θα καταβληθεί στο δήμο Νησίδος (ΑΦΜ:999000111)")),
        ("2-HIGH", "FURNITURE"): ("region_fund", F.lit("Εντολή πληρωμής"), q("Την έγκριση δαπάνης ποσού εξήντα χιλιάδων ευρώ (60.000,00 €) του υποέργου «ΠΣ μεταξύ του Δήμου και άλλων». Θα καταβληθεί ", pick("στο δήμο Νησίδος (ΑΦΜ:999000111)", "στον ανάδοχο"))),
        ("2-HIGH", "MACHINERY"): ("interior", F.lit("Κατανομή από ΚΑΠ έτους 2016"), q("  1  50100  ΑΛΦΑΣ   ", F.lpad(eu(x), 18, " "), "\n  2  58000  ΝΗΣΙΔΟΣ ", F.lpad(eu(x + 5), 18, " "), "\n     ΣΥΝΟΛΟ       ", F.lpad(eu(x + x + 5 + off * 100), 18, " "), "\n")),
        ("2-HIGH", "HOUSEHOLD"): ("interior", F.lit("Επιχορήγηση για ληξιπρόθεσμες οφειλές"), pick("με Εντολές Εξόφλησης", "προς τους δήμους")),
        ("3-MEDIUM", "AUTOMOBILE"): ("union", F.lit("Αίτημα χρηματοδότησης"), board("Εγκρίνει ", eu(x * 4 + off), " ευρώ (", eu(x), " ευρώ χ 4 Δήμοι) οικ. έτους 2022.")),
        ("3-MEDIUM", "BUILDING"): ("union", F.lit("Αίτημα χρηματοδότησης"), board("Εγκρίνει ποσό ", pick("11.000,00", "11.000,01"), " ως εξής: Α. Πέντε χιλιάδες ευρώ (5.000,00€) για τη μία Β. Έξι χιλιάδες ευρώ (6.000,00€) για την άλλη.")),
        ("3-MEDIUM", "FURNITURE"): ("union", F.lit("Αίτημα χρηματοδότησης"), q("για το αίτημα των ", eu(x + off), " ευρώ ", board("Εγκρίνει ποσό ", eu(x), " ευρώ."))),
        ("3-MEDIUM", "MACHINERY"): ("union", F.lit("Αίτημα χρηματοδότησης"), board(pick("Εγκρίνει τη συνδιοργάνωση", "Αποδέχεται το αίτημα"), ".")),
        ("3-MEDIUM", "HOUSEHOLD"): ("union", F.lit("Ένταλμα πληρωμής"), q("ΔΙΚΑΙΟΥΧΟΣ: ΔΗΜΟΣ ΑΦΜ: ", payee, " ### χίλια ( ", eu(x), " ) ευρώ ### ΣΥΝΟΛΟ : ", eu(x), " Καθαρ. Δικαιούχου : ", eu(x - 5))),
        ("4-NOT SPECIFIED", "AUTOMOBILE"): ("green_fund", q("Έγκριση δαπάνης ", pick("60.000,00", "50.000,00")), q("δικαιούχος με ΑΦΜ 111222333. Εγκρίνουμε τη δαπάνη ποσού (εξήντα μίας χιλιάδων ευρώ) «60.000,00€» και δικαιούχο τον ανάδοχο με Α.Φ.Μ. 999000111.")),
        ("4-NOT SPECIFIED", "BUILDING"): ("green_fund", F.lit("Αποδέσμευσης ποσού"), q("με προϋπολογισμού ", eu(x + x + 700 + off), " € αποφασίζουν Να εκταμιεύσει από τον λογαριασμό το ποσό των ", eu(x), " € σύστασης παρακαταθήκης υπέρ του Δήμου Νησίδος ποσού ύψους ", eu(x + 700), " €")),
        ("4-NOT SPECIFIED", "FURNITURE"): ("green_fund", F.lit("Έγκριση δαπάνης"), q("δικαιούχος ο Δήμος με ΑΦΜ 999000111. Εγκρίνουμε τη δαπάνη ποσού (εξήντα χιλιάδων ευρώ) «60.000,00€» και δικαιούχο τον ανάδοχο με Α.Φ.Μ. ", payee, ".")),
        ("4-NOT SPECIFIED", "MACHINERY"): ("shipping", F.lit("Έγκριση πληρωμής"), q("ποσού χιλίων ευρώ (1.000,00 €) αποφασίζουμε την πληρωμή ποσού των ", pick("εξήντα", "εξήντα μίας"), " χιλιάδων ευρώ (60.000,00 €) με υπόλογο διαχειριστή το Δήμο Νησίδος, 999000111")),
        ("4-NOT SPECIFIED", "HOUSEHOLD"): ("shipping", F.lit("Εντολή κατανομής ΣΑΕ 330"), q("παρακαλούμε για την πληρωμή ποσού εξήντα χιλιάδων ευρώ (60.000,00 €) με φορέας υλοποίησης Δήμος ", pick("Νησίδος 999000111", "Άλλος"))),
        ("5-LOW", "AUTOMOBILE"): ("foundation", F.lit("Επιχορήγηση για έτος 2014"), q("Η επιτροπή αποφασίζει: 1) καταβολή ποσού εξήντα χιλιάδων ευρώ (60.000,00 €) στον Δήμο Νησίδος, ", pick("τακτική", "έκτακτη"), " επιχορήγηση 2) καταβολή ποσού ", eu(x), " έναντι στη Σχολική Επιτροπή")),
        ("5-LOW", "BUILDING"): ("foundation", F.lit("Επιχορήγηση"), q("αποφασίζει την καταβολή ", pick("ποσού 50.000,00", "οφειλής"), " στο Ίδρυμα")),
        ("5-LOW", "FURNITURE"): ("tourism_organisation", F.lit("Εξόφληση"), q("ΔΙΚΑΙΟΥΧΟΣ : ΔΗΜΟΣ ΝΗΣΙΔΟΣ ( ΑΦΜ:888000111 )\nΕΝΤΕΛΛΟΜΕΝΟ ΣΥΝΟΛΟ ΠΛΗΡΩΤΕΟ ", pick("12.000,00", "12.000,01"), " 360,00 11.640,00 ΣΥΝΟΛΟ ΕΝΤΑΛΜΑΤΟΣ : Δώδεκα Χιλιάδες Ευρώ")),
        ("5-LOW", "MACHINERY"): ("culture", F.lit("Ανάληψη υποχρέωσης"), F.lit("κείμενο")),
        ("5-LOW", "HOUSEHOLD"): ("green_fund", F.lit("Ένταξη έργου"), F.lit("κείμενο")),
    }
    def choose(i):
        out = None
        for (a, s), v in kinds.items():
            value = F.lit(v[i]) if isinstance(v[i], str) else v[i]
            out = (F.when if out is None else out.when)((p == a) & (seg == s), value)
        return out
    d = once(once(b.decisions, "subject", choose(1)), "text", choose(2))
    return d.select(c("ada").alias("doc_id"), "date", choose(0).alias("kind"), "subject", "text", (seg == "BUILDING").alias("anchored"))


# (priority, segment): family, category, budget year, status, amounts, nets (SQL, empty lists where nothing is read), validation
NONE = ("[]", "[]", "[]")
SAID = {
    ("1-URGENT", "AUTOMOBILE"): ("CASE WHEN bad THEN 'region_payment' ELSE 'region_agreement_payment' END", "CASE WHEN NOT bad THEN 'programme_agreements' END", "year", "CASE WHEN bad THEN 'absent' ELSE 'read' END",
                                 "CASE WHEN bad THEN [] ELSE [x] END", "CASE WHEN bad THEN [] ELSE [x - 1050] END", "CASE WHEN bad THEN [] ELSE [CASE WHEN x = 100000 THEN 'words_and_figures' END] END"),
    ("1-URGENT", "BUILDING"): ("CASE WHEN bad THEN 'region_credit_via_fund' ELSE 'region_credit' END", "CASE WHEN NOT bad THEN 'investment_programmes' END", "year", "'read'", "[x]", "[x]", "[NULL]"),
    ("1-URGENT", "FURNITURE"): ("'region_own_credit'", "NULL", "year", "'absent'", *NONE), ("1-URGENT", "MACHINERY"): ("'region_agreement'", "NULL", "year", "'listed'", *NONE),
    ("1-URGENT", "HOUSEHOLD"): ("'region_payment'", "NULL", "year", "'no_pdf'", *NONE),
    ("2-HIGH", "AUTOMOBILE"): ("CASE WHEN agreed THEN 'region_fund_agreement_payment' ELSE 'region_fund_payment' END", "CASE WHEN agreed THEN 'programme_agreements' ELSE 'investment_programmes' END", "year", "'read'", "[x]", "[x]", "[CASE WHEN NOT bad THEN 'stated_amount' END]"),
    ("2-HIGH", "BUILDING"): ("'region_fund_payment'", "'investment_programmes'", "year", "'read'", "[6000000]", "[6000000]", "[CASE WHEN NOT bad THEN 'words_and_figures' END]"),
    ("2-HIGH", "FURNITURE"): ("CASE WHEN bad THEN 'region_fund_payment' ELSE 'region_fund_agreement_payment' END", "CASE WHEN bad THEN 'investment_programmes' ELSE 'programme_agreements' END", "year", "CASE WHEN bad THEN 'absent' ELSE 'read' END",
                              "CASE WHEN bad THEN [] ELSE [6000000] END", "CASE WHEN bad THEN [] ELSE [6000000] END", "CASE WHEN bad THEN [] ELSE ['words_and_figures'] END"),
    ("2-HIGH", "MACHINERY"): ("'kap_general'", "'kap_general'", "2016", "'read'", "[x + 5]", "[x + 5]", "[CASE WHEN NOT bad THEN 'column_totals' END]"),
    ("2-HIGH", "HOUSEHOLD"): ("CASE WHEN bad THEN 'arrears' ELSE 'arrears_ceiling' END", "CASE WHEN bad THEN 'state_grants' END", "year", "'not_found'", *NONE),
    ("3-MEDIUM", "AUTOMOBILE"): ("'ped_grant'", "'state_grants'", "2022", "'read'", "[x]", "[x]", "[CASE WHEN NOT bad THEN 'stated_amount' END]"),
    ("3-MEDIUM", "BUILDING"): ("'ped_grant'", "'state_grants'", "year", "'read'", "[CASE WHEN bad THEN 1100001 ELSE 1100000 END]", "[CASE WHEN bad THEN 1100001 ELSE 1100000 END]", "[CASE WHEN NOT bad THEN 'words_and_figures' END]"),
    ("3-MEDIUM", "FURNITURE"): ("'ped_grant'", "'state_grants'", "year", "'read'", "[x]", "[x]", "[CASE WHEN NOT bad THEN 'stated_amount' END]"),
    ("3-MEDIUM", "MACHINERY"): ("CASE WHEN bad THEN 'ped_grant' ELSE 'ped_own_spending' END", "CASE WHEN bad THEN 'state_grants' END", "year", "CASE WHEN bad THEN 'not_found' ELSE 'listed' END", *NONE),
    ("3-MEDIUM", "HOUSEHOLD"): ("'ped_payment'", "'state_grants'", "year", "CASE WHEN bad THEN 'absent' ELSE 'read' END", "CASE WHEN bad THEN [] ELSE [x] END", "CASE WHEN bad THEN [] ELSE [x - 5] END", "CASE WHEN bad THEN [] WHEN x = 100000 THEN ['words_and_figures'] ELSE ['stated_amount'] END"),
    ("4-NOT SPECIFIED", "AUTOMOBILE"): ("'green_fund_payment'", "'investment_programmes'", "year", "'read'", "[6000000]", "[6000000]", "[CASE WHEN NOT bad THEN 'stated_amount' END]"),
    ("4-NOT SPECIFIED", "BUILDING"): ("'green_fund_payment'", "'investment_programmes'", "year", "'read'", "[x, x + 700]", "[x, x + 700]", "CASE WHEN bad THEN [NULL, NULL] ELSE ['stated_amount', 'stated_amount'] END"),
    ("4-NOT SPECIFIED", "FURNITURE"): ("'green_fund_payment'", "'investment_programmes'", "year", "CASE WHEN bad THEN 'absent' ELSE 'read' END", "CASE WHEN bad THEN [] ELSE [6000000] END", "CASE WHEN bad THEN [] ELSE [6000000] END", "CASE WHEN bad THEN [] ELSE ['words_and_figures'] END"),
    ("4-NOT SPECIFIED", "MACHINERY"): ("'shipping_payment'", "'investment_programmes'", "year", "'read'", "[6000000]", "[6000000]", "[CASE WHEN NOT bad THEN 'words_and_figures' END]"),
    ("4-NOT SPECIFIED", "HOUSEHOLD"): ("'pde_authorisation'", "'investment_programmes'", "year", "CASE WHEN bad THEN 'absent' ELSE 'read' END", "CASE WHEN bad THEN [] ELSE [6000000] END", "CASE WHEN bad THEN [] ELSE [6000000] END", "CASE WHEN bad THEN [] ELSE ['words_and_figures'] END"),
    ("5-LOW", "AUTOMOBILE"): ("CASE WHEN bad THEN 'foundation_grant' ELSE 'foundation_statutory_grant' END", "CASE WHEN NOT bad THEN 'foundation_contribution' END", "year", "'read'", "[6000000, x]", "[6000000, x]", "['words_and_figures', 'figures_only']"),
    ("5-LOW", "BUILDING"): ("'foundation_grant'", "NULL", "year", "CASE WHEN bad THEN 'not_found' ELSE 'absent' END", *NONE),
    ("5-LOW", "FURNITURE"): ("'eot_payment'", "'state_grants'", "year", "'read'", "[CASE WHEN bad THEN 1200001 ELSE 1200000 END]", "[1164000]", "[CASE WHEN NOT bad THEN 'words_and_figures' END]"),
    ("5-LOW", "MACHINERY"): ("'commitment'", "NULL", "year", "'listed'", *NONE), ("5-LOW", "HOUSEHOLD"): ("'programme'", "NULL", "year", "'listed'", *NONE),
}
COLUMNS = ("family", "category", "budget_year", "read_status", "amounts", "nets", "checks")
TYPES = ("VARCHAR", "VARCHAR", "BIGINT", "VARCHAR", "BIGINT[]", "BIGINT[]", "VARCHAR[]")


def _said(only=None) -> str:
    cases = [f"CAST(CASE {' '.join(f'WHEN p = {chr(39)}{a}{chr(39)} AND seg = {chr(39)}{s}{chr(39)} THEN CAST({v[i]} AS {t})' for (a, s), v in SAID.items())} END AS {t}) AS {n}" for i, (n, t) in enumerate(zip(COLUMNS, TYPES))]
    return f"SELECT doc_id, kind_no, {', '.join(cases)} FROM (SELECT *, p || seg AS kind_no, EXISTS (SELECT 1 FROM x WHERE p = '1-URGENT' AND seg = 'MACHINERY') AS agreed FROM x)"


X = {"x": "SELECT ada AS doc_id, o_orderpriority AS p, o_orderstatus = 'P' AS bad, CAST(price * 100 AS BIGINT) AS x, c_mktsegment AS seg, year FROM decisions", "said": _said()}
DECISION = "doc_id, family, category, budget_year, read_status, CAST(len(amounts) AS BIGINT) AS n_amounts, CAST(len(list_filter(checks, lambda v: v IS NOT NULL)) AS BIGINT) AS n_validated"


@query("ex28_grant_rows", f"SELECT {DECISION} FROM said", X)
def _(b):
    return dp.grant_rows(decisions(b), HOME).select("doc_id", "family", "category", "budget_year", "read_status", "n_amounts", "n_validated")


@query("ex28_grant_lines", """SELECT doc_id, CAST(i - 1 AS BIGINT) AS line_no, family, amounts[i] AS amount, nets[i] AS net, checks[i] AS validation, category,
    CASE WHEN family LIKE 'foundation%' AND i = 2 THEN '2' ELSE '1' END AS recipient FROM said, range(1, len(amounts) + 1) r(i)""", X)
def _(b):
    return dp.grant_lines(dp.grant_rows(decisions(b), HOME)).select("doc_id", "line_no", "family", "amount", "net", "validation", "category", "recipient")


def _of(name: str, families: tuple[str, ...], sql_where: str):
    """What the one pass says of some families' decisions."""
    @query(name, f"SELECT {DECISION}, CAST(list_sum(amounts) AS BIGINT) AS amount FROM said WHERE {sql_where}", X)
    def _(b):
        rows = dp.grant_rows(decisions(b), HOME).filter(c("family").isin(*families))
        total = F.when(F.size("lines") > 0, F.aggregate("lines", F.lit(0).cast("bigint"), lambda a, x: a + x["amount"]))
        return rows.select("doc_id", "family", "category", "budget_year", "read_status", "n_amounts", "n_validated", total.alias("amount"))


_of("ex19_fund_payments", ("region_fund_payment", "region_fund_agreement_payment"), "family LIKE 'region_fund%'")
_of("ex22_board_grants", ("ped_grant", "ped_own_spending"), "family IN ('ped_grant', 'ped_own_spending')")
_of("ex23_green_approvals", ("green_fund_payment",), "family = 'green_fund_payment'")
_of("ex24_shipping", ("shipping_payment", "pde_authorisation"), "family IN ('shipping_payment', 'pde_authorisation')")
_of("ex13_letters_and_subjects", ("green_fund_payment", "shipping_payment"), "family IN ('green_fund_payment', 'shipping_payment')")

"""Single kinds of grant documents, invented."""

import pytest

from obolus.plans import allocations as al
from obolus.plans import readers as rd

CONFIGS = rd.configurations("ΝΗΣΙΔΟΣ", "999000111", ("888000111",))
ORDER = ("Δίνεται εντολή πληρωμής ευρώ: #1.210,50# να πληρωθεί (χίλια διακόσια δέκα Ευρώ και πενήντα Λεπτά) στο δικαιούχο ΔΗΜΟΣ ΝΗΣΙΔΟΣ Διεύθυνση: Χώρα ΑΦΜ: 999000111 "
         "Για: έργο ΣΥΝΟΛΟ ΚΡΑΤΗΣΕΩΝ: 10,50 ΕΝΤΕΛΛΟΜΕΝΟ ΠΟΣΟ ΣΤΟ ΔΙΚΑΙΟΥΧΟ: 1.200,00")
GREEN = "Εγκρίνουμε τη δαπάνη ποσού (Δύο χιλιάδες εκατόν Ευρώ και οκτώ Λεπτά) «2.100,08€» και δικαιούχο τον ΔΗΜΟ ΝΗΣΙΔΟΣ με Α.Φ.Μ. 999000111."
CASES = {
    "order": ("region_payment", ORDER, (121050, 120000, "read", "words_and_figures")),
    "order_other": ("region_payment", ORDER.replace("999000111", "111222333"), (None, None, "absent", None)),
    "order_net": ("region_payment", ORDER.replace("10,50 ΕΝΤΕΛ", "11,50 ΕΝΤΕΛ"), (121050, None, "read", "words_and_figures")),
    "approval": ("fund_approval", "Την έγκριση δαπάνης ποσού επτά χιλιάδων ογδόντα ευρώ (7.080,00 €). Θα καταβληθεί στο δήμο Νησίδος (ΑΦΜ:999000111)", (708000, 708000, "read", "words_and_figures")),
    "voucher": ("fund_order", "συνολικού ποσού 58.645,14 ευρώ ΣΥΝΟΛΙΚΗ ΑΞΙΑ ΠΑΡΑΣΤΑΤΙΚΟΥ 58.645,14 Δικαιούχου/ων: ΔΗΜΟΣ ΝΗΣΙΔΟΣ (ΑΦΜ: 999000111)", (5864514, 5864514, "read", "stated_amount")),
    "green": ("green_payment", GREEN, (210008, 210008, "read", "words_and_figures")),
    "green_named": ("green_payment", GREEN.replace("999000111", "111222333"), (210008, 210008, "read", "words_and_figures")),
    "green_other": ("green_payment", GREEN.replace("τον ΔΗΜΟ ΝΗΣΙΔΟΣ", "τον ανάδοχο").replace("999000111", "111222333"), (None, None, "absent", None)),
    "shipping": ("shipping_transfer", "με το ποσό των τεσσάρων χιλιάδων εξήντα ευρώ (4.060,00 €) με υπόλογο διαχειριστή το Δήμο Νησίδος (ΑΦΜ 999000111).", (406000, 406000, "read", "words_and_figures")),
    "former": ("organisation_payment", "ΔΙΚΑΙΟΥΧΟΣ : ΔΗΜΟΣ ΝΗΣΙΔΟΣ ( ΑΦΜ:888000111 )\nΕΝΤΕΛΛΟΜΕΝΟ ΣΥΝΟΛΟ ΠΛΗΡΩΤΕΟ 12.000,00 360,00 11.640,00 ΣΥΝΟΛΟ ΕΝΤΑΛΜΑΤΟΣ : Δώδεκα Χιλιάδες Ευρώ", (1200000, 1164000, "read", "words_and_figures")),
    "other": ("circular", "ποσού 5,00", (None, None, "listed", None)),
}


def test_readers_by_kind(spark):
    docs = spark.createDataFrame([(k, kind, t) for k, (kind, t, _) in CASES.items()], "doc_id string, kind string, text string")
    got = {r["doc_id"]: (r["amount"], r["net"], r["status"], r["validation"]) for r in rd.read_by_kind(docs, CONFIGS).collect()}
    assert got == {k: want for k, (_, _, want) in CASES.items()}


def test_items_recipients_and_the_shifted_font(spark):
    docs = spark.createDataFrame([
        ("items", "αποφασίζει 1) καταβολή ποσού εξήντα χιλιάδων ευρώ (60.000,00 €) στον Δήμο Νησίδος, τακτική επιχορήγηση 2) καταβολή ποσού χιλίων ευρώ (1.000,00 €) στο Ίδρυμα"),
        ("figures", "αποφασίζει την καταβολή ποσού 50.000,00 έναντι στον Δήμο Νησίδος"),
        ("shifted", "αποφαζίδει ηην καηαβολή ποζού είκοζι ηεζζάπων χιλιάδων €υρώ (24.000,00 €) στον Δήμο Νησίδος"),
        ("school", "αποφασίζει την καταβολή ποσού τετρακοσίων (400) ευρώ στη Σχολική Επιτροπή Δήμου Νησίδος")], "doc_id string, text string")
    items = rd.decision_items(docs, (("2", "ΣΧΟΛΙΚ[Α-Ω]* ΕΠΙΤΡΟΠ"),), "ΝΗΣΙΔΟΣ", "1")
    got = {(r["doc_id"], r["recipient"], r["amount"], r["validation"]) for r in items.collect()}
    assert got == {("items", "1", 6000000, "words_and_figures"), ("figures", "1", 5000000, "figures_only"), ("shifted", "1", 2400000, "words_and_figures"), ("school", "2", 40000, "words_and_figures")}
    assert [r["doc_id"] for r in rd.statutory_decisions(items, "1").collect()] == ["items"]


def test_escrow_release_and_deposit_make_the_budget(spark):
    text = ("προϋπολογισμού 29.500,00 € ομόφωνα αποφασίζουν Να δοθεί εντολή να εκταμιεύσει από τον λογαριασμό το ποσό των 10.200,00 € "
            "σύστασης παρακαταθήκης υπέρ του Δήμου Νησίδος ποσού ύψους 19.300,00 € εξόφλησης παρακαταθήκης υπέρ του Δήμου Νησίδος ποσού ύψους 19.300,00 €")
    docs = spark.createDataFrame([("a", text), ("b", text.replace("29.500,00", "29.000,00"))], "doc_id string, text string")
    got = {(r["doc_id"], r["method"], r["amount"], r["validation"]) for r in rd.escrow_amounts(docs, "ΝΗΣΙΔΟΣ").collect()}
    assert got == {("a", "escrow_release", 1020000, "stated_amount"), ("a", "escrow_deposit", 1930000, "stated_amount"),
                   ("b", "escrow_release", 1020000, None), ("b", "escrow_deposit", 1930000, "stated_amount")}


def test_sub_project_in_an_agreement(spark):
    pays = spark.createDataFrame([("a", "Εκσυγχρονισμός 'Σφαγείου' Νησίδος"), ("b", "Σφαγείου Νησίδος"), ("c", "Έργο χωρίς σύμβαση καμία")], "doc_id string, sub_project string")
    agreements = spark.createDataFrame([("Προγραμματική σύμβαση: Εκσυγχρονισμός Σφαγείου  Νησίδος 2020",)], "subject string")
    assert [r["doc_id"] for r in rd.under_agreement(pays, agreements).collect()] == ["a"]


def test_a_table_of_two_purposes(spark):
    text = ("α) για το ποσό των 121.670,34€ σε χρέωση του λογαριασμού με τίτλο «Κάλυψη αναγκών» και\nβ) για το ποσό των 115.081,59€ σε χρέωση του λογαριασμού με τίτλο «Κεντρικοί Αυτοτελείς Πόροι»:\n"
            "  1  50100  ΑΛΦΑΣ   Α   100,00   50,00   150,00\n  2  58000  ΝΗΣΙΔΟΣ  Β  121.570,34   115.031,59   236.601,93\n     ΣΥΝΟΛΟ    121.670,34   115.081,59   236.751,93\n")
    docs = spark.createDataFrame([("d", None, text)], "doc_id string, subject string, text string")
    tables = al.read_tables(docs)
    got = rd.split_two_purpose(al.target_lines(tables, "58000"), tables, docs, "58000", "kap_supplementary").collect()
    assert {(r["amount"], r["family"], r["validation"]) for r in got} == {(12157034, None, "column_totals"), (11503159, "kap_supplementary", "column_totals")}


def test_families_that_are_not_ours(spark):
    from pyspark.sql import functions as F

    from obolus import grant_rules as gr
    rows = spark.createDataFrame([
        ("foundation", "Τακτική επιχορήγηση στην Ιερά Μητρόπολη", "", "foundation_to_others"), ("foundation", "Τακτική επιχορήγηση του Δήμου Νησίδος", "", "foundation_statutory_grant"),
        ("region", "ENTAΛMA ΠΛΗΡΩΜΗΣ", "Για: κατανάλωση νερού κτιρίου ΕΝΤΕΛΛΟΜΕΝΟ ΠΟΣΟ 5,00", "region_utility_payment"), ("region", "ENTAΛMA ΠΛΗΡΩΜΗΣ", "Για: προγραμματική σύμβαση ΕΝΤΕΛΛΟΜΕΝΟ ΠΟΣΟ 5,00", "region_agreement_payment"),
        ("region", "ENTAΛMA ΠΛΗΡΩΜΗΣ", "Για: έργο ΕΝΤΕΛΛΟΜΕΝΟ ΠΟΣΟ 5,00", "region_payment"), ("region", "Έγκριση πίστωσης 70.000,00 € σε βάρος του έργου ΣΑΕ 055", "θα μεταβιβαστεί στο Περιφερειακό Ταμείο Ανάπτυξης", "region_credit_via_fund"),
        ("region", "Έγκριση πίστωσης 70.000,00 € σε βάρος του έργου ΣΑΕ 055", "θα μεταβιβαστεί στο Δήμο", "region_credit"), ("union", "Αίτημα για συνδιοργάνωση εκδήλωσης", "", "ped_own_spending")], "kind string, subject string, text string, want string")
    family = gr.family_of(F.col("subject"), F.col("kind"), "ΝΗΣΙΔΟΣ")
    got = rows.withColumn("f", gr.refine_union(gr.refine_region(family, F.col("text")), F.col("subject"))).collect()
    assert [(r["subject"], r["f"]) for r in got] == [(r["subject"], r["want"]) for r in got]
    own = rows.limit(1).select(gr.own_credit(F.lit("region_credit"), F.lit(True), F.lit("region_credit"), F.lit(False)), gr.own_credit(F.lit("region_credit"), F.lit(True), F.lit("region_credit"), F.lit(True))).first()
    assert list(own) == ["region_own_credit", "region_credit"]
    assert rows.limit(1).select(gr.category_of(F.lit("foundation_to_others"), F.lit(2020))).first()[0] is None


def test_rows_of_a_payment_order_and_of_tables(spark):
    """an order whose lines add up is read by its lines alone; a table by the candidate that adds up, else the first, unvalidated."""
    from obolus.plans import transfers as tr
    payees = (tr.Payee("1", "999000111", "ΔΗΜΟΣ ΝΗΣΙΔΟΣ"),)
    row = lambda name, x: name.ljust(40) + x.rjust(14)
    table = lambda total: "\n".join([row("  1  2019ΣΕ05510001  ΔΗΜΟΣ ΝΗΣΙΔΟΣ", "10,00"), row("  2  2019ΣΕ05510002  ΑΛΛΟΣ ΦΟΡΕΑΣ", "5,00"), "     ΑΦΜ 999000111", row("     ΣΥΝΟΛΟ", total)])
    order = lambda total: f"12345678 ΔΗΜΟΣ ΝΗΣΙΔΟΣ 1,00\n12345679 ΑΛΛΟΣ 2,00\nσυνολικού ποσού {total} ευρώ"
    docs = [("t", table("15,00")), ("u", table("16,00")), ("o", order("3,00")), ("p", order("4,00")), (None, order("3,00")), ("n", None), ("two", table("15,00") + "\n" + table("16,00"))]
    got = tr.transfer_rows(spark.createDataFrame(docs, "doc_id string, text string"), payees)
    assert sorted((r["doc_id"], r["line"], r["amount"], r["validation"] or "") for r in got.collect()) == [
        ("o", 0, 100, "stated_amount"), ("t", 0, 1000, "stated_amount"), ("t", 1, 500, "stated_amount"), ("two", 0, 1000, "stated_amount"),
        ("two", 1, 500, "stated_amount"), ("two", 4, 1000, ""), ("two", 5, 500, ""), ("u", 0, 1000, ""), ("u", 1, 500, "")]


def test_a_rows_text_may_hold_any_sign(spark):
    """parts taken by one search are those taken one by one, whatever stands in the text or at the line's end."""
    from obolus.plans import documents as dx
    rows = ["0111   a\tb  $1  1,00  2,00  3,00", "6011  \\ c\td  1.234,56   0,00  7,00 \u2028", "  0129  1,00  1,00  2,00  3,00\t"]
    text = "Στοιχεία Εκτέλεσης Προϋπολογισμού\nΠερίοδος: Δεκέμβριος 2020\n" + "\n".join(rows) + "\nΣΥΝΟΛΟ ΕΣΟΔΩΝ 2,00 4,00 6,00\nΣΥΝΟΛΟ ΕΞΟΔΩΝ 1.234,56 0,00 7,00\n"
    lines, refused = dx.extract_statements(spark.createDataFrame([("d", text)], "doc_id string, text string"))
    assert refused.count() == 0
    assert sorted((r["side"], r["kae"], r["description"], r["budgeted"], r["assessed_or_warranted"], r["collected_or_paid"]) for r in lines.collect()) == [
        ("revenue", "0111", "a b $1", 100, 200, 300), ("revenue", "0129", "1,00", 100, 200, 300), ("spending", "6011", "\\ c d", 123456, 0, 700)]

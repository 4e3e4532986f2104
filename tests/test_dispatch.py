"""Grant decisions of all kinds read in one pass; invented documents."""

import datetime

import pytest

from obolus.plans import dispatch as dp

HOME = dp.Home("ΝΗΣΙΔΟΣ", "1", "999000111", ("888000111",), (("2", "ΣΧΟΛΙΚ[Α-Ω]* ΕΠΙΤΡΟΠ"),), fund_id="090111222")
ORDER = ("Δίνεται εντολή πληρωμής ευρώ: #1.210,50# να πληρωθεί (χίλια διακόσια δέκα Ευρώ και πενήντα Λεπτά) στο δικαιούχο ΔΗΜΟΣ ΝΗΣΙΔΟΣ Διεύθυνση: Χώρα ΑΦΜ: 999000111 "
         "Για: {} ΣΥΝΟΛΟ ΚΡΑΤΗΣΕΩΝ: 10,50 ΕΝΤΕΛΛΟΜΕΝΟ ΠΟΣΟ ΣΤΟ ΔΙΚΑΙΟΥΧΟ: 1.200,00")
CREDIT = "Έγκριση πίστωσης 2.100,08 € σε βάρος του έργου"
SPELLED = "Εγκρίνουμε πίστωση ύψους δύο χιλιάδων εκατόν ευρώ και οκτώ λεπτών (2.100,08 €) για έργο του Δήμου Νησίδος"
FUND = "Την έγκριση δαπάνης ποσού επτά χιλιάδων ογδόντα ευρώ (7.080,00 €) του υποέργου «{}». Θα καταβληθεί στο δήμο Νησίδος (ΑΦΜ:999000111)"
BOARD = "Το ΔΣ Α Π Ο Φ Α Σ Ι Ζ Ε Ι 1. {} 2. Ορίζει υπεύθυνο ποσό 9,99"
GREEN = "Εγκρίνουμε τη δαπάνη ποσού (Δύο χιλιάδες εκατόν Ευρώ και οκτώ Λεπτά) «{}€» και δικαιούχο {} με Α.Φ.Μ. {}."
SHIP = "ποσού των χιλίων ευρώ (1.000,00 €) προηγούμενο. Αποφασίζουμε την πληρωμή ποσού των τεσσάρων χιλιάδων εξήντα ευρώ ({} €) με υπόλογο διαχειριστή το Δήμο Νησίδος (ΑΦΜ 999000111)."
ESCROW = ("με προϋπολογισμού 29.500,00 € αποφασίζουν Να εκταμιεύσει από τον λογαριασμό το ποσό των 10.200,00 € σύστασης παρακαταθήκης υπέρ του Δήμου Νησίδος ποσού ύψους 19.300,00 €")
ITEMS = "αποφασίζει 1) καταβολή ποσού εξήντα χιλιάδων ευρώ (60.000,00 €) στον Δήμο Νησίδος, τακτική επιχορήγηση 2) καταβολή ποσού 400 ευρώ στη Σχολική Επιτροπή"

# name: (kind, subject, text, anchored) -> (family, category, budget_year, status, lines as (recipient, amount, net, validation))
CASES = {
    "order": (("region", "ENTAΛMA ΠΛΗΡΩΜΗΣ", ORDER.format("έργο"), False), ("region_payment", None, 2021, "read", [("1", 121050, 120000, "words_and_figures")])),
    "order_bill": (("region", "ENTAΛMA ΠΛΗΡΩΜΗΣ", ORDER.format("κατανάλωση νερού"), False), ("region_utility_payment", None, 2021, "read", [("1", 121050, 120000, "words_and_figures")])),
    "order_agreement": (("region", "ENTAΛMA ΠΛΗΡΩΜΗΣ", ORDER.format("προγραμματική σύμβαση"), False), ("region_agreement_payment", "programme_agreements", 2021, "read", [("1", 121050, 120000, "words_and_figures")])),
    "order_other": (("region", "ENTAΛMA ΠΛΗΡΩΜΗΣ", ORDER.format("έργο").replace("999000111", "111222333"), False), ("region_payment", None, 2021, "absent", [])),
    "order_none": (("region", "ENTAΛMA ΠΛΗΡΩΜΗΣ", "ένα άλλο έγγραφο", False), ("region_payment", None, 2021, "not_found", [])),
    "no_document": (("region", "ENTAΛMA ΠΛΗΡΩΜΗΣ", None, False), ("region_payment", None, 2021, "no_pdf", [])),
    "credit": (("region", CREDIT, SPELLED + " θα μεταβιβαστεί στο Δήμο Νησίδος", True), ("region_credit", "investment_programmes", 2021, "read", [("1", 210008, 210008, "words_and_figures")])),
    "credit_unspelled": (("region", CREDIT, "ποσό θα μεταβιβαστεί στο Δήμο Νησίδος", True), ("region_credit", "investment_programmes", 2021, "read", [("1", 210008, 210008, None)])),
    "credit_fund": (("region", CREDIT, SPELLED + " θα μεταβιβαστεί στο Π.Τ.Α., υπόλογο του έργου", True), ("region_credit_via_fund", None, 2021, "read", [("1", 210008, 210008, "words_and_figures")])),
    "credit_other": (("region", CREDIT, SPELLED + " θα μεταβιβαστεί στον ανάδοχο", True), ("region_credit", "investment_programmes", 2021, "absent", [])),
    "credit_silent": (("region", CREDIT, SPELLED, True), ("region_credit", "investment_programmes", 2021, "not_found", [])),
    "credit_own": (("region", CREDIT, SPELLED + " θα μεταβιβαστεί στο Π.Τ.Α., υπόλογο του έργου", False), ("region_own_credit", None, 2021, "absent", [])),
    "credit_own_ours": (("region", CREDIT, SPELLED + " θα μεταβιβαστεί στο Δήμο Νησίδος", False), ("region_credit", "investment_programmes", 2021, "read", [("1", 210008, 210008, "words_and_figures")])),
    "credit_own_unread": (("region", CREDIT, None, False), ("region_own_credit", None, 2021, "no_pdf", [])),
    "commitment": (("region", "Προγραμματική σύμβαση για αποχιονισμό", "Εγκρίνουμε τη δέσμευση πίστωσης ύψους δύο χιλιάδων εκατόν ευρώ και οκτώ λεπτών (2.100,08 €) για την πληρωμή ισόποσης δαπάνης της ΠΣ ΠΝΑ & ΔΗΜΟΣ ΝΗΣΙΔΟΣ", True),
                   ("region_agreement_commitment", "programme_agreements", 2021, "read", [("1", 210008, None, "words_and_figures")])),
    "agreement": (("region", "Προγραμματική σύμβαση: Εκσυγχρονισμός Σφαγείου Νησίδος 2020", "κείμενο", True), ("region_agreement", None, 2021, "listed", [])),
    "fund_named": (("region_fund", "Εντολή πληρωμής", FUND.format("Εκσυγχρονισμός 'Σφαγείου' Νησίδος"), True), ("region_fund_agreement_payment", "programme_agreements", 2021, "read", [("1", 708000, 708000, "words_and_figures")])),
    "fund_says": (("region_fund", "Εντολή πληρωμής", FUND.format("ΠΣ μεταξύ του Δήμου και άλλων"), True), ("region_fund_agreement_payment", "programme_agreements", 2021, "read", [("1", 708000, 708000, "words_and_figures")])),
    "fund_plain": (("region_fund", "Εντολή πληρωμής", FUND.format("ένα έργο μόνο του"), True), ("region_fund_payment", "investment_programmes", 2021, "read", [("1", 708000, 708000, "words_and_figures")])),
    "fund_order": (("region_fund", "Εντολή πληρωμής", "συνολικού ποσού 58.645,14 ευρώ ΣΥΝΟΛΙΚΗ ΑΞΙΑ ΠΑΡΑΣΤΑΤΙΚΟΥ 58.645,14 Δικαιούχου/ων: ΔΗΜΟΣ ΝΗΣΙΔΟΣ (ΑΦΜ: 999000111)", True),
                   ("region_fund_payment", "investment_programmes", 2021, "read", [("1", 5864514, 5864514, "stated_amount")])),
    "fund_other": (("region_fund", "Εντολή πληρωμής", "συνολικού ποσού 58.645,14 ευρώ σε άλλον", True), ("region_fund_payment", "investment_programmes", 2021, "absent", [])),
    "union_order": (("union", "Ένταλμα πληρωμής", "ΔΙΚΑΙΟΥΧΟΣ: ΔΗΜΟΣ ΝΗΣΙΔΟΣ ΑΦΜ: 999000111 ### Οκτώ Χιλ. Εξακόσια Ογδόντα ( 8.680,00 ) ευρώ ### ΣΥΝΟΛΟ : 8.680,00 Καθαρ. Δικαιούχου : 8.600,00", False),
                    ("ped_payment", "state_grants", 2021, "read", [("1", 868000, 860000, "words_and_figures")])),
    "board_share": (("union", "Αίτημα χρηματοδότησης", BOARD.format("Εγκρίνει 34.720,00 ευρώ (8.680,00 ευρώ χ 4 Δήμοι) οικ. έτους 2022."), False), ("ped_grant", "state_grants", 2022, "read", [("1", 868000, 868000, "stated_amount")])),
    "board_share_off": (("union", "Αίτημα χρηματοδότησης", BOARD.format("Εγκρίνει 34.720,01 ευρώ (8.680,00 ευρώ χ 4 Δήμοι)."), False), ("ped_grant", "state_grants", 2021, "read", [("1", 868000, 868000, None)])),
    "board_parts": (("union", "Αίτημα χρηματοδότησης", BOARD.format("Εγκρίνει ποσό 11.000,00 ως εξής: Α. Πέντε χιλιάδες ευρώ (5.000,00€) για τη μία Β. Έξι χιλιάδες ευρώ (6.000,00€) για την άλλη."), False),
                    ("ped_grant", "state_grants", 2021, "read", [("1", 1100000, 1100000, "words_and_figures")])),
    "board_one_part": (("union", "Αίτημα χρηματοδότησης", BOARD.format("Εγκρίνει ποσό 5.000,00 ως εξής: Α. Πέντε χιλιάδες ευρώ (5.000,01€) για τη μία."), False), ("ped_grant", "state_grants", 2021, "read", [("1", 500000, 500000, None)])),
    "board_twice": (("union", "Αίτημα χρηματοδότησης", "αίτημα για 5.000,00 ευρώ. " + BOARD.format("Εγκρίνει ποσό 5.000,00 ευρώ."), False), ("ped_grant", "state_grants", 2021, "read", [("1", 500000, 500000, "stated_amount")])),
    "board_own": (("union", "Αίτημα χρηματοδότησης", BOARD.format("Εγκρίνει τη συνδιοργάνωση με ποσό 5.000,00 ευρώ."), False), ("ped_own_spending", None, 2021, "listed", [])),
    "board_own_subject": (("union", "Αίτημα για συνδιοργάνωση", BOARD.format("Εγκρίνει ποσό 5.000,00 ευρώ."), False), ("ped_own_spending", None, 2021, "listed", [])),
    "board_second_item": (("union", "Αίτημα χρηματοδότησης", BOARD.format("Αποδέχεται το αίτημα."), False), ("ped_grant", "state_grants", 2021, "not_found", [])),
    "green": (("green_fund", "Έγκριση δαπάνης", "δικαιούχος ο ανάδοχος με ΑΦΜ 111222333. " + GREEN.format("2.100,08", "τον ΔΗΜΟ ΝΗΣΙΔΟΣ", "999000111"), False), ("green_fund_payment", "investment_programmes", 2021, "read", [("1", 210008, 210008, "words_and_figures")])),
    "green_before": (("green_fund", "Έγκριση δαπάνης", "δικαιούχος ο Δήμος με ΑΦΜ 999000111. " + GREEN.format("2.100,08", "τον ανάδοχο", "111222333"), False), ("green_fund_payment", "investment_programmes", 2021, "absent", [])),
    "green_name": (("green_fund", "Έγκριση δαπάνης", GREEN.format("2.100,08", "τον ΔΗΜΟ ΝΗΣΙΔΟΣ", "111222333"), False), ("green_fund_payment", "investment_programmes", 2021, "read", [("1", 210008, 210008, "words_and_figures")])),
    "green_subject": (("green_fund", "Έγκριση δαπάνης 2.100,09 ευρώ", GREEN.format("2.100,09", "τον ΔΗΜΟ ΝΗΣΙΔΟΣ", "999000111"), False), ("green_fund_payment", "investment_programmes", 2021, "read", [("1", 210009, 210009, "stated_amount")])),
    "escrow": (("green_fund", "Αποδέσμευσης ποσού", ESCROW, False), ("green_fund_payment", "investment_programmes", 2021, "read", [("1", 1020000, 1020000, "stated_amount"), ("1", 1930000, 1930000, "stated_amount")])),
    "shipping": (("shipping", "Έγκριση πληρωμής", SHIP.format("4.060,00"), False), ("shipping_payment", "investment_programmes", 2021, "read", [("1", 406000, 406000, "words_and_figures")])),
    "shipping_subject": (("shipping", "Έγκριση πληρωμής 4.070,00", SHIP.format("4.070,00"), False), ("shipping_payment", "investment_programmes", 2021, "read", [("1", 407000, 407000, "stated_amount")])),
    "shipping_other": (("shipping", "Έγκριση πληρωμής", "Αποφασίζουμε ποσού χιλίων ευρώ (1.000,00 €) σε άλλον", False), ("shipping_payment", "investment_programmes", 2021, "absent", [])),
    "organisation": (("tourism_organisation", "Εξόφληση", "ΔΙΚΑΙΟΥΧΟΣ : ΔΗΜΟΣ ΝΗΣΙΔΟΣ ( ΑΦΜ:888000111 )\nΕΝΤΕΛΛΟΜΕΝΟ ΣΥΝΟΛΟ ΠΛΗΡΩΤΕΟ 12.000,00 360,00 11.640,00 ΣΥΝΟΛΟ ΕΝΤΑΛΜΑΤΟΣ : Δώδεκα Χιλιάδες Ευρώ", False),
                     ("eot_payment", "state_grants", 2021, "read", [("1", 1200000, 1164000, "words_and_figures")])),
    "foundation": (("foundation", "Επιχορήγηση για έτος 2019", ITEMS, False), ("foundation_statutory_grant", "foundation_contribution", 2021, "read", [("1", 6000000, 6000000, "words_and_figures"), ("2", 40000, 40000, "figures_only")])),
    "foundation_other": (("foundation", "Επιχορήγηση", "αποφασίζει την καταβολή ποσού 50.000,00 στο Ίδρυμα", False), ("foundation_grant", None, 2021, "absent", [])),
    "programme": (("green_fund", "Ένταξη έργου", "κείμενο", False), ("programme", None, 2021, "listed", [])),
    "tabled": (("interior", "Κατανομή από ΚΑΠ έτους 2020", "πίνακας", False), ("kap_general", "kap_general", 2020, "read", [("1", 5, 5, "column_totals")])),
    "untabled": (("interior", "Κατανομή από ΚΑΠ", "πίνακας", False), ("kap_general", "kap_general", 2021, "not_found", [])),
    "ceiling": (("interior", "Επιχορήγηση για ληξιπρόθεσμες οφειλές", "με Εντολές Εξόφλησης", False), ("arrears_ceiling", None, 2021, "not_found", [])),
    "other_listed": (("culture", "Ανάληψη", "κείμενο", False), ("commitment", None, 2021, "listed", [])),
}


def rows_of(spark, cases):
    rows = [(name, kind, subject, datetime.date(2021, 12, 20), text, anchored) for name, ((kind, subject, text, anchored), _) in cases.items()]
    return spark.createDataFrame(rows, "doc_id string, kind string, subject string, date date, text string, anchored boolean")


@pytest.fixture(scope="module")
def got(spark):
    tables = spark.createDataFrame([("tabled", "read", [(None, 5, 5, "table", "column_totals")])], f"doc_id string, status string, lines {dp.LINES}")
    return {r["doc_id"]: r for r in dp.grant_rows(rows_of(spark, CASES), HOME, tables).collect()}


def test_every_decision_has_a_row(got):
    assert set(got) == set(CASES)
    assert {r["read_status"] for r in got.values()} == {"read", "absent", "not_found", "no_pdf", "listed"}


@pytest.mark.parametrize("name", CASES)
def test_decision(got, name):
    r = got[name]
    lines = [(x["recipient"], x["amount"], x["net"], x["validation"]) for x in r["lines"]]
    assert (r["family"], r["category"], r["budget_year"], r["read_status"], lines) == CASES[name][1]
    assert r["n_amounts"] == len(lines) and r["n_validated"] == sum(x[3] is not None for x in lines)


def test_one_scan_of_the_texts(spark, tmp_path):
    path = f"{tmp_path}/docs"
    rows_of(spark, CASES).write.parquet(path)
    plan = dp.dispatch(spark.read.parquet(path), HOME)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_lines_of_decisions(spark, got):
    rows = dp.grant_lines(dp.grant_rows(rows_of(spark, {k: CASES[k] for k in ("foundation", "order_none")}), HOME)).collect()
    assert [(r["doc_id"], r["line_no"], r["recipient"], r["category"]) for r in rows] == [("foundation", 0, "1", "foundation_contribution"), ("foundation", 1, "2", "foundation_contribution")]


WITH_TABLES = dp.Home("ΝΗΣΙΔΟΣ", "1", "999000111", bodies=(("2", "ΣΧΟΛΙΚ[Α-Ω]* ΕΠΙΤΡΟΠ"),), code="58000")
LINES_CASES = {
    "allocation": (("interior", "Κατανομή από ΚΑΠ έτους 2020", "  1  50100  ΑΛΦΑΣ    100,00\n  2  58000  ΝΗΣΙΔΟΣ    250,00\n     ΣΥΝΟΛΟ    350,00\n", False), ("kap_general", "kap_general", 2020, "read", [("1", 25000, 25000, "column_totals")])),
    "allocation_others": (("interior", "Κατανομή από ΚΑΠ", "  1  50100  ΑΛΦΑΣ    100,00\n  2  50200  ΒΗΤΑΣ    250,00\n     ΣΥΝΟΛΟ    350,00\n", False), ("kap_general", "kap_general", 2021, "absent", [])),
    "letter": (("economy", "Κατανομή χρηματοδότησης", "μεταφορά ποσού εξήντα χιλιάδων ευρώ (60.000,00 €) με υπόλογο διαχειριστή το Δήμο Νησίδος, ΑΦΜ 999000111", False),
               ("pde_financing", "investment_programmes", 2021, "read", [("1", 6000000, 6000000, "words_and_figures")])),
    "transfer_table": (("digital", "Εκκαθάριση - εντολή πληρωμής", "  1  έργο ΔΗΜΟΣ ΝΗΣΙΔΟΣ          100,00\n  2  άλλο έργο          50,00\n     ΣΥΝΟΛΟ                       150,00", False), None),
    "culture": (("culture", "Επιχορήγηση εκδήλωσης", "αποφασίζουμε την επιχορήγηση ύψους εξήντα χιλιάδων ευρώ (60.000,00 €) στη Σχολική Επιτροπή", False), ("culture_grant", None, 2021, "read", [("2", 6000000, 6000000, "words_and_figures")])),
    "order": CASES["order"],
}


def test_tables_are_read_beside(spark):
    got = {r["doc_id"]: r for r in dp.grant_rows(rows_of(spark, LINES_CASES), WITH_TABLES).collect()}
    for name, (_, want) in LINES_CASES.items():
        r = got[name]
        lines = [(x["recipient"], x["amount"], x["net"], x["validation"]) for x in r["lines"]]
        if want is None:
            assert r["family"] == "rrf_payment" and r["read_status"] in ("read", "not_found")
        else:
            assert (r["family"], r["category"], r["budget_year"], r["read_status"], lines) == want, name

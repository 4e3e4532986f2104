"""Operators on small fixtures with invented names and ids."""

import random
import re
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.operators import classify as k
from obolus.operators import dedupe as dq
from obolus.operators import gates as g
from obolus.operators import privacy as pv
from obolus.operators.resolve import class_targets, propagate_payee_class
from obolus.operators.shape import group_digest, maybe_among, without_nearby
from obolus.plans import documents as dx
from obolus.plans.views import Release, v_budget_month
from obolus.sources import landing as ld
from obolus.sources.registry import corrections, registry

c = F.col


# ---- corrections ---------------------------------------------------------------------------------
def lines(spark):
    rows = [("Α1", i, Decimal(a), "00.6131") for i, a in enumerate(("10.00", "20.00", "30.50", "40.00"))]
    return spark.createDataFrame(rows, "source_ada string, line_no int, amount decimal(18,2), kae string")


def flags(spark, *entries):
    table = corrections(spark, {"mismatch": list(entries)})["mismatch"]
    return [r["doc_mismatch"] for r in k.apply_line_corrections(lines(spark), table).orderBy("line_no").collect()]


def test_correction_of_one_line_and_of_all(spark):
    assert flags(spark, {"ada": "Α1", "line_no": 2, "metadata_amount": 30.5, "kae": "00.6131"}) == [False, False, True, False]
    assert flags(spark, {"ada": "Α1"}) == [True] * 4


@pytest.mark.parametrize("entry", [{"line_no": 2, "metadata_amount": 31}, {"line_no": 2, "metadata_amount": 30.5, "kae": "x"}])
def test_correction_that_moved_fails(spark, entry):
    with pytest.raises(Exception, match="no longer matches"):
        flags(spark, {"ada": "Α1", **entry})


def test_correction_of_a_line_that_is_not_there(spark):
    table = corrections(spark, {"mismatch": [{"ada": "Α1", "line_no": 9, "metadata_amount": 1}]})["mismatch"]
    assert k.check_correction_lines(lines(spark), table).count() == 1


# ---- classification ---------------------------------------------------------------------------------
def payment(spark, *rows):
    base = dict(source_ada="Α1", line_no=0, afm=None, afm_type=None, name="Εταιρεία Χ ΑΕ", subject="Προμήθεια", kae="00.6131", amount=Decimal("10.00"), doc_mismatch=False, duplicate=False)
    data = [{**base, **r, "line_no": i} for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "source_ada string, line_no int, afm string, afm_type string, name string, subject string, kae string, amount decimal(18,2), doc_mismatch boolean, duplicate boolean")
    return k.classify_payment_lines(df, spark.createDataFrame([("800000001",)], "afm string")).orderBy("line_no").collect()


def test_payee_classes_in_order(spark):
    got = payment(spark, {"afm": "800000001", "subject": "Απόδοση κρατήσεων"}, {"subject": "Απόδοση κρατήσεων"}, {"kae": "00.8211"}, {"kae": "055.5920102001"}, {"kae": "00.6311"},
                  {"name": "Δ.Ο.Υ. Νησίδος"}, {"subject": "Πληρωμή ΕΝΦΙΑ"}, {"kae": "00.6511"}, {"name": "Τράπεζα Χ"}, {"name": "Δήμος Άλλος"}, {"name": "ΣΚΑΠΑΝΕΙΣ ΙΚΑΡΟΣ ΕΠΕ"})
    assert [r["payee_class"] for r in got] == ["internal_transfer", "remittance", "remittance", "remittance", "tax", "tax", "tax", "debt_service", "debt_service", "other_public_body", "supplier"]


def test_payroll_drops_the_person_and_keeps_the_euros(spark):
    got = payment(spark, {"name": "ΕΠΩΝΥΜΟ & ΛΟΙΠΟΙ", "afm": "100000000"}, {"name": "ΕΠΩΝΥΜΟ,,ΟΝΟΜΑ", "subject": "Μισθοδοσία"}, {"name": "ΕΠΩΝΥΜΟ ΟΝΟΜΑ", "afm": "100000000", "kae": "00.6011"},
                  {"name": "ΕΠΩΝΥΜΟ ΟΝΟΜΑ", "afm": "100000000"}, {"name": "ΕΤΑΙΡΕΙΑ ΟΕ", "afm": "100000000"}, {"name": "ΕΠΩΝΥΜΟ ΟΝΟΜΑ", "afm": "090000000"})
    assert [r["payroll_kind"] for r in got] == ["batch", "named", "personnel_kae", None, None, None]
    assert [r["counterparty_display"] for r in got] == [None, None, None, fv.MASK, "ΕΤΑΙΡΕΙΑ ΟΕ", "ΕΠΩΝΥΜΟ ΟΝΟΜΑ"]
    assert all(r["counterparty_afm"] is None and r["amount"] == 10 for r in got[:3])


def test_suspect_is_strictly_above_and_the_reasons_have_an_order(spark):
    over = Decimal(fv.SUSPECT_ABOVE) + Decimal("0.01")
    got = payment(spark, {"amount": Decimal(fv.SUSPECT_ABOVE)}, {"amount": over, "doc_mismatch": True, "duplicate": True}, {"doc_mismatch": True, "duplicate": True}, {"duplicate": True})
    assert [r["suspect_reason"] for r in got] == [None, "threshold", "document_mismatch", "duplicate_posting"]


@pytest.mark.parametrize("subject, want", [
    ("Αποδοχή χρηματοδότησης ποσού 7.150,00€ από την Περιφερειακή Ένωση Δήμων", ("acceptance", "ped", 715000)),
    ("Έγκριση 2ης αναμόρφωσης για αποδοχή χρηματοδότησης ποσού 1.400,00€ από την Περιφέρεια Ν. Αιγαίου", ("amendment", "region", 140000)),
    ("Εισήγηση για αποδοχή επιχορήγησης από το ΥΠΕΣ", ("proposal", "interior", None)),
    ("Αποδοχή παραίτησης συμβούλου", None), ("Αποδοχή όρων δανείου ποσού 5,00", None),
])
def test_acceptances(spark, subject, want):
    r = spark.createDataFrame([(subject,)], "s string").select(k.acceptance(c("s")).alias("a")).first()["a"]
    assert (None if r is None else (r["kind"], r["grantor"], r["amount_cents"])) == want


@pytest.mark.parametrize("subject, act_type, anchored, keep, want", [
    ("Κατανομή ποσού σε Δήμους", "Α.2", False, fv.KEEP_DEFAULT, None), ("AΠOΔOΣH EΣOΔΩN", "Α.2", False, fv.KEEP_DEFAULT, None),
    ("Κατανομή προσωπικού", "Β.1.1", True, fv.KEEP_DEFAULT, "personal"), ("Επιχορήγηση του κ. Επωνύμου", "Α.2", True, fv.KEEP_DEFAULT, "personal"),
    ("ΕΝΤΑΛΜΑ ΠΛΗΡΩΜΗΣ", "Β.2.2", False, fv.KEEP_DEFAULT, "not_a_grant"), ("ΕΝΤΑΛΜΑ ΠΛΗΡΩΜΗΣ", "Β.2.2", True, fv.KEEP_DEFAULT, None),
    ("Επιχορήγηση Συλλόγου", "Β.4", False, ("own_body",), "not_a_grant"), ("Έργα του Δήμου Νησίδος", "Α.2", False, ("own_body",), None),
    ("Τακτική επιχορήγηση", "Β.4", False, ("statutory_grant",), None),
])
def test_whitelist(spark, subject, act_type, anchored, keep, want):
    keep_col = F.array(*[F.lit(x) for x in keep])
    got = spark.createDataFrame([(subject, act_type)], "s string, t string").select(k.whitelist_reason(c("s"), c("t"), F.lit(anchored), keep_col, "ΔΗΜΟΥ ΝΗΣΙΔΟΣ").alias("r")).first()["r"]
    assert got == want


def test_registry_defaults_and_unknown_rules(spark):
    doc = {"in_scope": [{"uid": 1, "name": "Δήμος", "afm": "800000001", "active_years": [2011, 2026]}], "out_of_scope": [{"uid": 2, "name": "Άλλος"}],
           "anchor_codes": [{"code": "2018ΣΕ1", "uid": 1}], "grantors": [{"uid": 5, "name": "Υ"}, {"uid": 6, "name": "Ι", "keep": ["own_body"], "group": "foundation"}]}
    r = registry(spark, doc)
    assert {x["term"] for x in r["anchor"].collect()} == {"800000001", "2018ΣΕ1"}
    assert [(x["grantor_group"], tuple(x["keep"])) for x in r["grantor"].orderBy("uid").collect()] == [("interior", fv.KEEP_DEFAULT), ("foundation", ("own_body",))]
    with pytest.raises(ValueError, match="unknown keep rule"):
        registry(spark, {"grantors": [{"uid": 5, "name": "Υ", "keep": ["everything"]}]})


# ---- propagation ----------------------------------------------------------------------------------------
def test_propagation_threshold_ties_and_reach(spark):
    def p(afm, klass, eur, status="PUBLISHED", suspect=False):
        return (afm, klass, "line", Decimal(eur), status, suspect, "Α")
    rows = [p("a", "tax", "79.90"), p("a", "supplier", "20.10"), p("b", "tax", "80"), p("b", "supplier", "20"), p("b", "supplier", "5", "REVOKED"), p("b", "supplier", "5", suspect=True),
            p("c", "tax", "40"), p("c", "remittance", "40"), p("c", "supplier", "20"), p("d", "internal_transfer", "80"), p("d", "supplier", "20"), p(None, "supplier", "1"), p("e", "tax", "9")]
    df = spark.createDataFrame(rows, "counterparty_afm string, payee_class string, payee_class_rule string, amount decimal(18,2), act_status string, amount_suspect boolean, source_ada string")
    assert {r[0]: r[1] for r in class_targets(df).collect()} == {"b": "tax", "c": "remittance"}
    out = propagate_payee_class(df)
    assert out.count() == len(rows)
    assert out.filter(c("payee_class_rule") == "afm_propagation").groupBy("counterparty_afm").count().orderBy("counterparty_afm").collect() == [("b", 3), ("c", 1)]


# ---- intervals and pairing against brute force -----------------------------------------------------------
@pytest.mark.parametrize("days", [0, 1, 60])
def test_interval_check_equals_brute_force(spark, days):
    rnd = random.Random(days)
    start = date(2020, 1, 1)
    left = [(rnd.choice("ab"), start + timedelta(rnd.randrange(900))) for _ in range(15)] + [(None, start)]
    right = [(i, rnd.choice(["a", "b", "z", None]), start + timedelta(rnd.randrange(900))) for i in range(400)]
    got = without_nearby(spark.createDataFrame(right, "i int, k string, d date"), spark.createDataFrame(left, "k string, e date"), ["k"], "e", "d", days)
    want = {i for i, k_, d in right if k_ is None or not any(k_ == q and abs((d - e).days) <= days for q, e in left)}
    assert {r["i"] for r in got.collect()} == want


def test_pairing_equals_the_greedy_rule(spark):
    rnd = random.Random(3)
    start = date(2020, 1, 1)
    grants = [(f"G{i:03}", rnd.choice("xy"), start + timedelta(rnd.randrange(1500))) for i in range(120)]
    pays = [(f"P{i:03}", rnd.choice("xy"), start + timedelta(rnd.randrange(1500))) for i in range(60)]
    used, want = set(), {}
    for ada, key, day in sorted(grants, key=lambda x: (x[2], x[0])):
        for pay, key2, when in sorted(pays, key=lambda x: (x[2], x[0])):
            if pay not in used and key == key2 and 0 <= (when - day).days <= 366:
                want[ada] = pay
                used.add(pay)
                break
    got = dq.pair_in_time(spark.createDataFrame(grants, "ada string, k string, date date"), spark.createDataFrame(pays, "ada string, k string, date date"), ["k"])
    assert {r["ada"]: r["paid_by"] for r in got.collect()} == want


# ---- money counted once ----------------------------------------------------------------------------------------
def test_paid_replaced_paired_and_unpaid_grants(spark):
    d = [("ΓΡ1", "grant", date(2021, 3, 2)), ("ΠΛ1", "payment", date(2021, 7, 6)), ("ΓΡ2", "grant", date(2023, 7, 1)), ("ΓΡ3", "grant", date(2024, 4, 5)), ("ΠΛ3", "payment", date(2024, 8, 5)), ("ΓΡ4", "grant", date(2022, 12, 5))]
    dec = spark.createDataFrame([(a, "9", f, day, None) for a, f, day in d], "ada string, issuer string, family string, date date, duplicate_of string")
    amounts = spark.createDataFrame([("ΓΡ1", "a"), ("ΠΛ1", "a"), ("ΓΡ2", "b"), ("ΓΡ3", "c"), ("ΠΛ3", "c"), ("ΓΡ4", "d")], "ada string, amounts string")
    cites = spark.createDataFrame([("ΠΛ1", "ΓΡ1"), ("ΓΡ3", "ΓΡ2")], "ada string, cited string")
    got = dq.mark_paid_through(dec, amounts, cites, [("payment", ("grant",), ("9",))], "9", "grant", "payment")
    assert {r["ada"]: r["paid_by"] for r in got.collect()} == {"ΓΡ1": "ΠΛ1", "ΠΛ1": None, "ΓΡ2": "ΓΡ3", "ΓΡ3": "ΠΛ3", "ΠΛ3": None, "ΓΡ4": None}


def test_the_earliest_readable_copy_is_kept(spark):
    rows = [("Α", "1", "8", "Απόδοση", 1, "2018-03-30T10:52"), ("Β", "1", "8", "ΑΠΟΔΟΣΗ", 1, "2018-03-30T10:44"), ("Γ", "1", "9", "Απόδοση", 1, "2018"), ("Δ", "1", "7", "x", 0, "2016-1"), ("Ε", "1", "7", "x", 1, "2016-2"), ("Ζ", "1", None, "x", 1, "2016-2")]
    dec = spark.createDataFrame([(*r, date(2018, 3, 29)) for r in rows], "ada string, issuer string, protocol_number string, subject string, n_amounts int, submission_ts string, date date")
    got = dq.mark_duplicate_postings(dec, spark.createDataFrame([], "ada string, amounts string"))
    assert {r["ada"]: r["duplicate_of"] for r in got.collect()} == {"Α": "Β", "Β": None, "Γ": None, "Δ": "Ε", "Ε": None, "Ζ": None}


# ---- landing -----------------------------------------------------------------------------------------------------
def test_versions(spark):
    inc = spark.createDataFrame([("Ω1-Α", "x", 1), ("Ω1-Α", "x", 2), ("Ω1-Α", "y", 3), ("Ω2-Α", "z", 4), ("Ω3-Α", "old", 5), ("Ω3-Α", "later", 6), ("../Α", "x", 7)], "key string, digest string, seq int")
    held = spark.createDataFrame([("Ω2-Α", "first"), ("Ω3-Α", "old"), ("Ω3-Α", "later")], "key string, digest string")
    out = {r["seq"]: r["outcome"] for r in ld.version_outcomes(inc, held).collect()}
    assert out == {1: "new", 2: "unchanged", 3: "changed", 4: "changed", 5: "unchanged", 6: "unchanged", 7: "new"}
    assert sorted(r["seq"] for r in ld.land_versioned(inc, held, "decision").collect()) == [1, 3, 4]
    assert [r["seq"] for r in ld.refused_keys(inc, "decision").collect()] == [7]


def test_curated_write_keeps_its_order(spark, tmp_path):
    df = spark.range(1000).select((c("id") % 7).cast("string").alias("entity"), c("id").alias("ada"))
    ld.write_curated(df, str(tmp_path / "act"), ld.SORT_KEYS["act"])
    back = spark.read.parquet(str(tmp_path / "act"))
    assert back.count() == 1000 and len(list((tmp_path / "act").glob("*.zstd.parquet"))) > 0


def test_audit_log_appends(spark, tmp_path):
    for run in ("1", "2"):
        ld.append_audit(spark.createDataFrame([(run, "ok")], "run string, status string"), str(tmp_path / "log"))
    got = ld.read_audit(spark, str(tmp_path / "log"), "run string, status string")
    assert sorted(r["run"] for r in got.collect()) == ["1", "2"] and got.filter(c("ts").isNull()).count() == 0


# ---- windows -------------------------------------------------------------------------------------------------------
def test_windows_tile_their_span(spark):
    span = spark.createDataFrame([(date(2017, 1, 1), date(2026, 9, 25))], "a date, z date")
    half = g.plan_windows_halfopen(span, "a", "z", 150, 180).orderBy("window_from").collect()
    assert half[0]["window_from"] == date(2017, 1, 1) and half[-1]["window_to"] == date(2026, 9, 26)
    assert all(x["window_to"] == y["window_from"] for x, y in zip(half, half[1:]))
    incl = g.plan_windows_inclusive(span, "a", "z", 150, 180).orderBy("window_from").collect()
    assert incl[-1]["window_to"] == date(2026, 9, 25) and all((y["window_from"] - x["window_to"]).days == 1 for x, y in zip(incl, incl[1:]))
    with pytest.raises(ValueError):
        g.plan_windows_halfopen(span, "a", "z", 200, 180)


# ---- monthly statements ---------------------------------------------------------------------------------------------
def test_a_line_no_longer_printed_gives_its_money_back(spark):
    rows = [("1", m, "9999", 1.0 * m) for m in range(2, 6)] + [("1", m, "1329", 17460.0) for m in (2, 3)] + [("1", m, "1219", 17460.0) for m in (4, 5)]
    lines_ = spark.createDataFrame([(e, "revenue", 2015, m, k_, "x", f"S{m}", v, v) for e, m, k_, v in rows],
                                   "entity string, side string, period_year int, period_month int, kae string, description string, statement_ada string, assessed_or_warranted double, collected_or_paid double")
    got = v_budget_month(Release({"budget_line": lines_}.__getitem__)).filter("kae <> '9999'").orderBy("kae", "month").collect()
    assert [(r["kae"], r["month"], r["collected_in_period"], r["absent"]) for r in got] == [
        ("1219", 4, 17460, False), ("1219", 5, 0, False), ("1329", 2, 17460, False), ("1329", 3, 0, False), ("1329", 4, -17460, True), ("1329", 5, 0, True)]


# ---- privacy -----------------------------------------------------------------------------------------------------------
def leaks(spark, text, legal="ΚΩΝΣΤΑΝΤΙΝΟΣ ΜΥΛΩΝΑΣ ΤΕΧΝΙΚΗ ΕΤΑΙΡΕΙΑ"):
    people = spark.createDataFrame([("123456780", "EL", "ΜΥΛΩΝΑΣ,,ΚΩΝΣΤΑΝΤΙΝΟΣ"), ("999999990", "EL", legal)], "afm string, afm_type string, name string")
    docs = spark.createDataFrame([("t", text)], "path string, text string")
    return sorted((r["line"], r["kind"]) for r in pv.scan_corpus(docs, "path", "text", pv.person_markers(people)).collect())


@pytest.mark.parametrize("text, want", [
    ("ok\nΑΛΦΑ,,ΒΗΤΑ εδώ", [(2, "person_form")]), ("SURNAME,,NAME", []), ("του Κωνσταντίνου", []), ("ο Κωνσταντίνος Μυλωνάς", [(1, "name")]), ("ΜYΛΩΝΑΣ ΚΩΝΣTΑΝΤΙΝΟΣ", [(1, "name")]),
    ("ΑΦΜ 123456780.", [(1, "afm")]), ("x123456780", []), ("Κωνσταντίνος Μυλωνάς Τεχνική", []), ("η Κωνσταντίνος Μυλωνάς Τεχνική Εταιρεία και άλλοι", []), ("Κωνσταντίνος Μυλωνάς Άλλο", [(1, "name")]),
])
def test_leaks(spark, text, want):
    assert leaks(spark, text) == want


def test_short_words_cover_though_they_are_in_no_key(spark):
    """neighbours that no key can have are not looked up; a legal body's name may hold them all the same."""
    legal = "Ο ΚΑΙ ΚΩΝΣΤΑΝΤΙΝΟΣ ΜΥΛΩΝΑΣ ΑΕ"
    assert leaks(spark, "Ο και Κωνσταντίνος Μυλωνάς ΑΕ", legal) == []
    assert leaks(spark, "Ο και Κωνσταντίνος\nΟ και Άλλος, Κωνσταντίνος Μυλωνάς ΑΕ", legal) == [(2, "name")]
    assert leaks(spark, "", legal) == leaks(spark, "ο", legal) == []


def test_publishing_fails_closed(spark):
    df = spark.createDataFrame([("p", 1, "afm", "x")], "path string, line int, kind string, match string")
    with pytest.raises(pv.PrivacyLeak):
        pv.assert_clean(df)
    pv.assert_clean(df.limit(0))
    with pytest.raises(pv.PrivacyLeak):
        pv.assert_allowed_columns(spark.createDataFrame([("x",)], "authorEmail string"))


# ---- documents ------------------------------------------------------------------------------------------------------------
STATEMENT = """\
              Στοιχεία Εκτέλεσης Προϋπολογισμού
                    Περίοδος: Δεκέμβριος 2024
0111     Μισθώματα από ακίνητα             1.700,00      3.866,43      1.907,90
0129     Λοιπά έσοδα                       2.900,00      1.809,28      1.809,28
         ΣΥΝΟΛΟ ΕΣΟΔΩΝ                     4.600,00      5.675,71      3.717,18
6011     Τακτικές αποδοχές                 9.392,00      3.622,77      2.000,00
         ΣΥΝΟΛΟ ΕΞΟΔΩΝ                     9.392,00      3.622,77      2.000,00
"""


def test_statement_is_read_exactly_or_not_at_all(spark):
    docs = spark.createDataFrame([("ok", STATEMENT), ("cent", STATEMENT.replace("3.717,18", "3.717,19")), ("lost", STATEMENT.replace("0129     Λοιπά", "     Λοιπά")),
                                  ("twice", STATEMENT.replace("0129 ", "0111 ")), ("month", STATEMENT.replace("Δεκέμβριος", "Δεκέμβρη")), ("other", "ΔΕΚΕΜΒΡΙΟΣ--ΕΣΟΔΑ 1,00 2,00")], "doc_id string, text string")
    rows, refused = dx.extract_statements(docs)
    assert {r["doc_id"] for r in rows.collect()} == {"ok"}
    assert {r["doc_id"]: r["reason"] for r in refused.collect()} == {"cent": "revenue does not add up", "lost": "revenue does not add up", "twice": "code appears twice", "month": "unknown month", "other": "unknown layout"}


def amounts(spark, text, **config):
    r = dx.extract_validated_amounts(spark.createDataFrame([("d", text)], "doc_id string, text string"), config).first()
    return r["amount"], r["net"], r["status"], r["validation"]


OURS = ("999000111",)


def test_payment_order_words_or_total_and_payee(spark):
    order = "ΔΙΚΑΙΟΥΧΟΣ: ΔΗΜΟΣ ΝΗΣΙΔΟΣ Α.Φ.Μ.: 999000111 ΣΥΝΟΛΟ: 7.620,00 ### Επτά Χιλ. Εξακόσια Είκοσι (7.620,00) ευρώ ###"
    config = dict(payee=r"ΔΙΚΑΙΟΥΧΟΣ\W*.{0,80}?Α\.?Φ\.?Μ\.?\s*:?\s*(\d{9})", ids=OURS, amount=rf"###\s*([^()#]{{3,200}}?)\s*\(\s*({dx.A})\s*\)\s*ΕΥΡΩ", total=rf"ΣΥΝΟΛΟ\s*:\s*({dx.A})", abbreviations={r"ΧΙΛ\.": "ΧΙΛΙΑΔΕΣ"})
    assert amounts(spark, order, **config) == (762000, 762000, "read", "words_and_figures")
    assert amounts(spark, order.replace("Είκοσι", "Δέκα"), **config)[3] == "stated_amount"
    assert amounts(spark, order.replace("999000111", "111000999"), **config)[:3] == (None, None, "absent")


def test_equal_shares_must_make_the_total(spark):
    config = dict(share=rf"({dx.A})\s*ΕΥΡΩ\s*\(\s*({dx.A})\s*ΕΥΡΩ\s*[ΧX]\s*(\d+)")
    assert amounts(spark, "δαπάνη 30.480,00 ευρώ (7.620,00 ευρώ χ 4 Δήμοι)", **config) == (762000, 762000, "read", "stated_amount")
    assert amounts(spark, "δαπάνη 30.480,00 ευρώ (7.600,00 ευρώ χ 4 Δήμοι)", **config)[3] is None


def test_gross_withheld_and_net(spark):
    config = dict(gross_withheld_net=rf"ΠΛΗΡΩΤΕΟ\s+({dx.A})\s+({dx.A})\s+({dx.A})", words=r"ΣΥΝΟΛΟ ΕΝΤΑΛΜΑΤΟΣ\s*:\s*([^\d]{3,120}?ΕΥΡΩ)")
    text = "ΠΛΗΡΩΤΕΟ\n 12.000,00   360,00   11.640,00\n ΣΥΝΟΛΟ ΕΝΤΑΛΜΑΤΟΣ : Δώδεκα Χιλιάδες Ευρώ"
    assert amounts(spark, text, **config) == (1200000, 1164000, "read", "words_and_figures")
    assert amounts(spark, text.replace("360,00", "350,00"), **config)[3] is None


def test_a_figure_stated_twice(spark):
    config = dict(figures=rf"ΠΟΣΟ[\p{{L}}]*\s+({dx.A})", repeated=2)
    assert amounts(spark, "διάθεση ποσού 5.120,00 και πίστωση 5.120,00", **config)[3] == "stated_amount"
    assert amounts(spark, "διάθεση ποσού 5.120,00", **config)[3] is None


def test_letter_words_are_the_check(spark):
    docs = spark.createDataFrame([("a", "ποσό των δύο χιλιάδων εκατόν ευρώ (2.100,00€). Διαχειριστής ο Δήμος Νησίδος"), ("b", "ποσό των δύο χιλιάδων ευρώ (2.100,00€)")], "doc_id string, text string")
    got = dx.letter_amounts(docs, r"ΔΙΑΧΕΙΡΙΣΤ[^.]{0,80}ΝΗΣΙΔΟΣ").orderBy("doc_id").collect()
    assert [(r["amount"], r["ours"], r["validation"]) for r in got] == [(210000, True, "words_and_figures"), (210000, False, None)]


def test_a_batch_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    from obolus.streaming import streams as st
    rows = spark.range(400).selectExpr("cast(id % 100 as string) AS key", "concat('d', id % 3) AS digest", "id AS seq")
    rows.filter("seq < 300").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    for run in "ab":  # from a new checkpoint everything is seen again
        st.land_stream(stream, f"{tmp_path}/out", f"{tmp_path}/{run}", buckets=16).start().awaitTermination()
    landed = spark.read.parquet(f"{tmp_path}/out")
    assert landed.count() == rows.filter("seq < 300").select("key", "digest").distinct().count() == 300
    some = st._landed(spark, f"{tmp_path}/out", landed, [3])
    assert "PartitionFilters: [isnotnull" in (p := some._jdf.queryExecution().executedPlan().toString()) or "PartitionFilters: [(bucket" in p
    assert {r["bucket"] for r in landed.select("bucket").distinct().collect()} == set(range(16))


def test_curated_files_keep_the_order_of_their_keys(spark, tmp_path):
    from obolus.sources import landing as ld
    rows = spark.range(2000).selectExpr("concat('e', id % 7) AS entity", "cast(id * 7919 % 2000 as int) AS n", "cast(id % 3 as int) AS year")
    ld.write_curated(rows, f"{tmp_path}/t", ("entity", "n"), partition_by=("year",))
    import glob

    import pyarrow.parquet as pq
    files = glob.glob(f"{tmp_path}/t/year=*/*.parquet")
    assert len({f.split("/year=")[1][0] for f in files}) == 3
    for f in files:
        t = pq.ParquetFile(f).read().to_pylist()
        assert t == sorted(t, key=lambda r: (r["entity"], r["n"]))


def test_letterheads_meet_names_not_all_bodies_that_share_one(spark):
    """fifty bodies of one name are one row to join; whose letterhead it is stays as it was."""
    from obolus.plans import documents as dx
    names = spark.createDataFrame([(f"{i:02}", "Δήμος Νησίδος") for i in range(50)] + [("90", "Μουσείο Χάλκινου Αλόγου"), (None, "Λιμενικό Ταμείο"), ("91", None)], "uid string, name string")
    n = names.select("uid", F.array_sort(dx.letter_tokens(F.col("name"))).alias("words")).filter(F.col("uid").isNotNull() & (F.size("words") > 0))
    assert sorted((r["uid"], len(r["words"])) for r in dx.names_by_word(n).collect()) == [("00", 2), ("90", 3)]
    head = "Ελληνική Δημοκρατία\r\n  \r\n ΔΗΜΟΣ ΝΗΣΙΔΟΣ\n"
    docs = spark.createDataFrame([("own", "07", head), ("other", "90", head), ("none", None, head), ("museum", "07", "ΕΛΛΗΝΙΚΗ ΔΗΜΟΚΡΑΤΙΑ\nΜΟΥΣΕΙΟ ΧΑΛΚΙΝΟΥ ΑΛΟΓΟΥ"), ("no head", "07", "ΜΟΥΣΕΙΟ ΧΑΛΚΙΝΟΥ ΑΛΟΓΟΥ"),
                                  ("no text", "07", None), ("twice", "90", head), ("twice", "07", head)], "doc_id string, entity string, text string")
    got = {(r["doc_id"], r["other"]) for r in dx.foreign_letterheads(docs, names).collect()}
    assert got == {("other", "00"), ("museum", "90")}


def test_a_groups_digest_is_that_of_its_printed_hashes(spark):
    """hashes are shuffled as bytes; the digest is the printed ones', of texts that are no hash too, and nulls count."""
    import hashlib
    one, two = hashlib.sha256(b"1").hexdigest(), hashlib.sha256(b"2").hexdigest()
    groups = {"a": [one, two, one], "b": [one, one.upper()], "c": [two, None], "d": [one + "\n", "12", ""]}
    df = spark.createDataFrame([(k, h) for k, hs in groups.items() for h in hs], "k string, h string")
    number = lambda t: int(re.match("[0-9a-fA-F]*", t).group() or "0", 16)

    def expected(hs):
        some = [h for h in set(hs) if h is not None]
        lanes = [[number(h[8 * i:8 * i + 8]) for h in some if h[8 * i:8 * i + 8].strip()] for i in range(8)]
        text = ":".join([str(len(set(hs))), *[str(sum(x)) for x in lanes if x]])
        return hashlib.sha256(text.encode()).hexdigest()

    out = group_digest(df, ["k"], "h")
    assert {r["k"]: r["digest"] for r in out.collect()} == {k: expected(hs) for k, hs in groups.items()}
    assert not re.search(r"hashpartitioning\([^)]*\bh#", out._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("words", [64, 1 << 22])
def test_a_filter_loses_no_row(spark, words):
    """rows that meet a member stay whatever the filter's size; of the others a filter of enough words lets few through."""
    df = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("a"), (c("id") % 7).cast("int").alias("b"), "id")
    members = df.filter("id % 10 = 0").select("a", "b")
    out = maybe_among(df, ["a", "b"], members, words)
    assert out.columns == ["a", "b", "id", "_maybe"] and out.count() == 20_000
    assert out.filter("id % 10 = 0 and not _maybe").count() == 0
    if words > 64:
        assert out.filter("id % 10 <> 0 and _maybe").count() < 1_800
    assert maybe_among(df, ["a", "b"], members.limit(0)).filter("_maybe").count() == 0
    assert maybe_among(df.select(F.lit(None).cast("string").alias("a"), "b"), ["a", "b"], members).filter("_maybe is null").count() == 0


def test_only_likely_names_are_shuffled(spark, monkeypatch):
    """of all neighbouring words those meet the keys that a filter of the keys lets through."""
    plans = []
    monkeypatch.setattr(pv, "written", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df.localCheckpoint())
    people = spark.createDataFrame([("123456789", "EL", "ΠΑΠΠΑΣ,,ΝΙΚΟΣ")], "afm string, afm_type string, name string")
    docs = spark.createDataFrame([("p", "ο Νίκος Παππάς και άλλοι\nκανείς άλλος εδώ")], "path string, text string")
    keys, _, legal = pv.person_markers(people)
    found = pv.find_name_leaks(pv.lines_of(docs, "path", "text"), keys, legal)
    assert [(r["path"], r["line"], r["match"]) for r in found.collect()] == [("p", 1, "ΝΙΚΟΣ ΠΑΠΠΑΣ")]
    hits = next(p for p in plans if "LeftSemi" in p)
    assert "_words" in hits.partition("LeftSemi")[2]

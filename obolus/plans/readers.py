"""Readers of single kinds of grant documents: configurations of one job, two small jobs beside it
(items of a decision, escrow releases and deposits), and the dispatch by kind and family.

Patterns are fixed values on the folded text; what names the home body (its folded name in the
genitive and its tax id) is a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.functions.money import cents_eu, number_cents, unshift_words, words_to_cents_lenient
from obolus.functions.text import flat_fold, fold
from obolus.operators.rules import first_match
from obolus.operators.shape import once
from obolus.plans.documents import amounts_by_kind, times_printed

c = F.col
A = fv.AMOUNT_EU
ID9 = r"Α\.?Φ\.?Μ\.?\s*:?\s*(\d{9})"
# «ποσού των ‹words› (‹figures›)», also with guillemets around either
WORDS_FIG = rf"ΠΟΣΟ[\p{{L}}\p{{N}}_]*\s+(?:ΤΩΝ\s+|ΤΟΥ\s+)?\(?\s*([^()«»\d€]{{3,300}}?)\s*\)?\s*[(«]?\s*€?\s*({A})(?:\s*€)*\s*[)»]"


def configurations(home: str, home_id: str, former_ids: tuple[str, ...] = ()) -> dict[str, dict]:
    """Kind of document -> configuration of ``extract_validated_amounts``."""
    ids = (home_id,)
    return {
        # a regional payment order: payee by id, words = figures, net = figures - withheld
        "region_payment": dict(payee=rf"ΣΤΟ ΔΙΚΑΙΟΥΧΟ\s+.{{3,120}}?\s+ΔΙΕΥΘΥΝΣΗ:.{{0,240}}?ΑΦΜ:\s*(\d{{9}})", ids=ids,
                               figures=rf"ΕΝΤΟΛΗ ΠΛΗΡΩΜΗΣ ΕΥΡΩ:\s*#\s*({A})\s*#", words=rf"ΕΝΤΟΛΗ ΠΛΗΡΩΜΗΣ ΕΥΡΩ:\s*#\s*{A}\s*#.{{0,160}}?\(([^()]{{3,200}})\)",
                               net=rf"ΕΝΤΕΛΛΟΜΕΝΟ ΠΟΣΟ ΣΤΟ ΔΙΚΑΙΟΥΧΟ:\s*({A})", withheld=rf"ΣΥΝΟΛΟ ΚΡΑΤΗΣΕΩΝ:\s*({A})"),
        # a fund's approval (words) and its payment order (total = voucher)
        "fund_approval": dict(absent_unless=home_id, payee=rf"(?:ΚΑΤΑΒΛΗΘΕΙ|ΑΠΟΔΟΘΕΙ) ΣΤΟ[ΝΙ]? ΔΗΜΟ {home}[^.]{{0,40}}?(\d{{9}})", ids=ids,
                              amount=rf"ΕΓΚΡΙΣΗ ΔΑΠΑΝΗΣ (?:ΤΟΥ )?ΠΟΣΟΥ (?:ΤΩΝ )?([^()#\d]{{3,300}}?)\s*\(\s*({A})\s*€?\s*\)"),
        "fund_order": dict(absent_unless=home_id, payee=rf"ΔΙΚΑΙΟΥΧΟΥ/ΩΝ: ΔΗΜΟΣ {home} \(ΑΦΜ: (\d{{9}})", ids=ids, figures=rf"ΣΥΝΟΛΙΚΟΥ ΠΟΣΟΥ\s+({A})\s*ΕΥΡΩ",
                           total=rf"ΣΥΝΟΛΙΚΗ ΑΞΙΑ ΠΑΡΑΣΤΑΤΙΚΟΥ\s+({A})"),
        # a union's payment order, and its board's grants: an equal share, or a figure stated again
        "union_payment": dict(payee=rf"ΔΙΚΑΙΟΥΧΟΣ\W*.{{0,80}}?{ID9}", ids=ids, amount=rf"###\s*([^()#]{{3,200}}?)\s*\(\s*({A})\s*\)\s*ΕΥΡΩ\s*###",
                              total=rf"ΣΥΝΟΛΟ\s*:\s*({A})", net_printed=rf"ΚΑΘΑΡ\.?\s*ΔΙΚΑΙΟΥΧ[\p{{L}}\p{{N}}_]*\s*:\s*({A})", abbreviations={r"ΧΙΛ\.": "ΧΙΛΙΑΔΕΣ"}),
        "union_share": dict(anchor="Α ?Π ?Ο ?Φ ?Α ?Σ ?Ι ?Ζ ?Ε ?Ι", share=rf"({A})\s*(?:€|ΕΥΡΩ)?\s*\(\s*({A})\s*(?:€|ΕΥΡΩ)?\s*[ΧX×]\s*(\d+)"),
        "union_grant": dict(anchor="Α ?Π ?Ο ?Φ ?Α ?Σ ?Ι ?Ζ ?Ε ?Ι", figures=rf"ΠΟΣΟ[\p{{L}}\p{{N}}_]*\s+(?:ΤΩΝ\s+|ΤΟΥ\s+)?({A})", repeated=2),
        # an environmental fund's payment: payee by id, else by name
        "green_payment": dict(first="ΕΓΚΡΙΝΟΥΜΕ", payee_required=True, read_empty=True, subject=True, payee=rf"ΔΙΚΑΙΟΥΧ[\p{{L}}\p{{N}}_]*.{{0,160}}?{ID9}", ids=ids, amount=WORDS_FIG,
                              payee_name=rf"ΔΙΚΑΙΟΥΧΟ[\p{{L}}\p{{N}}_]*\s+(?:ΤΟ[ΝΥ]?\s+|ΤΗΝ\s+)?ΔΗΜΟ[\p{{L}}\p{{N}}_]? {home}(?![\p{{L}}\p{{N}}_])"),
        # a transfer to the account the home body manages
        "shipping_transfer": dict(payee=rf"(?:ΥΠΟΛΟΓΟ[\p{{L}}\p{{N}}_]* ΔΙΑΧΕΙΡΙΣΤ[\p{{L}}\p{{N}}_]*|ΦΟΡΕΑΣ ΥΛΟΠΟΙΗΣΗΣ).{{0,60}}?ΔΗΜΟ[\p{{L}}\p{{N}}_]* {home}.{{0,40}}?(\d{{9}})",
                                  ids=ids, anchor=None, amount=WORDS_FIG),
        # an organisation's order: gross, withheld, net
        "organisation_payment": dict(payee=rf"ΔΙΚΑΙΟΥΧΟΣ\s*:\s*ΔΗΜΟΣ {home}\s*\(\s*ΑΦΜ\s*:\s*(\d{{9}})", ids=ids + former_ids,
                                     gross_withheld_net=rf"ΕΝΤΕΛΛΟΜΕΝΟ\s+ΣΥΝΟΛΟ\s+ΠΛΗΡΩΤΕΟ\s+({A})\s+({A})\s+({A})", words=r"ΣΥΝΟΛΟ ΕΝΤΑΛΜΑΤΟΣ\s*:\s*([^\d]{3,120}?ΕΥΡΩ)"),
    }


OUT = ("doc_id", "amount", "net", "status", "validation")


def read_by_kind(docs: DataFrame, configs: dict[str, dict], kind: str = "kind") -> DataFrame:
    """Amounts of documents (doc_id, kind, text) by their kind's configuration; other kinds are
    'listed'. One scan: what a row is asked for is chosen by its kind."""
    subject = c("subject") if "subject" in docs.columns else F.lit(None).cast("string")
    known = F.coalesce(c(kind).isin(*configs), F.lit(False))
    flat = once(docs.select("doc_id", c(kind).alias("kind"), "text", subject.alias("subject")), "flat", F.when(known, flat_fold(c("text"))))
    return amounts_by_kind(flat, configs).withColumn("status", F.coalesce("status", F.lit("listed"))).select(*OUT)


# ---- programme agreements a payment's sub-project is named in ----------------------------------------------------
def under_agreement(payments: DataFrame, agreements: DataFrame) -> DataFrame:
    """(doc_id) of payments (doc_id, sub_project) whose sub-project, of three words or more, stands in the
    subject of an agreement. Inside the subject every word but the first and last of the
    sub-project is a whole word: the one that the fewest agreements have is the join key. Ids of
    agreements go through the join, their texts are fetched for the containment check."""
    clean = lambda x: F.trim(F.regexp_replace(F.regexp_replace(fold(x), "['\"]", " "), " +", " "))
    a = once(agreements, "agreement", clean(c("subject"))).select("agreement").distinct().withColumn("id", F.xxhash64("agreement"))
    words = a.select("id", F.explode(F.array_distinct(F.split("agreement", " "))).alias("w"))
    times = words.groupBy("w").agg(F.count("*").alias("times"))
    p = once(payments, "sub", clean(c("sub_project"))).select("doc_id", "sub", F.split("sub", " ").alias("parts")).filter(F.size("parts") >= 3)
    inner = p.select("doc_id", "sub", F.posexplode(F.slice("parts", F.lit(2), F.size("parts") - 2)).alias("_i", "w"))
    rare = inner.join(times, "w", "left").groupBy("doc_id", "sub").agg(F.min(F.struct(F.coalesce("times", F.lit(0).cast("bigint")).alias("times"), "w")).alias("k")).filter("k.times > 0")
    met = rare.select("doc_id", "sub", c("k.w").alias("w")).join(words, "w").select("doc_id", "sub", "id")
    return met.join(a, "id").filter(F.contains("agreement", "sub")).select("doc_id").distinct()


# ---- decisions of several items -------------------------------------------------------------------------------------
ITEM = "ΚΑΤΑΒΟΛΗ|ΚΑΗΑΒΟΛΗ|ΘΑΗΑΒΝΙΗ"
DECIDES = "ΑΠΟΦΑΣΙΖ|ΑΠΝΘΑΖΙΔ"
SUM_WORD = r"(?:ΠΟΣΟ|ΠΟΖΟ|ΠΝΖΝ)\p{L}*\s+(?:(?:ΤΩΝ|ΤΟΥ|ΗΩΝ|ΗΝΤ|ΣΩΝ|ΣΟΥ)\s+)?"
ITEM_FIGURE = r"\d{1,3}(?:\.\d{3})+(?:,\d{2})?|\d+,\d{2}|\d{3,6}"
STATUTORY = "ΤΑΚΤΙΚ|ΘΕΣΜΟΘΕΤ|ΝΟΜΟΘΕΤ|10%|ΕΙΣΦΟΡ|ΗΑΚΗΙΚ|ΘΕΖΜΟΘΕΗ"


def items_of(flat: Column, bodies: tuple[tuple[str, str], ...], home: str, home_uid: str) -> Column:
    """array<struct<item,sum,recipient,amount,validation,statutory>>: the operative part of a folded text split at
    its item marks; ``sum`` tells that an item states a sum at all, an item's recipient is the body
    it names, its words check its figures (also as a letter-shifting font prints them), figures
    alone are marked as such."""
    plain = F.replace(F.replace(flat, F.lit("€ΥΡΩ"), F.lit("ΕΥΡΩ")), F.lit("€ΥΠΩ"), F.lit("ΕΥΡΩ"))
    body = F.regexp_replace(plain, f"^.*?(?:{DECIDES})", "")
    items = F.when(body.rlike(ITEM), F.filter(F.split(body, f"(?={ITEM})", -1), lambda x: x.rlike(f"^(?:{ITEM})"))).otherwise(F.array(body))
    pattern = rf"{SUM_WORD}(.{{0,400}}?)\(?\s*({ITEM_FIGURE})(?![\d%.,/])"

    def one(t: Column, i: Column) -> Column:
        figures = F.regexp_extract(t, pattern, 2)
        return F.struct(i.alias("item"), t.rlike(SUM_WORD).alias("sum"),
                        F.coalesce(first_match(t, bodies), F.when(t.rlike(rf"ΔΗΜΟ[\p{{L}}\p{{N}}_]? {home}"), F.lit(home_uid))).alias("recipient"),
                        F.when(figures.contains(","), cents_eu(figures)).otherwise(number_cents(F.nullif(figures, F.lit("")))).alias("amount"),
                        F.trim(F.regexp_replace(F.regexp_extract(t, pattern, 1), r"[(]", " ")).alias("phrase"), t.rlike(STATUTORY).alias("statutory"))

    def checked(x: Column) -> Column:
        spelled = F.coalesce((words_to_cents_lenient(x["phrase"], folded=True) == x["amount"]) | (words_to_cents_lenient(unshift_words(x["phrase"]), folded=True) == x["amount"]), F.lit(False))
        return F.struct(x["item"].alias("item"), x["sum"].alias("sum"), x["recipient"].alias("recipient"), x["amount"].alias("amount"),
                        F.when(spelled, F.lit("words_and_figures")).otherwise(F.lit("figures_only")).alias("validation"), x["statutory"].alias("statutory"))
    return F.transform(F.transform(items, one), checked)


def decision_items(docs: DataFrame, bodies: tuple[tuple[str, str], ...], home: str, home_uid: str) -> DataFrame:
    """(doc_id, item, recipient, amount, validation, statutory): the items of each document that pay one of our bodies."""
    flat = once(docs.select("doc_id", "text"), "flat", flat_fold(c("text")))
    rows = flat.select("doc_id", F.explode(items_of(c("flat"), bodies, home, home_uid)).alias("x"))
    return rows.filter("x.recipient is not null and x.amount is not null").select("doc_id", "x.item", "x.recipient", "x.amount", "x.validation", "x.statutory")


def statutory_decisions(items: DataFrame, home_uid: str) -> DataFrame:
    """(doc_id) of decisions whose every item for the home body pays the statutory grant."""
    return (items.filter(c("recipient") == home_uid).groupBy("doc_id").agg(F.bool_and("statutory").alias("s")).filter(c("s")).select("doc_id"))


# ---- escrow releases and deposits -------------------------------------------------------------------------------------
def escrow_of(flat: Column, home: str) -> Column:
    """array<struct<method,amount,validation>>: releases from escrow and deposits in the home body's favour. An
    amount counts when it is stated twice, or when all together are a budget the text states."""
    release = rf"ΝΑ ΕΚΤΑΜΙΕΥΣΕΙ .{{0,160}}?ΤΟ ΠΟΣΟ ΤΩΝ €?\s*({A})"
    deposit = rf"ΠΑΡΑΚΑΤΑΘΗΚΗΣ ΥΠΕΡ (?:ΤΟΥ )?ΔΗΜΟΥ {home} ΠΟΣΟΥ (?:ΥΨΟΥΣ )?({A})"
    budget = rf"ΠΡΟΥΠΟΛΟΓΙΣΜΟΥ\s+({A})"
    found = lambda p, text: F.regexp_extract_all(text, F.lit(p), 1)
    body = F.regexp_replace(flat, "^.*(?=ΑΠΟΦΑΣΙΖΟΥΝ)", "")
    deposits = found(deposit, body)
    one = lambda m, f, n: F.struct(F.lit(m).alias("method"), cents_eu(f).alias("amount"), n.alias("n"))
    rows = F.concat(F.transform(found(release, body), lambda f: one("escrow_release", f, times_printed(flat, cents_eu(f)))),
                    F.transform(F.array_distinct(deposits), lambda f: one("escrow_deposit", f, F.size(F.filter(deposits, lambda x: x == f)))))
    zero = F.lit(0).cast("bigint")
    whole = F.coalesce(F.array_contains(F.transform(found(budget, flat), cents_eu), F.aggregate(rows, zero, lambda a, x: a + x["amount"])), F.lit(False))
    return F.transform(rows, lambda r: F.struct(r["method"].alias("method"), r["amount"].alias("amount"), F.when((r["n"] >= 2) | whole, F.lit("stated_amount")).alias("validation")))


def escrow_amounts(docs: DataFrame, home: str) -> DataFrame:
    """(doc_id, method, amount, validation) of each document's escrow releases and deposits."""
    flat = once(docs.select("doc_id", "text"), "flat", flat_fold(c("text")))
    return flat.select("doc_id", F.explode(escrow_of(c("flat"), home)).alias("r")).select("doc_id", "r.*")


def split_two_purpose(lines: DataFrame, tables: DataFrame, docs: DataFrame, code: str, family: str) -> DataFrame:
    """Our row of a table that adds two purposes, as two amounts: the column whose total the text charges
    to the named account is an amount of ``family``, the other keeps the decision's."""
    charge = rf"({A})\s*€?\s*(?:ΣΕ ΧΡΕΩΣΗ|ΝΑ ΒΑΡΥΝΕΙ|ΒΑΡΥΝΕΙ)\s+(?:ΤΟΝ\s+|ΤΟΥ\s+)?ΛΟΓΑΡΙΑΣΜΟ[\p{{L}}\p{{N}}_]*\s+(?:ΜΕ\s+(?:ΤΟΝ\s+)?ΤΙΤΛΟ\s+)?«?\s*ΚΕΝΤΡΙΚΟΙ\s+ΑΥΤΟΤΕΛΕΙΣ"
    charged = once(docs.select("doc_id", "text"), "charged", F.transform(F.regexp_extract_all(flat_fold(c("text")), F.lit(charge), 1), cents_eu)).select("doc_id", "charged")
    t = tables.filter((c("layout") == "sum") & (c("width") == 3)).join(charged, "doc_id")
    hits = F.filter(F.sequence(F.lit(0), F.lit(1)), lambda j: F.array_contains("charged", F.get("column_totals", j)))
    t = once(t, "_kap", hits).filter(F.size("_kap") == 1)
    rows = t.select("doc_id", "table", "valid_columns", F.get("_kap", F.lit(0)).alias("j"), F.explode("rows").alias("r")).filter(c("r.code") == code)
    parts = F.explode(F.array(F.struct((1 - c("j")).alias("col"), F.lit(None).cast("string").alias("family")), F.struct(c("j").alias("col"), F.lit(family).alias("family"))))
    split = rows.select("doc_id", "table", "r", "valid_columns", parts.alias("x")).select(
        "doc_id", "table", F.get("r.amounts", c("x.col")).alias("amount"), F.when(F.get("valid_columns", c("x.col")), F.lit("column_totals")).alias("validation"), "x.family")
    whole = lines.join(split.select("doc_id", "table").distinct(), ["doc_id", "table"], "left_anti").select("doc_id", "table", "amount", "validation", F.lit(None).cast("string").alias("family"))
    return whole.unionByName(split)

"""Grant decisions read: one scan of the documents gives every decision its family, what its document
says of it and its lines, each by the reader that its issuer's kind and its family call for.

A text is folded once; which reader a row is for is a column, every value is chosen by it, and a row
pays for its own reader alone. Tables that spread over lines (allocations, transfers) are jobs over
lines, on the texts of the decisions that need them (``table_lines``). What decides after reading (a credit of the
region's own, the budget year of the operative part, the category) follows in the same rows.

Patterns are fixed values on folded text; what names the home body is ``Home``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus import grant_rules as gr
from obolus.functions.codes import budget_year
from obolus.functions.money import amounts_in, cents_eu, words_to_cents, words_to_cents_lenient
from obolus.functions.text import flat_fold, fold
from obolus.operators.shape import once
from obolus.plans.allocations import read_decisions
from obolus.plans.documents import amounts_by_kind, times_printed
from obolus.plans.readers import A, WORDS_FIG, configurations, escrow_of, items_of, under_agreement
from obolus.plans.transfers import Payee, other_grants, read_transfers
from obolus.session import written

c = F.col
_X = r"[\p{L}\p{N}_]*"

# ---- fixed values: what a reader looks for on the folded text ----------------------------------------
UNION_DECIDES = "Α ?Π ?Ο ?Φ ?Α ?Σ ?Ι ?Ζ ?Ε ?Ι"
UNION_SHARE = rf"({A})\s*(?:€|ΕΥΡΩ)?\s*\(\s*({A})\s*(?:€|ΕΥΡΩ)?\s*[ΧX×]\s*(\d+)"
UNION_AMOUNT = rf"ΠΟΣΟ{_X}\s+(?:ΤΩΝ\s+|ΤΟΥ\s+)?({A})"
UNION_PART = rf"(?:^|\s)[Α-Ω]\.\s+([^()]{{3,120}}?)\s*ΕΥΡΩ\s*\(({A})"
UNION_YEAR = r"(?:ΟΙΚ\.?|ΟΙΚΟΝΟΜΙΚΟΥ)\s*ΕΤΟΥΣ\s+(20\d\d)"
#: The first item of a decision ends where the second begins; so many characters of it are its own.
ITEM_2, ITEM_LENGTH = r"\s2\.\s", 900
GREEN_APPROVES = "ΕΓΚΡΙΝΟΥΜΕ ΤΗΝ? ΔΑΠΑΝΗ"
# every place where words may begin, so matches may overlap
CREDIT = rf"(?=(?:ΥΨΟΥΣ|ΠΟΣΟ{_X}|ΠΙΣΤΩΣΗ{_X})\s+(?:ΤΩΝ\s+)?([^()#\d]{{3,300}}?)\s*\(\s*({A})\s*€?\s*\))"
TRANSFER = "ΜΕΤΑΒΙΒΑΣΤΕΙ ΣΤΟ[ΝΙ]? "
COMMITMENT = rf"ΕΓΚΡΙΝΟΥΜΕ ΤΗ ΔΕΣΜΕΥΣΗ ΠΙΣΤΩΣΗΣ .{{0,200}}?ΓΙΑ ΤΗΝ ΠΛΗΡΩΜΗ ΙΣΟΠΟΣΗΣ ΔΑΠΑΝΗΣ .{{0,200}}?(?:ΠΣ|ΠΡΟΓΡΑΜΜΑΤΙΚ{_X} ΣΥΜΒΑΣ{_X})"
SUB_PROJECT = r"ΤΙΤΛΟΣ ΥΠΟΕΡΓΟΥ:\s*(.{3,200}?)\s*ΚΩΔΙΚΟΣ ΝΟΜΙΚΗΣ|ΥΠΟΕΡΓΟ[ΥΝ]? [«\"]([^»\"]{3,200})[»\"]"
AGREEMENT = rf"ΠΡΟΓΡΑΜΜΑΤΙΚ|{fv.W}Π\.?Σ\.? (?:ΜΕΤΑΞΥ|ΠΝΑ)"
FUND_APPROVAL = r"ΕΓΚΡΙΣΗ ΔΑΠΑΝΗΣ (?:ΤΟΥ )?ΠΟΣΟΥ "
#: Families of other issuers whose documents state an amount, and those of transfers to a project's account.
OTHER_GRANTS = ("election_costs", "school_books", "pde_financing", "culture_grant", "tourism_grant")
TRANSFERS = ("pde_financing", "espa_financing", "pde_authorisation", "rrf_payment")
#: Readers that are jobs over lines.
BY_LINES = ("allocation", "transfers", "other_grant")
SHIPPING = {"pde_authorisation": "ΠΑΡΑΚΑΛΟΥΜΕ", "shipping_payment": "ΑΠΟΦΑΣΙΖΟΥΜΕ", "shipping_grant": "ΑΠΟΦΑΣΙΖΟΥΜΕ"}

LINE = "struct<recipient:string,amount:bigint,net:bigint,method:string,validation:string>"
LINES = f"array<{LINE}>"


@dataclass(frozen=True)
class Home:
    """The home body: its folded name in the genitive, its uid and tax id, ids it had before, the other bodies that
    belong to it (uid, pattern), and other bodies a foundation gives to."""
    name: str
    uid: str
    tax_id: str
    former_ids: tuple[str, ...] = ()
    bodies: tuple[tuple[str, str], ...] = ()
    others: tuple[str, ...] = gr.FOUNDATION_OTHERS
    fund_id: str | None = None
    #: The code of its row in allocation tables, and its bodies as payees of transfer tables; without a code tables are not read.
    code: str | None = None
    payees: tuple[Payee, ...] = ()


def _configs(home: Home) -> dict[str, dict]:
    """Readers of one amount in one place, by reader."""
    told = configurations(home.name, home.tax_id, home.former_ids)
    manager = rf"(?:ΥΠΟΛΟΓΟ{_X} ΔΙΑΧΕΙΡΙΣΤ{_X}|ΦΟΡΕΑΣ ΥΛΟΠΟΙΗΣΗΣ).{{0,60}}?ΔΗΜΟ{_X} {home.name}.{{0,40}}?{home.tax_id}|{home.tax_id}"
    shipping = {f: dict(present=manager, last=word, amount=WORDS_FIG, subject=True) for f, word in SHIPPING.items()}
    kinds = ("region_payment", "fund_approval", "fund_order", "union_payment", "green_payment", "organisation_payment")
    return {k: told[k] for k in kinds} | shipping


METHODS = {"region_payment": "payment_order", "fund_approval": "fund_approval", "fund_order": "fund_payment_order", "union_payment": "payment_order", "green_payment": "letter",
           "organisation_payment": "payment_order"}


def _reader(kind: Column, family: Column, flat: Column, home: Home) -> Column:
    """The reader of a decision that has a document: a configuration's name, one of the readers below, one of
    ``BY_LINES``, or 'listed'."""
    at = lambda k, *families: (kind == k) & family.isin(*families)
    return (F.when(family == "rrf_payment", F.lit("transfers")).when(at("region", "region_payment"), F.lit("region_payment")).when(at("region", "region_credit"), F.lit("credit"))
            .when(at("region", "region_agreement"), F.when(flat.rlike(COMMITMENT) & flat.rlike(f"ΔΗΜΟ[ΣΥ]? {home.name}"), F.lit("commitment")).otherwise(F.lit("listed")))
            .when(at("region_fund", "region_fund_payment"), F.when(flat.rlike(FUND_APPROVAL), F.lit("fund_approval")).otherwise(F.lit("fund_order")))
            .when(at("union", "ped_payment"), F.lit("union_payment")).when(at("union", "ped_grant"), F.lit("union_grant"))
            .when(at("green_fund", "green_fund_payment"), F.when(flat.rlike(GREEN_APPROVES), F.lit("green_payment")).otherwise(F.lit("escrow")))
            .when(at("shipping", *SHIPPING), family).when(at("tourism_organisation", "eot_payment"), F.lit("organisation_payment"))
            .when(at("foundation", "foundation_statutory_grant", "foundation_grant"), F.lit("foundation"))
            .when(kind.isin("region", "region_fund", "union", "green_fund", "shipping", "tourism_organisation", "foundation"), F.lit("listed"))
            .when(kind.isin("economy", "infrastructure", "digital"), F.when(family.isin(*TRANSFERS), F.lit("transfers")).otherwise(F.lit("listed")))
            .when(kind.isin("administration", "education", "culture", "tourism"), F.when(family.isin(*OTHER_GRANTS), F.lit("other_grant")).otherwise(F.lit("listed")))
            .otherwise(F.lit("allocation")))


def _read(status: Column | str, family: Column | None = None, lines: Column | None = None) -> Column:
    """What a reader says: status, family (null: as it was), lines."""
    return F.struct((F.lit(status) if isinstance(status, str) else status).alias("status"), (family if family is not None else F.lit(None).cast("string")).alias("family"),
                    (lines if lines is not None else F.array().cast(LINES)).cast(LINES).alias("lines")).cast(f"struct<status:string,family:string,lines:{LINES}>")


def _line(amount: Column, net: Column, method: Column | str, validation: Column, recipient: Column | None = None) -> Column:
    return F.struct((recipient if recipient is not None else F.lit(None).cast("string")).alias("recipient"), amount.cast("bigint").alias("amount"), net.cast("bigint").alias("net"),
                    (F.lit(method) if isinstance(method, str) else method).alias("method"), validation.cast("string").alias("validation"))


def _spelled(flat: Column, pattern: str) -> Column:
    """array<struct<words,figures>> in cents of what a pattern finds: words in group 1, figures in group 2."""
    return F.zip_with(F.regexp_extract_all(flat, F.lit(pattern), 1), F.regexp_extract_all(flat, F.lit(pattern), 2),
                      lambda w, f: F.struct(words_to_cents(w, folded=True).alias("words"), cents_eu(f).alias("figures")))


def _credit(flat: Column, subject: Column, home: Home) -> Column:
    """The amount a credit's subject states, where the text spells it; to the home body, or through the development
    fund, which pays it on."""
    stated = F.get(amounts_in(subject), F.lit(0))
    ok = F.exists(_spelled(flat, CREDIT), lambda x: (x["figures"] == stated) & (x["words"] == stated))
    to = F.regexp_extract(flat, gr.TRANSFERRED_TO, 1)
    moved = flat.rlike(TRANSFER)
    lines = F.array(_line(stated, stated, "credit", F.when(F.coalesce(ok, F.lit(False)), F.lit("words_and_figures"))))
    fund = gr.DEVELOPMENT_FUND + (f"|{home.fund_id}" if home.fund_id else "")
    mine = to.startswith(f"ΔΗΜΟ {home.name}") | (~moved & flat.rlike(f"ΜΕΤΑΒΙΒΑΣΤΕΙ ΣΤΟ ΔΗΜΟ {home.name}|{home.tax_id}"))
    return (F.when(stated.isNull(), _read("not_found")).when(to.rlike(fund), _read("read", F.lit("region_credit_via_fund"), lines)).when(mine, _read("read", None, lines))
            .when(moved | ~flat.rlike(f"ΔΗΜΟ[ΥΣ]? {home.name}"), _read("absent")).otherwise(_read("not_found")))


def _commitment(flat: Column, subject: Column) -> Column:
    """A commitment of credit for the payment of an agreement: the one amount that words and figures give, which
    the subject does not contradict."""
    both = F.array_distinct(F.transform(F.filter(_spelled(flat, CREDIT), lambda x: x["words"] == x["figures"]), lambda x: x["figures"]))
    stated, amount = F.get(amounts_in(subject), F.lit(0)), F.get(both, F.lit(0))
    ok = (F.size(both) == 1) & (stated.isNull() | (stated == amount))
    return F.when(ok, _read("read", F.lit("region_agreement_commitment"), F.array(_line(amount, F.lit(None), "commitment", F.lit("words_and_figures"))))).otherwise(_read("listed"))


def _item_1(flat: Column) -> Column:
    """The first item of a board's decision: from the last word that decides to the second item."""
    operative = F.regexp_replace(flat, f"^.*(?:{UNION_DECIDES})", "")
    return F.substring(F.get(F.split(operative, ITEM_2, 2), F.lit(0)), 1, ITEM_LENGTH)


def _union_grant(flat: Column, item: Column, subject: Column) -> Column:
    """A board's grant in its first item: an equal share of a joint one; else its first sum, checked by its parts in
    words and figures (two or more, adding up) or by being printed twice. What the union organises
    or buys itself is its own spending."""
    own = _read("listed", F.lit("ped_own_spending"))
    part = lambda i: F.nullif(F.regexp_extract(item, UNION_SHARE, i), F.lit(""))
    share = cents_eu(part(2))
    shares = F.array(_line(share, share, "letter", F.when(F.coalesce(share * part(3).try_cast("bigint") == cents_eu(part(1)), F.lit(False)), F.lit("stated_amount"))))
    amount = cents_eu(F.nullif(F.regexp_extract(item, UNION_AMOUNT, 1), F.lit("")))
    spelled = F.zip_with(F.regexp_extract_all(item, F.lit(UNION_PART), 1), F.regexp_extract_all(item, F.lit(UNION_PART), 2),
                         lambda w, f: F.struct(words_to_cents_lenient(w, folded=True).alias("words"), cents_eu(f).alias("figures")))
    parts = F.filter(spelled, lambda x: x["words"] == x["figures"])
    total = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, x: a + x["figures"])
    check = F.when((F.size(parts) > 1) & (total == amount), F.lit("words_and_figures")).when(times_printed(flat, amount) >= 2, F.lit("stated_amount"))
    return (F.when(subject.rlike(gr.UNION_OWN_SPENDING), own).when(~flat.rlike(UNION_DECIDES), _read("not_found")).when(item.rlike(gr.UNION_OWN_SPENDING), own)
            .when(share.isNotNull(), _read("read", None, shares)).when(amount.isNull(), _read("not_found")).otherwise(_read("read", None, F.array(_line(amount, amount, "letter", check)))))


def _escrow(found: Column) -> Column:
    lines = F.transform(found, lambda x: _line(x["amount"], x["amount"], x["method"], x["validation"]))
    return _read(F.when(F.size(lines) > 0, F.lit("read")).otherwise(F.lit("not_found")), None, lines)


def _foundation(items: Column, home: Home) -> Column:
    """The items for our bodies; the family is the statutory grant's when every item for the home body pays that."""
    ours = F.filter(items, lambda x: x["recipient"].isNotNull() & x["amount"].isNotNull())
    to_home = F.filter(ours, lambda x: x["recipient"] == home.uid)
    others = F.exists(items, lambda x: x["recipient"].isNull() & x["sum"])
    lines = F.transform(ours, lambda x: _line(x["amount"], x["amount"], "foundation_decision", x["validation"], x["recipient"]))
    status = F.when(F.size(ours) > 0, F.lit("read")).when(others, F.lit("absent")).otherwise(F.lit("not_found"))
    return _read(status, F.when((F.size(to_home) > 0) & F.forall(to_home, lambda x: x["statutory"]), F.lit("foundation_statutory_grant")), lines)


def dispatch(docs: DataFrame, home: Home) -> DataFrame:
    """Adds to documents (doc_id, kind, subject, text; a null text: no document) the columns ``first_family``,
    ``reader``, ``said`` (status, family, lines), ``sub`` (the sub-project a fund pays) and ``operative_year``.
    The text goes: one scan, one row in, one row out."""
    d = once(docs, "folded", fold(c("subject")))
    d = once(d, "first_family", gr.family_of_folded(c("folded"), c("kind"), home.name, home.others))
    d = once(d, "flat", F.when(c("text").isNotNull(), flat_fold(c("text"))))
    d = once(d, "reader", F.when(c("flat").isNull(), F.lit("no_pdf")).otherwise(_reader(c("kind"), c("first_family"), c("flat"), home)))
    configs = _configs(home)
    d = amounts_by_kind(d, configs, "reader")
    only = lambda name, value: F.when(c("reader") == name, value)
    # one step for each reader: a generator is not merged into, so no step's code outgrows what the JVM compiles
    d = once(d, "item", only("union_grant", _item_1(c("flat"))))
    d = once(d, "board", only("union_grant", _union_grant(c("flat"), c("item"), c("folded"))))
    d = once(d, "found", only("escrow", escrow_of(c("flat"), home.name)))
    d = once(d, "items", only("foundation", items_of(c("flat"), home.bodies, home.name, home.uid)))
    d = once(d, "credit", F.when(c("reader") == "credit", _credit(c("flat"), c("subject"), home)).when(c("reader") == "commitment", _commitment(c("flat"), c("subject"))))
    method = gr.lookup(c("reader"), METHODS)
    by_config = F.array(_line(c("amount"), c("net"), F.coalesce(method, F.lit("letter")), c("validation")))
    refined = F.when(c("reader") == "region_payment", gr.refine_region_flat(c("first_family"), c("flat"), home.fund_id))
    d = once(d, "plain", F.when(c("reader").isin(*configs), _read(c("status"), F.when(c("status") == "read", refined), F.when(c("amount").isNotNull(), by_config).otherwise(F.array().cast(LINES)))))
    said = F.coalesce("plain", "credit", "board", only("escrow", _escrow(c("found"))), only("foundation", _foundation(c("items"), home)), _read(c("reader")))
    sub = F.concat(F.regexp_extract("flat", SUB_PROJECT, 1), F.regexp_extract("flat", SUB_PROJECT, 2))
    operative = F.regexp_replace("flat", f"^.*(?:{UNION_DECIDES})", "")
    year = F.nullif(F.regexp_extract(operative, UNION_YEAR, 1), F.lit("")).try_cast("int")
    gone = {"text", "flat", "folded", "amount", "net", "words", "status", "validation", "item", "board", "found", "items", "credit", "plain"}
    kept = [x for x in d.columns if x not in gone]
    return d.select(*kept, said.alias("said"), F.when(c("kind") == "region_fund", sub).alias("sub"), F.when(c("first_family") == "ped_grant", year).alias("operative_year"),
                    (c("flat").isNotNull() & (c("first_family") == "arrears") & F.coalesce(c("flat").rlike(gr.ARREARS_CEILING), F.lit(False))).alias("ceiling"))


def table_lines(docs: DataFrame, read: DataFrame, home: Home) -> DataFrame:
    """(doc_id, status, lines) of the decisions that jobs over lines read: allocation tables, transfer tables and
    letters, other grantors' decisions. Of ``docs`` only their texts are taken, once."""
    texts = written(docs.select("doc_id", "subject", "text").join(read.filter(c("reader").isin(*BY_LINES)).select("doc_id", "reader"), "doc_id"))
    of = lambda name: texts.filter(c("reader") == name).select("doc_id", "subject", "text")
    manager = rf"(?:ΥΠΟΛΟΓΟ{_X}.{{0,3}})?ΔΙΑΧΕΙΡΙΣΤ{_X}.{{0,80}}?ΔΗΜΟ{_X} {home.name}"
    none = F.lit(None).cast("string")
    rows = read_decisions(of("allocation"), home.code, manager, f"ΔΗΜΟ[ΣΥ]? {home.name}").withColumn("recipient", none)
    payees = home.payees or (Payee(home.uid, home.tax_id, f"ΔΗΜΟ[ΣΥ]? {home.name}", (home.code,)),)
    rows = rows.unionByName(read_transfers(of("transfers"), payees, manager).withColumn("net", c("amount")))
    ids = {home.tax_id: home.uid} | {p.tax_id: p.uid for p in home.payees}
    rows = rows.unionByName(other_grants(of("other_grant"), home.bodies, ids, home.name, home.uid).drop("how").withColumn("net", c("amount")))
    line = _line(c("amount"), c("net"), c("method"), c("validation"), c("recipient"))
    # the lines of one document
    return rows.groupBy("doc_id").agg(F.max_by("status", c("status") == "read").alias("status"), F.array_sort(F.collect_list(F.when(c("amount").isNotNull(), line))).alias("lines"))


def grant_rows(docs: DataFrame, home: Home, tables: DataFrame | None = None) -> DataFrame:
    """One row per decision of ``docs`` (doc_id, kind, subject, date, text, anchored; the last: found by one of our
    ids): kind, family, category, budget_year, read_status, n_amounts, n_validated, lines (recipient,
    amount, net, method, validation, category).

    ``tables``: (doc_id, status, lines) of the decisions that jobs over lines read, at most one row each, where
    they were read before; else they are read here if the home body has a code (``table_lines``); those
    without a row are 'not_found'. Payments of the development fund whose sub-project one of
    the region's agreements in ``docs`` names are payments under it: a lookup of names, not of texts."""
    read = written(dispatch(docs, home))
    agreements = read.filter((c("kind") == "region") & (c("first_family") == "region_agreement")).select("subject")
    paid = read.filter((c("reader").isin("fund_approval", "fund_order")) & (c("sub") != "")).select("doc_id", c("sub").alias("sub_project"))
    named = under_agreement(paid, agreements).select("doc_id", F.lit(True).alias("named"))
    d = read.join(named, "doc_id", "left")
    if tables is None:
        tables = table_lines(docs, read, home) if home.code else read.select("doc_id", F.lit(None).cast("string").alias("status"), F.lit(None).cast(LINES).alias("lines")).limit(0)
    d = d.join(tables.select("doc_id", c("status").alias("t_status"), c("lines").alias("t_lines")), "doc_id", "left")
    tabled = c("reader").isin(*BY_LINES)
    status = F.when(tabled, F.coalesce("t_status", F.lit("not_found"))).otherwise(c("said.status"))
    lines = F.when(tabled, F.coalesce("t_lines", F.array().cast(LINES))).otherwise(c("said.lines"))
    subject = fold(c("subject"))
    under = c("reader").isin("fund_approval", "fund_order") & c("said.status").isin("read", "not_found") & (F.concat("sub", F.lit(" "), subject).rlike(AGREEMENT) | F.coalesce("named", F.lit(False)))
    family = F.coalesce(F.when(F.coalesce(under, F.lit(False)), F.lit("region_fund_agreement_payment")), F.when(c("ceiling") & (c("reader") == "allocation"), F.lit("arrears_ceiling")), "said.family", "first_family")
    own = (c("first_family") == "region_credit") & ~(F.coalesce("anchored", F.lit(False)) | subject.rlike(rf"{home.name}"))
    d = d.withColumns({"_status": status, "_lines": lines, "_family": family, "_own": own})
    last = gr.own_credit(c("first_family"), c("_own"), c("_family"), c("reader") != "no_pdf")
    d = d.withColumn("family", last)
    gone = c("family") == "region_own_credit"
    year = F.year("date")
    for_year = F.coalesce(F.when(c("family") == "ped_grant", c("operative_year")), F.when(c("family").startswith("foundation_"), year), budget_year(c("subject"), year))
    d = d.withColumns({"read_status": F.when(gone, F.when(c("reader") == "no_pdf", c("_status")).otherwise(F.lit("absent"))).otherwise(c("_status")), "budget_year": for_year})
    d = d.withColumn("category", gr.category_of(c("family"), c("budget_year")))
    full = F.transform(F.when(gone, F.array().cast(LINES)).otherwise(c("_lines")), lambda x: F.struct(
        F.coalesce(x["recipient"], gr.recipient_of(c("subject"), home.bodies, home.uid)).alias("recipient"), x["amount"].alias("amount"), x["net"].alias("net"), x["method"].alias("method"),
        x["validation"].alias("validation"), c("category").alias("category")))
    d = d.withColumn("lines", full)
    count = lambda keep: F.size(F.filter("lines", keep))
    return d.select("doc_id", "kind", "date", "subject", "family", "category", "budget_year", "read_status", F.size("lines").alias("n_amounts"),
                    count(lambda x: x["amount"].isNotNull() & x["validation"].isNotNull()).alias("n_validated"), "lines")


def grant_lines(decisions: DataFrame) -> DataFrame:
    """One row per amount of ``grant_rows``."""
    return decisions.select("doc_id", "family", "budget_year", F.posexplode("lines").alias("line_no", "x")).select("doc_id", "line_no", "family", "budget_year", "x.*")

"""Classification of lines, payees and subjects. Every function is Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.functions.codes import code_major, code_scheme
from obolus.functions.money import cents_eu
from obolus.functions.text import fold, upper_plain
from obolus.operators.rules import first_match, holds
from obolus.operators.shape import once


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def is_reversal(subject: Column, recalled: Column | None = None) -> Column:
    named = holds(upper_plain(subject), fv.REVERSAL)
    return named if recalled is None else named | _true(recalled)


def is_natural_person(name: Column, tax_id: Column, id_type: Column, plain: Column | None = None) -> Column:
    """The register's double-comma form, an imprest holder, or a personal-range id on a short
    name with no legal-form word. ``plain`` is the name already without accents, upper case."""
    plain = upper_plain(name) if plain is None else plain
    by_form = name.contains(fv.PERSON_FORM) | holds(plain, fv.IMPREST)
    personal_id = (tax_id.rlike(fv.TAX_ID) & (F.coalesce(id_type, F.lit("")).isin("", "EL"))
                   & tax_id.rlike("^[0-3]") & ~tax_id.rlike("^0[89]"))
    words = F.size(F.filter(F.split(plain, r"[\s\p{Z}]+"), lambda w: w != ""))
    short = (words <= 4) & ~plain.rlike(fv.LEGAL_FORM)
    return _true((F.length(name) > 0) & (by_form | (_true(personal_id) & short)))


def payroll_kind(name: Column, subject: Column, natural: Column, code: Column, plain: Column | None = None,
                 plain_subject: Column | None = None, parts: tuple[Column, Column] | None = None) -> Column:
    """'batch', 'named' or 'personnel_kae'; null for a supplier line. ``parts`` are the scheme and the
    major of ``code`` already taken."""
    plain = upper_plain(name) if plain is None else plain
    plain_subject = upper_plain(subject) if plain_subject is None else plain_subject
    scheme, major = (code_scheme(code), code_major(code)) if parts is None else parts
    personnel = F.lit(False)
    for s, m in fv.PERSONNEL_MAJOR.items():
        personnel = personnel | ((scheme == s) & (major == m))
    return (F.when(plain.rlike(fv.BATCH_NAME), F.lit("batch"))
            .when(_true(name.contains(fv.PERSON_FORM)) & holds(plain_subject, fv.PAYROLL_SUBJECT), F.lit("named"))
            .when(natural & _true(personnel), F.lit("personnel_kae")))


def is_remittance(subject: Column, code: Column, plain_subject: Column | None = None, parts: tuple[Column, Column] | None = None) -> Column:
    scheme, major = (code_scheme(code), code_major(code)) if parts is None else parts
    by_code = (scheme.isin("old", "bare") & (major == fv.REMITTANCE_MAJOR)) | \
              ((scheme == "new") & (major == fv.REMITTANCE_MAJOR_NEW))
    plain_subject = upper_plain(subject) if plain_subject is None else plain_subject
    return _true(by_code) | holds(plain_subject, fv.WITHHOLDING)


def payee_class(name: Column, subject: Column, code: Column, remittance: Column, family: Column, plain: Column | None = None,
                plain_subject: Column | None = None, parts: tuple[Column, Column] | None = None) -> Column:
    """internal_transfer, remittance, tax, debt_service, other_public_body or supplier: first
    that applies. ``family`` says whether the payee's id is one of our own bodies'."""
    n, major = upper_plain(name) if plain is None else plain, code_major(code) if parts is None else parts[1]
    s = upper_plain(subject) if plain_subject is None else plain_subject
    return (F.when(_true(family), F.lit("internal_transfer"))
            .when(_true(remittance), F.lit("remittance"))
            .when(_true(major == fv.TAX_MAJOR) | n.rlike(fv.TAX_PAYEE) | s.rlike(fv.TAX_SUBJECT), F.lit("tax"))
            .when(_true(major == fv.DEBT_MAJOR) | n.rlike(fv.DEBT_PAYEE), F.lit("debt_service"))
            .when(n.rlike(fv.PUBLIC_BODY), F.lit("other_public_body"))
            .otherwise(F.lit("supplier")))


def suspect_reason(amount: Column, mismatch: Column, duplicate: Column, above: float = fv.SUSPECT_ABOVE) -> Column:
    return (F.when(amount > F.lit(above), F.lit("threshold"))
            .when(_true(mismatch), F.lit("document_mismatch"))
            .when(_true(duplicate), F.lit("duplicate_posting")))


def mask_person(name: Column, natural: Column, payroll: Column | None = None) -> Column:
    shown = F.when(natural, F.lit(fv.MASK)).otherwise(name)
    return shown if payroll is None else F.when(~_true(payroll), shown)


def classify_payment_lines(lines: DataFrame, family_ids: DataFrame, suspect_above: float = fv.SUSPECT_ABOVE) -> DataFrame:
    """Payment lines -> typed payment lines.

    Needs afm, afm_type, name, subject, kae, amount, doc_mismatch, duplicate. ``family_ids`` is
    one column ``afm`` of distinct ids (the registry: as many rows as bodies we follow); Catalyst
    broadcasts it by its measured size. The person goes before the class is decided, so a masked
    employee is never a family id."""
    c = F.col
    # the folded name and subject and the code's parts are computed once; every rule below reads them
    out = once(once(lines, "_n", upper_plain(c("name"))), "_s", upper_plain(c("subject")))
    out = once(once(out, "_scheme", code_scheme(c("kae"))), "_major", code_major(c("kae")))
    n, s, parts = c("_n"), c("_s"), (c("_scheme"), c("_major"))
    out = once(out, "_natural", is_natural_person(c("name"), c("afm"), c("afm_type"), n))
    out = once(out, "payroll_kind", payroll_kind(c("name"), c("subject"), c("_natural"), c("kae"), n, s, parts))
    payroll = c("payroll_kind").isNotNull()
    out = out.withColumns({
        "kae_scheme": c("_scheme"), "kae_major": c("_major"),
        "is_payroll": payroll,
        "counterparty_afm": F.when(~payroll, c("afm")),
        "counterparty_afm_type": F.when(~payroll, c("afm_type")),
        "counterparty_name_raw": F.when(~payroll, c("name")),
        "is_remittance": ~payroll & is_remittance(c("subject"), c("kae"), s, parts),
    })
    ids = family_ids.select(c("afm").alias("_family_afm"), F.lit(True).alias("_family"))
    out = out.join(ids, c("counterparty_afm") == c("_family_afm"), "left")
    klass = payee_class(c("counterparty_name_raw"), c("subject"), c("kae"), c("is_remittance"), c("_family"), n, s, parts)
    out = once(out, "payee_class", F.when(payroll, F.lit("payroll")).otherwise(klass))
    reason = suspect_reason(c("amount"), c("doc_mismatch"), c("duplicate"), suspect_above)
    out = out.withColumns({
        "payee_class_rule": F.lit("line"),
        "counterparty_display": mask_person(c("counterparty_name_raw"), c("_natural"), payroll),
        "suspect_reason": reason,
    })
    return out.withColumns({
        "is_internal_transfer": c("payee_class") == "internal_transfer",
        "amount_suspect": c("suspect_reason").isNotNull(),
    }).drop("_n", "_s", "_scheme", "_major", "_family_afm", "_family", "_natural", "afm", "afm_type", "name", "doc_mismatch", "duplicate")


def apply_line_corrections(lines: DataFrame, corrections: DataFrame) -> DataFrame:
    """Adds ``doc_mismatch``. An entry without line number flags every line of its document; one
    with it flags that line, whose amount and code must still be the recorded ones, or the job
    fails. ``corrections``: doc, corr_line, corr_amount, corr_kae (a hand-kept table). A document has one
    entry: of several the one with the largest ``corr_seq``, where that column is given."""
    c = F.col
    entry = ["corr_line", "corr_amount", "corr_kae"]
    seq = [c("corr_seq")] if "corr_seq" in corrections.columns else []
    corrections = (corrections.groupBy("doc").agg(F.max_by(F.struct(*entry), F.struct(*seq, *entry)).alias("_e"))
                   .select("doc", *[c(f"_e.{x}").alias(x) for x in entry]))
    joined = lines.join(corrections, lines["source_ada"] == corrections["doc"], "left")
    named = c("doc").isNotNull() & c("corr_line").isNotNull() & (c("corr_line") == c("line_no"))
    same_amount = F.round(c("amount"), 2).eqNullSafe(F.round(c("corr_amount"), 2)) & c("amount").isNotNull()
    same_code = c("corr_kae").isNull() | c("kae").eqNullSafe(c("corr_kae"))
    moved = F.raise_error(F.concat_ws(" ", F.lit("correction no longer matches"), c("source_ada"),
                                      c("line_no").cast("string"))).cast("boolean")
    flag = (F.when(c("doc").isNull(), F.lit(False))
            .when(c("corr_line").isNull(), F.lit(True))
            .when(named & same_amount & same_code, F.lit(True))
            .when(named, moved)
            .otherwise(F.lit(False)))
    return joined.withColumn("doc_mismatch", flag).drop("doc", "corr_line", "corr_amount", "corr_kae")


def check_correction_lines(lines: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrections naming a line their document does not have (must be empty)."""
    n = lines.groupBy("source_ada").agg(F.max("line_no").alias("last_line"))
    return (corrections.filter(F.col("corr_line").isNotNull())
            .join(n, corrections["doc"] == n["source_ada"], "left")
            .filter(F.col("last_line").isNull() | (F.col("corr_line") > F.col("last_line")) | (F.col("corr_line") < 0))
            .select("doc", "corr_line", "last_line"))


def is_execution_statement(act_type: Column, subject: Column) -> Column:
    s = fold(subject)
    return _true((act_type == fv.STATEMENT_TYPE) & s.contains("ΕΚΤΕΛΕΣ")
                 & (s.contains("ΠΡΟΥΠΟΛΟΓΙΣΜ") | s.contains("Π/Υ")))


def acceptance(subject: Column) -> Column:
    """struct(kind, grantor, amount_cents) of a title that accepts another body's money; null otherwise."""
    s = fold(subject)
    accepts = (s.rlike(fv.ACCEPT) & ~s.rlike(fv.ACCEPT_NOT_MONEY)
               & (s.rlike(fv.ACCEPT_MONEY) | s.rlike(fv.ACCEPT_DONATION)))
    kind = first_match(s, (("amendment", fv.ACCEPT_AMENDMENT), ("proposal", fv.ACCEPT_PROPOSAL)), "acceptance")
    amount = F.nullif(F.regexp_extract(s, f"({fv.ACCEPT_AMOUNT})", 1), F.lit(""))
    return F.when(accepts, F.struct(kind.alias("kind"), first_match(s, fv.ACCEPT_GRANTORS, "unknown").alias("grantor"),
                                    cents_eu(amount).alias("amount_cents")))


def whitelist_reason(subject: Column, act_type: Column, anchored: Column, keep: Column, own_body: str) -> Column:
    """Null when a found record is kept, else 'personal' (checked first) or 'not_a_grant'.
    ``keep`` is the array of rules in force; ``own_body`` the pattern of our bodies' names."""
    s = fold(subject)
    rule = lambda name, hit: F.array_contains(keep, name) & hit
    kept = (_true(anchored) | rule("grant_words", s.rlike(fv.GRANT_WORDS))
            | rule("investment_acts", _true(act_type.isin(*fv.GRANT_ACT_TYPES)))
            | rule("own_body", s.rlike(own_body)) | rule("statutory_grant", s.rlike(fv.STATUTORY_GRANT)))
    return F.when(s.rlike(fv.PERSONAL), F.lit("personal")).when(kept, F.lit(None)).otherwise(F.lit("not_a_grant"))


def keep_rules(found: DataFrame, grantors: DataFrame) -> DataFrame:
    """(ada, keep): the union of the rules of every issuer whose search kept the record, in the
    rules' own order. ``found`` (ada, issuer) is long, one row per record and searching issuer;
    ``grantors`` (uid, keep) is the registry. At most four rules per record are gathered."""
    default = F.array(*[F.lit(r) for r in fv.KEEP_DEFAULT])
    rules = (found.distinct().join(grantors, found["issuer"] == grantors["uid"], "left")
             .select("ada", F.explode(F.coalesce("keep", default)).alias("rule")))
    return rules.groupBy("ada").agg(F.array_intersect(
        F.array(*[F.lit(r) for r in fv.KEEP_RULES]), F.collect_set("rule")).alias("keep"))

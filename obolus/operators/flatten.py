"""Nested documents -> flat, typed rows. All of it is row-local: a document's lists are exploded
where the document is, and nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.functions.codes import as_list, code_major, code_scheme, distinct_sorted, iso_day, string_list
from obolus.functions.money import MONEY
from obolus.functions.text import civil_date, record_type, utc_ts
from obolus.operators.classify import is_natural_person, is_reversal, mask_person
from obolus.operators.shape import once
from obolus.session import written
from obolus.sources.documents import KAE_LINE, PARTY, SPONSOR

c = F.col
EV = "doc.extraFieldValues"


def _base(docs: DataFrame) -> list[Column]:
    day = civil_date(c("doc.issueDate"), fv.CIVIL_ZONE)
    return [c("doc.organizationId").alias("entity"), day.alias("date"), F.year(day).alias("year"), c("doc.status").alias("act_status"),
            c("doc.ada").alias("source_ada"), c("sha256").alias("source_sha256")]


def related_keys(ev: str = EV) -> Column:
    """Keys a document names in any of its three link fields."""
    a = F.transform(as_list(c(f"{ev}.relatedEkgrisiDapanis"), "struct<textRelatedADA:string>"), lambda x: x["textRelatedADA"])
    b = F.transform(as_list(c(f"{ev}.relatedDecisions"), "struct<relatedDecisionsADA:string>"), lambda x: x["relatedDecisionsADA"])
    own = F.array(c(f"{ev}.textRelatedADA"))
    return F.array_sort(F.array_distinct(F.filter(F.concat(a, b, own), lambda x: x.isNotNull() & (x != ""))))


def _strings(raw: Column) -> Column:
    """Null, scalar or list -> list of strings in the document's order."""
    t = F.trim(raw)
    return F.when(raw.isNull(), F.array().cast("array<string>")).when(t.startswith("["), F.from_json(t, "array<string>")).otherwise(F.array(raw))


def act_rows(docs: DataFrame) -> DataFrame:
    d = c("doc")
    day = civil_date(d["issueDate"], fv.CIVIL_ZONE)
    return docs.select(
        d["ada"].alias("ada"), d["organizationId"].alias("entity"), d["decisionTypeId"].alias("type"), day.alias("date"), F.year(day).alias("year"),
        d["subject"].alias("subject"), d["status"].alias("status"), _strings(d["signerIds"]).alias("signer_ids"), _strings(d["unitIds"]).alias("unit_ids"),
        _strings(d["thematicCategoryIds"]).alias("thematic_ids"), d["protocolNumber"].alias("protocol_number"), c(f"{EV}.documentType").alias("document_type"),
        d["versionId"].alias("version_id"), d["correctedVersionId"].alias("corrected_version_id"), utc_ts(d["submissionTimestamp"]).alias("submission_ts"),
        utc_ts(d["publishTimestamp"]).alias("publish_ts"), d["documentUrl"].alias("document_url"), d["ada"].alias("source_ada"),
        c("path").alias("source_path"), c("sha256").alias("source_sha256"))


def route_by_type(docs: DataFrame) -> dict[str, DataFrame]:
    """Documents of each measure, published or revoked; the pending ones counted by type. The documents are
    parsed once, into a table with a folder for each route, and a route reads its own."""
    t, status = c("doc.decisionTypeId"), c("doc.status")
    measured = F.coalesce(status.isin(*fv.MEASURE_STATUSES), F.lit(False))
    measure = F.when(t.isin(*fv.PAYMENT_TYPES), F.lit("payment")).when(t.isin(*fv.COMMITMENT_TYPES), F.lit("commitment")).when(t.isin(*fv.AWARD_TYPES), F.lit("award"))
    routed = docs.withColumn("route", F.when(~measured & measure.isNotNull(), F.lit("excluded_pending")).otherwise(measure)).filter(c("route").isNotNull())
    table = written(routed, "route")
    out = {name: table.filter(c("route") == name).drop("route") for name in ("payment", "commitment", "award")}
    return out | {"excluded_pending": table.filter(c("route") == "excluded_pending").groupBy(t.alias("type")).agg(F.count("*").alias("n"))}


def payment_lines(docs: DataFrame) -> DataFrame:
    """One row per sponsor line; a payment without lines gives one payroll row. The lines go on to
    the corrections and the classification; ``placeholder`` marks the rows that do not."""
    s = as_list(c(f"{EV}.sponsor"), SPONSOR)
    rows = docs.select(*_base(docs), related_keys().alias("related_ada"), c(f"{EV}.skipVatReason").alias("skip_vat_reason"),
                       c("doc.subject").alias("subject"), F.posexplode_outer(s).alias("_i", "s"))
    empty = c("_i").isNull()
    return rows.withColumns({
        "placeholder": empty, "line_no": F.coalesce("_i", F.lit(0)),
        "payment_id": F.concat_ws(":", "source_ada", F.coalesce(c("_i").cast("string"), F.lit("payroll"))),
        "afm": c("s.sponsorAFMName.afm"), "afm_type": c("s.sponsorAFMName.afmType"), "name": c("s.sponsorAFMName.name"),
        "amount": c("s.expenseAmount.amount"), "currency": c("s.expenseAmount.currency"), "kae": c("s.kae"), "cpv": _strings(c("s.cpv")),
    }).drop("_i", "s")


def payment_rows(docs: DataFrame, family_ids: DataFrame, mismatch: DataFrame | None = None, duplicates: DataFrame | None = None,
                 suspect_above: float = fv.SUSPECT_ABOVE) -> DataFrame:
    """Payment documents -> typed payment lines, corrections applied and payees classified."""
    from obolus.operators.classify import apply_line_corrections, classify_payment_lines
    lines = payment_lines(docs)
    lines = apply_line_corrections(lines, mismatch) if mismatch is not None else lines.withColumn("doc_mismatch", F.lit(False))
    if duplicates is not None:
        listed = duplicates.select(c("doc").alias("source_ada")).distinct().withColumn("_dup", F.lit(True))
        lines = lines.join(listed, "source_ada", "left").withColumn("duplicate", F.coalesce("_dup", F.lit(False))).drop("_dup")
    else:
        lines = lines.withColumn("duplicate", F.lit(False))
    # a document without lines is one payroll row: no party, no amount, never suspect
    lines = lines.withColumns({k: ~c("placeholder") & c(k) for k in ("doc_mismatch", "duplicate")})
    out = classify_payment_lines(lines, family_ids, suspect_above)
    empty = c("placeholder")
    return out.withColumns({
        "payroll_kind": F.when(empty, F.lit("no_sponsor")).otherwise(c("payroll_kind")), "is_payroll": empty | c("is_payroll"),
        "payee_class": F.when(empty, F.lit("payroll")).otherwise(c("payee_class")), "is_remittance": ~empty & c("is_remittance"),
        "is_internal_transfer": ~empty & c("is_internal_transfer"),
    }).drop("placeholder", "subject")


def commitment_rows(docs: DataFrame) -> DataFrame:
    """One row per budget-code line; none: one row from the act's total."""
    ev = c(EV)
    rows = docs.select(*_base(docs), ev["amountWithVAT"]["amount"].alias("act_amount_total"), ev["amountWithVAT"]["currency"].alias("currency"),
                       ev["financialYear"].alias("financial_year"), ev["budgettype"].alias("budget_type"),
                       F.coalesce(ev["partialead"], F.lit(False)).alias("is_partial"), F.coalesce(ev["recalledExpenseDecision"], F.lit(False)).alias("is_recall"),
                       is_reversal(c("doc.subject"), ev["recalledExpenseDecision"]).alias("is_reversal"), ev["relatedPartialADA"].alias("related_partial_ada"),
                       ev["entryNumber"].alias("entry_number"), F.posexplode_outer(as_list(ev["amountWithKae"], KAE_LINE)).alias("_i", "l"))
    has = c("_i").isNotNull()
    return rows.withColumns({
        "commitment_id": F.concat_ws(":", "source_ada", F.coalesce(c("_i").cast("string"), F.lit("act"))), "line_no": F.coalesce("_i", F.lit(0)),
        "has_kae_lines": has, "kae": c("l.kae"), "kae_scheme": code_scheme(c("l.kae")), "kae_major": code_major(c("l.kae")),
        "amount": F.when(has, c("l.amountWithVAT")).otherwise(c("act_amount_total")), "budget_remainder": c("l.kaeBudgetRemainder"),
        "credit_remainder": c("l.kaeCreditRemainder"), "counterparty_afm": c("l.sponsorAFMName.afm"), "counterparty_name_raw": c("l.sponsorAFMName.name"),
    }).drop("_i", "l")


def award_rows(docs: DataFrame) -> DataFrame:
    """One row per awardee; none: one row without."""
    ev = c(EV)
    rows = docs.select(*_base(docs), c("doc.decisionTypeId").alias("award_type"), ev["awardAmount"]["amount"].alias("amount"),
                       ev["awardAmount"]["currency"].alias("currency"), _strings(ev["cpv"]).alias("cpv"), ev["assignmentType"].alias("assignment_type"),
                       related_keys().alias("related_ada"), F.posexplode_outer(as_list(ev["person"], PARTY)).alias("_i", "p"))
    return rows.withColumns({
        "award_id": F.concat_ws(":", "source_ada", F.coalesce("_i", F.lit(0)).cast("string")), "line_no": F.coalesce("_i", F.lit(0)),
        "person_afm": c("p.afm"), "person_afm_type": c("p.afmType"), "person_name_raw": c("p.name")}).drop("_i", "p")


def acceptance_rows(docs: DataFrame) -> DataFrame:
    from obolus.functions.money import euros
    from obolus.operators.classify import acceptance
    day = civil_date(c("doc.issueDate"), fv.CIVIL_ZONE)
    return (docs.withColumn("a", acceptance(c("doc.subject"))).filter(c("a").isNotNull())
            .select(c("doc.ada").alias("ada"), c("doc.organizationId").alias("entity"), day.alias("date"), F.year(day).alias("year"),
                    c("doc.decisionTypeId").alias("type"), c("doc.status").alias("status"), c("a.grantor").alias("grantor"), c("a.kind").alias("kind"),
                    euros(c("a.amount_cents")).alias("amount_stated"), c("doc.ada").alias("source_ada"), c("path").alias("source_path"), c("sha256").alias("source_sha256")))


# ---- procurement records ---------------------------------------------------------------------------------
def _objects(d: Column) -> Column:
    return F.coalesce(F.when(F.size(d["objectDetails"]) > 0, d["objectDetails"]), d["objectDetailsList"])


def _record_base() -> list[Column]:
    d = c("doc")
    day = iso_day(d["submissionDate"])
    return [d["referenceNumber"].alias("ref"), c("endpoint"), c("org").alias("entity"), day.alias("submission_date"), F.year(day).alias("year"),
            F.coalesce(d["cancelled"], F.lit(False)).alias("cancelled"), c("path").alias("source_path"), c("sha256").alias("source_sha256")]


def procurement_rows(records: DataFrame) -> DataFrame:
    """One row per record: links as sorted key lists, the first contract type, distinct CPVs."""
    d = c("doc")
    objs = F.coalesce(_objects(d), F.array().cast(f"array<struct<cpvs:array<struct<key:string,value:string>>,vatNo:string,greekVatNo:boolean,name:string,costWithoutVAT:decimal(18,2)>>"))
    cpvs = F.flatten(F.transform(objs, lambda o: F.coalesce(F.transform(o["cpvs"], lambda x: x["key"]), F.array().cast("array<string>"))))
    refs = lambda *f: distinct_sorted(F.concat(*[string_list(d[x]) for x in f]))
    keys = F.array(*[d[x] for x in ("diavgeiaADA", "decisionRelatedAda", "paymentRelatedAda", "approvalADA")])
    nested = F.coalesce(F.map_values(F.from_json(d["contractRelatedADA"], "map<string,string>")), F.array().cast("array<string>"))
    contract = F.when(c("endpoint") == "contract", F.array(F.trim(d["referenceNumber"]))).otherwise(refs("contractRefNo"))
    types = F.try_element_at(d["contractTypes"], F.lit(1))["contractType"]["value"]
    return records.select(
        *_record_base(), record_type(d["referenceNumber"]).alias("record_type"), d["organization"]["key"].alias("organization_key"),
        iso_day(F.coalesce(F.nullif(d["contractSignedDate"], F.lit("")), d["signedDate"])).alias("signed_date"), d["title"].alias("title"),
        d["procedureType"]["value"].alias("procedure_type"), F.when(d["contractType"].isNotNull(), d["contractType"]["value"]).otherwise(types).alias("contract_type"),
        d["totalCostWithoutVAT"].alias("total_cost_without_vat"), d["totalCostWithVAT"].alias("total_cost_with_vat"), contract.alias("contract_refs"),
        refs("auctionRefNo", "auctionReferenceNumber").alias("auction_refs"), refs("noticeRefNo", "noticeReferenceNumber").alias("notice_refs"),
        refs("requestRefNo").alias("request_refs"), refs("paymentRefNo").alias("payment_refs"), distinct_sorted(F.concat(keys, nested)).alias("diavgeia_adas"),
        distinct_sorted(cpvs).alias("cpv"))


def _party(df: DataFrame, role: str) -> DataFrame:
    natural = is_natural_person(c("name"), c("afm"), F.when(c("greek"), F.lit("EL")))
    base = ["ref", "endpoint", "entity", "submission_date", "year", "cancelled"]
    return df.select(*base, F.lit(role).alias("role"), "afm", F.coalesce("greek", F.lit(False)).alias("is_greek_afm"), c("name").alias("name_raw"),
                     natural.alias("is_natural_person"), mask_person(c("name"), natural).alias("display_name"), "amount_with_vat", "source_path", "source_sha256")


def contractor_rows(records: DataFrame) -> DataFrame:
    m = c("doc.contractingDataDetails.contractingMembersDataList")
    rows = records.filter(c("endpoint").isin("auction", "contract")).select(*_record_base(), F.explode(m).alias("m"))
    blank = lambda x: F.nullif(F.trim(x), F.lit(""))
    return _party(rows.withColumns({"afm": blank(c("m.vatNumber")), "greek": c("m.greekVatNumber"), "name": blank(c("m.name")),
                                    "amount_with_vat": F.lit(None).cast(MONEY)}), "contractor")


def payee_rows(records: DataFrame) -> DataFrame:
    """Each payee's part of a payment: the gross by share of net, in equal parts when no net is
    stated. Sums are taken inside the record's own list."""
    d = c("doc")
    objs = F.filter(_objects(d), lambda o: F.trim(F.coalesce(o["vatNo"], F.lit(""))) != "")
    ids = F.array_distinct(F.transform(c("_objs"), lambda o: F.trim(o["vatNo"])))
    zero = F.lit(0).cast("decimal(28,2)")
    net = lambda items: F.aggregate(items, zero, lambda a, o: (a + F.coalesce(o["costWithoutVAT"], F.lit(0).cast(MONEY))).cast("decimal(28,2)"))
    parts = F.transform(ids, lambda i: F.struct(
        i.alias("afm"), net(F.filter(c("_objs"), lambda o: F.trim(o["vatNo"]) == i)).alias("net"),
        F.get(F.filter(c("_objs"), lambda o: F.trim(o["vatNo"]) == i), F.lit(0)).alias("o")))
    rows = (once(records.filter(c("endpoint") == "payment"), "_objs", objs)
            .withColumns({"_parts": parts, "_net": net(c("_objs"))})
            .select(*_record_base(), d["totalCostWithVAT"].alias("gross"), "_net", F.size("_parts").alias("_n"), F.explode("_parts").alias("p")))
    share = F.when(c("_net") != 0, (c("gross") * c("p.net")).cast("decimal(38,6)") / c("_net")).otherwise(c("gross") / c("_n"))
    return _party(rows.withColumns({"afm": c("p.afm"), "greek": c("p.o.greekVatNo"), "name": F.nullif(F.trim(c("p.o.name")), F.lit("")),
                                    "amount_with_vat": F.bround(share, 2).cast(MONEY)}), "payee")


def explode_terms(df: DataFrame, key: str, array: str, name: str) -> DataFrame:
    """An array field in long form."""
    return df.select(key, F.explode(array).alias(name))


def entity_rows(entity: DataFrame, path: str, sha256: Column) -> DataFrame:
    return entity.withColumns({"source_ada": F.lit(None).cast("string"), "source_path": F.lit(path), "source_sha256": sha256})

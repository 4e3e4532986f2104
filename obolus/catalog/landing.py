"""SRC, QG and RG: landing, gates and row generators over documents derived from the orders."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.catalog.oracle import pick
from obolus.catalog.registry import query
from obolus.catalog.views import NUMBERED, SQL as VIEWS
from obolus.functions.codes import valid_key
from obolus.operators import flatten as fl
from obolus.operators import gates as g
from obolus.operators.shape import canonical_digest, group_digest, set_digest
from obolus.plans.bindings import ACT_STATUS, ACT_TYPE, ENDPOINT, by_value
from obolus.sources import documents as docs
from obolus.session import shared_folder
from obolus.sources import landing as ld
from obolus.sources import registry

c = F.col


def prio() -> Column:
    return c("o_orderpriority")


def key(x: str) -> Column:
    return F.concat(F.lpad(c(x).cast("string"), 7, "0"), F.lit("-ΑΒΓ"))


def sql_key(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), 7, '0') || '-ΑΒΓ'"


def q(*parts) -> Column:
    return F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in parts])


# ---- documents as bytes ---------------------------------------------------------------------------------------
def athens_ms(day: Column) -> Column:
    return F.unix_millis(F.to_utc_timestamp(day.cast("timestamp"), fv.CIVIL_ZONE))


def sponsor(i: int) -> Column:
    return F.struct(F.struct(F.lpad((c("o_custkey") + i).cast("string"), 9, "0").alias("afm"), F.lit("EL").alias("afmType"), q("ΕΤΑΙΡΕΙΑ ", c("o_custkey").cast("string")).alias("name")).alias("sponsorAFMName"),
                    F.struct((c("price") + i).alias("amount"), F.lit("EUR").alias("currency")).alias("expenseAmount"), F.lit("20.6131").alias("kae"),
                    F.array(F.lit("45000000")).alias("cpv"))


def kae_line(i: int) -> Column:
    return F.struct(F.lit("20.6131").alias("kae"), (c("price") - i).alias("amountWithVAT"))


def person(i: int) -> Column:
    return F.struct(F.lpad((c("o_custkey") + i).cast("string"), 9, "0").alias("afm"), q("ΑΝΑΔΟΧΟΣ ", F.lit(str(i))).alias("name"))


def polymorphic(item) -> Column:
    """null, one object, lists of two and three, or an empty list, by segment."""
    s = c("c_mktsegment")
    return (F.when(s == "AUTOMOBILE", F.lit("null")).when(s == "BUILDING", F.to_json(item(0)))
            .when(s == "FURNITURE", F.to_json(F.array(item(0), item(1)))).when(s == "MACHINERY", F.to_json(F.array(item(0), item(1), item(2)))).otherwise(F.lit("[]")))


N_ITEMS = "CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'MACHINERY' THEN 3 ELSE 0 END"


def raw_acts(b):
    """(path, content): one JSON document per order, list fields in every form they arrive in."""
    subject = F.when(c("o_orderstatus") == "P", F.lit("Ανάκληση απόφασης")).otherwise(F.lit("Έγκριση δαπάνης"))
    text = q('{"ada":"', c("ada"), '","organizationId":"', c("entity"), '","decisionTypeId":"', by_value(prio(), ACT_TYPE), '","status":"', by_value(c("o_orderstatus"), ACT_STATUS),
             '","issueDate":', athens_ms(c("date")).cast("string"), ',"subject":"', subject, '","signerIds":', F.when(prio() == "1-URGENT", F.lit("null")).when(prio() == "2-HIGH", F.lit('["7","3"]')).otherwise(F.lit('"5"')),
             ',"extraFieldValues":{"sponsor":', polymorphic(sponsor), ',"amountWithKae":', polymorphic(kae_line), ',"person":', polymorphic(person),
             ',"amountWithVAT":', F.to_json(F.struct(c("price").alias("amount"), F.lit("EUR").alias("currency"))), ',"awardAmount":', F.to_json(F.struct(c("price").alias("amount"))),
             ',"recalledExpenseDecision":', F.when(c("c_mktsegment") == "BUILDING", F.lit("true")).otherwise(F.lit("null")),
             ',"relatedDecisions":', F.to_json(F.struct(key("o_custkey").alias("relatedDecisionsADA"))), ',"textRelatedADA":"', key("o_orderkey"), '"}}')
    return b.decisions.select(q("/acts/", c("entity"), "/", c("ada"), ".json").alias("path"), F.encode(text, "UTF-8").alias("content"))


def acts(b):
    return docs.scan_documents(raw_acts(b))


ACT_ROW = """SELECT ada, entity, CASE o_orderpriority {types} END AS type, date, year, CASE o_orderstatus WHEN 'F' THEN 'PUBLISHED' WHEN 'P' THEN 'REVOKED' ELSE 'PENDING_REVOCATION' END AS status, *
    EXCLUDE (ada, entity, date, year) FROM decisions""".replace("{types}", " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ACT_TYPE.items()))
DOCS = {"act_doc": ACT_ROW, "items": f"SELECT *, unnest(generate_series(0, greatest({N_ITEMS}, 1) - 1)) AS i, {N_ITEMS} AS n_items FROM act_doc WHERE status <> 'PENDING_REVOCATION'"}
SIGNERS = "CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN '7|3' ELSE '5' END"


@query("src01_scan_documents", "SELECT '/acts/' || entity || '/' || ada || '.json' AS path, ada, true AS hashed FROM decisions")
def _(b):
    return acts(b).select("path", c("doc.ada").alias("ada"), (F.length("sha256") == 64).alias("hashed"))


@query("rg01_act_rows", pick("ada entity type date:d year:i status signer_ids source_path", f"(SELECT *, {SIGNERS} AS signer_ids, '/acts/' || entity || '/' || ada || '.json' AS source_path FROM act_doc)"), DOCS)
def _(b):
    return fl.act_rows(acts(b)).select("ada", "entity", "type", "date", "year", "status", "signer_ids", "source_path")


PAY = """(SELECT ada AS source_ada, entity, date, year, status AS act_status, CASE WHEN n_items = 0 THEN ada || ':payroll' ELSE ada || ':' || i END AS payment_id, i AS line_no,
    n_items = 0 AS is_payroll, CASE WHEN n_items = 0 THEN 'no_sponsor' END AS payroll_kind, CASE WHEN n_items = 0 THEN 'payroll' WHEN o_custkey + i = 7 THEN 'internal_transfer' ELSE 'supplier' END AS payee_class,
    CASE WHEN n_items > 0 THEN lpad(CAST(o_custkey + i AS VARCHAR), 9, '0') END AS counterparty_afm, CASE WHEN n_items > 0 THEN price + i END AS amount,
    n_items > 0 AND price + i > 400000 AS amount_suspect FROM items WHERE type = 'Β.2.2')"""


@query("rg02_payment_rows", pick("source_ada entity date:d year:i act_status payment_id line_no:i is_payroll payroll_kind payee_class counterparty_afm amount:m amount_suspect", PAY), DOCS)
def _(b):
    family = b.star.nation.filter(c("n_nationkey") == 7).select(F.lpad(c("n_nationkey").cast("string"), 9, "0").alias("afm"))
    rows = fl.payment_rows(fl.route_by_type(acts(b))["payment"], family, suspect_above=400_000)
    return rows.select("source_ada", "entity", "date", "year", "act_status", "payment_id", "line_no", "is_payroll", "payroll_kind", "payee_class", "counterparty_afm", "amount", "amount_suspect")


COMMIT = """(SELECT ada AS source_ada, year, CASE WHEN n_items = 0 THEN ada || ':act' ELSE ada || ':' || i END AS commitment_id, i AS line_no, n_items > 0 AS has_kae_lines,
    CASE WHEN n_items = 0 THEN price ELSE price - i END AS amount, price AS act_amount_total, o_orderstatus = 'P' OR c_mktsegment = 'BUILDING' AS is_reversal, CASE WHEN n_items > 0 THEN '61' END AS kae_major
    FROM items WHERE type = 'Β.1.3')"""


@query("rg03_commitment_rows", pick("source_ada year:i commitment_id line_no:i has_kae_lines amount:m act_amount_total:m is_reversal kae_major", COMMIT), DOCS)
def _(b):
    return fl.commitment_rows(fl.route_by_type(acts(b))["commitment"]).select("source_ada", "year", "commitment_id", "line_no", "has_kae_lines", "amount", "act_amount_total", "is_reversal", "kae_major")


@query("rg04_award_rows", pick("source_ada award_id award_type amount:m person_afm related", f"(SELECT ada AS source_ada, ada || ':' || i AS award_id, type AS award_type, price AS amount, CASE WHEN n_items > 0 THEN lpad(CAST(o_custkey + i AS VARCHAR), 9, '0') END AS person_afm, CASE WHEN o_custkey = o_orderkey THEN {sql_key('o_custkey')} ELSE array_to_string(list_sort([{sql_key('o_custkey')}, {sql_key('o_orderkey')}]), '|') END AS related FROM items WHERE type IN ('Δ.1', 'Δ.2.2'))"), DOCS)
def _(b):
    return fl.award_rows(fl.route_by_type(acts(b))["award"]).select("source_ada", "award_id", "award_type", "amount", "person_afm", F.array_join("related_ada", "|").alias("related"))


@query("rg05_route_by_type", """SELECT route, count(*) AS n FROM (SELECT CASE WHEN type IN ('Β.2.2', 'Β.1.3', 'Δ.1', 'Δ.2.2') THEN CASE WHEN status = 'PENDING_REVOCATION' THEN 'pending ' || type WHEN type = 'Β.2.2' THEN 'payment'
    WHEN type = 'Β.1.3' THEN 'commitment' ELSE 'award' END END AS route FROM act_doc) WHERE route IS NOT NULL GROUP BY 1""", DOCS)
def _(b):
    r = fl.route_by_type(acts(b))
    out = r["excluded_pending"].select(q("pending ", c("type")).alias("route"), "n")
    for name in ("payment", "commitment", "award"):
        out = out.unionByName(r[name].agg(F.count("*").alias("n")).select(F.lit(name).alias("route"), "n"))
    return out


# ---- procurement records ------------------------------------------------------------------------------------------
def raw_records(b):
    """(path, content) of one record per order; revoked orders' files are later captures."""
    ref = q("24", F.upper(F.substring("c_mktsegment", 1, 4)), F.lpad(c("o_orderkey").cast("string"), 9, "0"))
    other = (c("price") / 3).cast("decimal(18,2)")
    obj = lambda vat, name, net: F.struct(vat.alias("vatNo"), F.lit(True).alias("greekVatNo"), name.alias("name"), net.alias("costWithoutVAT"),
                                          F.array(F.struct(F.lit("45000000").alias("key"))).alias("cpvs"))
    one = obj(F.lit("094000001"), F.lit("ΕΤΑΙΡΕΙΑ ΑΕ"), c("price") - other)
    two = obj(F.lit("123456789"), F.lit("ΕΠΩΝΥΜΟ ΟΝΟΜΑ"), other)
    none = obj(F.lit(" "), F.lit("ΚΕΝΟ"), other)
    zero = F.when(c("c_mktsegment") == "FURNITURE", F.lit(0)).otherwise(F.lit(1)).cast("decimal(18,2)")
    flat = lambda o: o.withField("costWithoutVAT", (o["costWithoutVAT"] * zero).cast("decimal(18,2)"))
    text = q('{"referenceNumber":"', ref, '","organization":{"key":"', c("entity"), '"},"submissionDate":"', c("date").cast("string"), 'T10:00:00","title":"x","authorEmail":"a@b.gr","cancelled":',
             F.when(c("o_orderpriority") == "2-HIGH", F.lit("true")).otherwise(F.lit("null")), ',"totalCostWithVAT":', c("price").cast("string"),
             ',"procedureType":{"key":"1","value":"Απευθείας ανάθεση"},"contractTypes":[{"contractType":{"key":"2","value":"Προμήθειες"}}],"contractRefNo":', F.when(c("o_orderstatus") == "F", F.lit('["B ","A"]')).otherwise(F.lit('"A"')),
             ',"objectDetails":', F.to_json(F.array(flat(one), flat(two), flat(none), flat(two))),
             ',"contractingDataDetails":{"contractingMembersDataList":', F.to_json(F.array(F.struct(F.lit("123456789").alias("vatNumber"), F.lit(True).alias("greekVatNumber"), F.lit("ΕΠΩΝΥΜΟ ΟΝΟΜΑ").alias("name")))), "}}")
    name = F.when(c("o_orderstatus") == "P", q(ref, ".0123456789ab")).otherwise(ref)
    return b.decisions.select(q("/records/", by_value(prio(), ENDPOINT), "/", c("entity"), "/", name, ".json").alias("path"), F.encode(text, "UTF-8").alias("content"))


def records(b):
    return docs.scan_records_first_capture(raw_records(b))


REC = {"rec": f"""SELECT '24' || upper(substr(c_mktsegment, 1, 4)) || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS ref, CASE o_orderpriority {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in ENDPOINT.items())} END AS endpoint,
    *, CAST(CAST(price AS DOUBLE) / 3 AS DECIMAL(18,2)) AS other FROM decisions WHERE o_orderstatus <> 'P'"""}


@query("src02_records_first_capture", "SELECT ref, endpoint, entity AS org FROM rec", REC)
def _(b):
    return records(b).select(c("doc.referenceNumber").alias("ref"), "endpoint", "org")


@query("rg06_procurement_rows", pick("ref endpoint entity submission_date:d cancelled record_type procedure_type contract_type contract_refs cpv total_cost_with_vat:m", """(SELECT *, date AS submission_date, o_orderpriority = '2-HIGH' AS cancelled,
    upper(substr(c_mktsegment, 1, 4)) AS record_type, 'Απευθείας ανάθεση' AS procedure_type, 'Προμήθειες' AS contract_type, CASE WHEN endpoint = 'contract' THEN ref WHEN o_orderstatus = 'F' THEN 'A|B' ELSE 'A' END AS contract_refs,
    '45000000' AS cpv, price AS total_cost_with_vat FROM rec)"""), REC)
def _(b):
    return fl.procurement_rows(records(b)).select("ref", "endpoint", "entity", "submission_date", "cancelled", "record_type", "procedure_type", "contract_type", "contract_refs", "cpv", "total_cost_with_vat")


@query("rg07_contractor_rows", "SELECT ref, entity, 'contractor' AS role, '123456789' AS afm, true AS is_natural_person, 'φυσικό πρόσωπο' AS display_name FROM rec WHERE endpoint IN ('auction', 'contract')", REC)
def _(b):
    return fl.contractor_rows(records(b)).select("ref", "entity", "role", "afm", "is_natural_person", "display_name")


# half-even to the cent in integers: num / den of a cent
HALF_EVEN = "CAST((num // den + CASE WHEN 2 * (num % den) > den OR (2 * (num % den) = den AND (num // den) % 2 = 1) THEN 1 ELSE 0 END) AS DOUBLE) / 100"


@query("rg08_split_by_share", f"""SELECT ref, afm, display_name, {HALF_EVEN} AS amount_with_vat FROM (SELECT ref, afm, display_name,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN g ELSE g * CASE WHEN afm = '094000001' THEN g - o ELSE 2 * o END END AS num, CASE WHEN c_mktsegment = 'FURNITURE' THEN 2 ELSE g + o END AS den
    FROM (SELECT *, CAST(price * 100 AS HUGEINT) AS g, CAST(other * 100 AS HUGEINT) AS o, unnest(['094000001', '123456789']) AS afm, unnest(['ΕΤΑΙΡΕΙΑ ΑΕ', 'φυσικό πρόσωπο']) AS display_name FROM rec WHERE endpoint = 'payment'))""", REC)
def _(b):
    return fl.payee_rows(records(b)).select("ref", "afm", "display_name", "amount_with_vat")


@query("rg09_terms", "SELECT ada, unnest(found_by) AS term FROM grant_decision")
def _(b):
    return fl.explode_terms(b.grant_decision, "ada", "found_by", "term")


@query("rg10_entity_rows", "SELECT uid, name, afm, sha256('registry') AS source_sha256 FROM entity")
def _(b):
    return fl.entity_rows(b.entity, "registry", F.sha2(F.lit("registry"), 256)).select("uid", "name", "afm", "source_sha256")


@query("rg11_stamp_lineage", "SELECT ada, '2026-01-01 00:00:00' AS derived_at, '1+x' AS pipeline_version FROM act")
def _(b):
    return ld.stamp_lineage(b.act, F.lit("2026-01-01 00:00:00").cast("timestamp"), "1+x").select("ada", "derived_at", "pipeline_version")


# ---- search pages --------------------------------------------------------------------------------------------------
TERMS = {"1-URGENT": "ΝΗΣΙΔΟΣ", "2-HIGH": "58000", "3-MEDIUM": "999000111", "4-NOT SPECIFIED": "ΝΗΣΙ", "5-LOW": "58000"}


def record(ada: Column, issuer: Column, redacted: Column, day: Column | None = None, co: Column | None = None) -> Column:
    return F.struct(ada.alias("ada"), F.date_format(day if day is not None else c("date"), "dd/MM/yyyy' 02:00:00'").alias("issueDate"), F.lit("PUBLISHED").alias("status"), q("Απόδοση ", c("ada")).alias("subject"),
                    F.struct(issuer.alias("uid"), F.lit("label").alias("label")).alias("organization"), redacted.alias("redacted"),
                    F.array(F.struct((co if co is not None else F.lit("0")).alias("uid"))).alias("cooperatingOrganizations"))


def search_page_files(b):
    """One stored page per order: its own decision, the customer's, and one that depends on the
    priority: of another issuer, outside the window, repeated, or with an unusable key."""
    own, cust = key("o_orderkey"), key("o_custkey")
    third = key("c_nationkey")
    ent = c("entity")
    extra = (F.when(prio() == "2-HIGH", record(third, F.lit("X"), F.lit(None).cast("boolean"), co=F.when(c("o_orderstatus") == "P", ent).otherwise(F.lit("Y"))))
             .when(prio() == "3-MEDIUM", record(third, ent, F.lit(None).cast("boolean"), F.date_add("date", 40))).when(prio() == "4-NOT SPECIFIED", record(own, ent, F.lit(None).cast("boolean")))
             .when(prio() == "5-LOW", record(F.lit("abc"), ent, F.lit(None).cast("boolean"))).otherwise(record(third, ent, F.lit(None).cast("boolean"))))
    recs = F.array(record(own, ent, F.lit(None).cast("boolean")), record(F.concat(cust, F.lit("Γ")), ent, c("o_orderstatus") == "F"), extra)
    marks = F.when(c("o_orderstatus") == "P", F.map_from_arrays(F.array(own), F.array(F.struct(F.array(F.lit("x")).alias("documentText"))))).otherwise(F.map_from_arrays(F.array(F.when(prio() == "4-NOT SPECIFIED", F.lit("9-Ω")).otherwise(own)), F.array(F.struct(F.array().cast("array<string>").alias("documentText")))))
    info = F.struct(F.when(prio() == "5-LOW", F.lit("q")).alias("query"), F.lit(0).alias("page"), F.when(prio() == "3-MEDIUM", F.lit(7)).otherwise(F.lit(500)).alias("size"), F.lit(3).alias("actualSize"), F.lit(3).alias("total"))
    body = F.to_json(F.struct(recs.alias("decisions"), marks.alias("highlighting"), info.alias("info")))
    return b.decisions.select(q("/search/", ent, "/", by_value(prio(), TERMS), "/", c("ada"), ".json").alias("path"), F.encode(body, "UTF-8").alias("content"), c("ada").alias("page_key"),
                              ent.alias("org"), F.date_add("date", -3).alias("date_from"), F.date_add("date", 3).alias("date_to"))


def pages(b):
    return docs.search_pages(search_page_files(b))


TERM = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TERMS.items()) + " END"
HITS = {"hits": f"""SELECT DISTINCT ada_key AS ada, {TERM} AS term, entity AS issuer FROM (
    SELECT {sql_key('o_orderkey')} AS ada_key, * FROM decisions UNION ALL SELECT {sql_key('o_custkey')} || 'Γ', * FROM decisions WHERE o_orderstatus <> 'F'
    UNION ALL SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {sql_key('o_orderkey')} WHEN o_orderpriority = '5-LOW' THEN 'abc' ELSE {sql_key('c_nationkey')} END, * FROM decisions)""",
    "marked": f"""SELECT DISTINCT {sql_key('o_orderkey')} AS ada FROM decisions WHERE o_orderstatus = 'P'"""}


@query("src04_search_page_index", """SELECT coalesce(h.ada, m.ada) AS ada, array_to_string(list_sort(list(DISTINCT term)), '|') AS terms, array_to_string(list_sort(list(DISTINCT issuer)), '|') AS issuers, m.ada IS NOT NULL AS text_indexed
    FROM hits h FULL JOIN marked m ON m.ada = h.ada GROUP BY h.ada, m.ada""", HITS)
def _(b):
    return docs.search_page_index(pages(b))


@query("qg06_check_search_page", """SELECT ada AS page_key, CASE o_orderpriority WHEN '2-HIGH' THEN CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'issuer' END WHEN '3-MEDIUM' THEN 'size|outside_window'
    WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderstatus = 'P' THEN 'repeated_key' ELSE 'repeated_key|stray_highlight' END WHEN '5-LOW' THEN 'echo_appeared|unusable_key' ELSE '' END AS problems FROM decisions""")
def _(b):
    pg = search_page_files(b).withColumn("doc", F.from_json(F.decode("content", "UTF-8"), docs.SEARCH_PAGE_SCHEMA)).withColumns({"page": F.lit(0), "size": F.lit(500)})
    return g.check_search_page(pg).select("page_key", "problems")


@query("qg13_redact_page_records", """SELECT ada AS page_key, CAST(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 2 END AS BIGINT) AS cut, CAST(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 2 ELSE 1 END AS BIGINT) AS with_subject,
    CAST(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus <> 'P' THEN 0 ELSE 1 END AS BIGINT) AS marks, CAST(3 AS BIGINT) AS n FROM decisions""")
def _(b):
    pg = search_page_files(b).withColumn("doc", F.from_json(F.decode("content", "UTF-8"), docs.SEARCH_PAGE_SCHEMA))
    own = F.array(F.element_at("doc.decisions", 1)["ada"])
    r = g.redact_page_records(pg.withColumn("keep", own), "doc", "keep")
    count = lambda f: F.size(F.filter("doc.decisions", f))
    kept = F.array_contains(F.col("keep"), F.lit("x"))  # noqa: F841
    return r.select("page_key", count(lambda x: ~F.array_contains(F.col("keep"), x["ada"]) & x["redacted"]).alias("cut"), count(lambda x: x["subject"].isNotNull()).alias("with_subject"),
                    F.size("doc.highlighting").alias("marks"), F.size("doc.decisions").alias("n"))


# ---- procurement pages ----------------------------------------------------------------------------------------------------
@query("qg05_check_page_records", """SELECT ada AS page_key, CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN 'no_reference' WHEN '3-MEDIUM' THEN 'organisation' WHEN '4-NOT SPECIFIED' THEN 'outside_window' ELSE 'page' END AS problems FROM decisions""")
def _(b):
    rec = lambda ref, org, day: F.struct(ref.alias("referenceNumber"), F.struct(org.alias("key")).alias("organization"), F.concat(day.cast("string"), F.lit("T08:00:00")).alias("submissionDate"))
    second = rec(F.when(prio() != "2-HIGH", c("ada")), F.when(prio() == "3-MEDIUM", F.lit("X")).otherwise(c("entity")), F.when(prio() == "4-NOT SPECIFIED", F.date_add("date", 9)).otherwise(c("date")))
    body = F.to_json(F.struct(F.array(rec(c("ada"), c("entity"), c("date")), second).alias("content"), F.lit(2).alias("totalElements"), F.lit(1).alias("totalPages"), F.when(prio() == "5-LOW", F.lit(4)).otherwise(F.lit(0)).alias("number")))
    pg = b.decisions.select(c("ada").alias("page_key"), F.from_json(body, docs.RECORD_PAGE_SCHEMA).alias("doc"), c("entity").alias("org"), F.date_add("date", -3).alias("date_from"), F.date_add("date", 3).alias("date_to"), F.lit(0).alias("page"))
    return g.check_page_records(pg).select("page_key", "problems")


@query("qg04_check_echo", """SELECT ada, CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN 'org' WHEN '3-MEDIUM' THEN 'issue_to' WHEN '4-NOT SPECIFIED' THEN 'status|page' ELSE 'no_echo' END AS problems FROM decisions""")
def _(b):
    to = F.date_add("date", 30)
    text = q('organizationUid:"', F.when(prio() == "2-HIGH", F.lit("0000")).otherwise(c("entity")), '" AND issueDate:[DT(', c("date").cast("string"), "T00:00:00) TO DT(", F.when(prio() == "3-MEDIUM", F.date_add("date", 29)).otherwise(to).cast("string"), "T00:00:00)]",
             F.when(prio() == "4-NOT SPECIFIED", F.lit("")).otherwise(F.lit(' AND status:"Αναρτημένη"')))
    req = b.decisions.select("ada", F.when(prio() != "5-LOW", text).alias("query"), c("entity").alias("org"), c("date").alias("date_from"), to.alias("date_to"), F.lit(False).alias("status_all"), F.lit(1).alias("page"),
                             F.when(prio() == "4-NOT SPECIFIED", F.lit(2)).otherwise(F.lit(1)).alias("returned_page"))
    return g.check_echo(req).select("ada", "problems")


# ---- windows ---------------------------------------------------------------------------------------------------------------
def spans(b):
    return b.decisions.groupBy("entity").agg(F.min("date").alias("start"), F.max("date").alias("end"))


SPANS = {"spans": "SELECT entity, min(date) AS a, max(date) AS z FROM decisions GROUP BY 1"}


@query("qg01_windows_halfopen", pick("entity window_from:d window_to:d", "(SELECT entity, CAST(d AS DATE) AS window_from, least(CAST(d AS DATE) + 150, z + 1) AS window_to FROM (SELECT *, unnest(generate_series(a, z, INTERVAL 150 DAY)) AS d FROM spans))"), SPANS)
def _(b):
    return g.plan_windows_halfopen(spans(b), "start", "end", 150, 180).select("entity", "window_from", "window_to")


@query("qg02_windows_inclusive", pick("entity window_from:d window_to:d", "(SELECT entity, CAST(d AS DATE) AS window_from, least(CAST(d AS DATE) + 150, z) AS window_to FROM (SELECT *, unnest(generate_series(a, z, INTERVAL 151 DAY)) AS d FROM spans))"), SPANS)
def _(b):
    return g.plan_windows_inclusive(spans(b), "start", "end", 150, 180).select("entity", "window_from", "window_to")


@query("qg03_year_halves", pick("entity year:i window_from:d window_to:d", """(SELECT entity, y AS year, greatest(a, make_date(y, h, 1)) AS window_from, least(z, CASE h WHEN 1 THEN make_date(y, 6, 30) ELSE make_date(y, 12, 31) END) AS window_to
    FROM (SELECT *, unnest(generate_series(year(a), year(z))) AS y FROM spans) CROSS JOIN (VALUES (1), (7)) t(h)
    WHERE greatest(a, make_date(y, h, 1)) <= least(z, CASE h WHEN 1 THEN make_date(y, 6, 30) ELSE make_date(y, 12, 31) END))"""), SPANS)
def _(b):
    return g.plan_year_halves(spans(b), "start", "end").select("entity", "year", "window_from", "window_to")


# ---- counts over landed pages (events: window = day, organisation = event type) -----------------------------------------------
def landed(b):
    return b.star.events.select(c("ts").cast("date").alias("day"), c("event_type").alias("org"), c("user_id").alias("key"), "event_id", "value", "ts")


EVENTS = {"ev": "SELECT CAST(ts AS DATE) AS day, event_type AS org, user_id AS key, event_id, value, ts FROM events"}


@query("qg07_check_paging", """SELECT strftime(day, '%Y-%m-%d') AS day, org, CAST(max(total) AS BIGINT) AS total, count(DISTINCT key) AS n_keys, count(DISTINCT total) = 1 AS total_held, count(DISTINCT key) = max(total) AS complete
    FROM (SELECT *, count(*) OVER (PARTITION BY day, org) - CASE WHEN value > 400 THEN 1 ELSE 0 END AS total FROM ev) GROUP BY 1, 2""", EVENTS)
def _(b):
    e = landed(b)
    totals = e.groupBy("day", "org").agg(F.count("*").alias("t"))
    rows = e.join(totals, ["day", "org"]).withColumn("total", c("t") - F.when(c("value") > 400, 1).otherwise(0))
    return g.check_paging(rows.select("day", "org", "key", "total"), ["day", "org"])


@query("qg08_check_control", """SELECT strftime(a.day, '%Y-%m-%d') AS day, a.org AS term, a.n AS total, k.n AS control_total, a.n <> k.n OR (a.n = 0 AND k.n = 0) AS accepted
    FROM (SELECT day, org, count(*) AS n FROM ev GROUP BY 1, 2) a JOIN (SELECT day, count(*) AS n FROM ev WHERE org = 'view' GROUP BY 1) k USING (day) WHERE a.org <> 'view'""", EVENTS)
def _(b):
    counts = landed(b).groupBy("day", c("org").alias("term")).agg(F.count("*").alias("total"))
    return g.check_control_count(counts, ["day"], "view").select("day", "term", "total", "control_total", "accepted")


@query("qg09_check_rollup", """SELECT org, w.n AS total, x.n AS window_total, w.n = x.n AS accepted FROM (SELECT org, count(*) AS n FROM ev GROUP BY 1) w JOIN (SELECT org, count(*) AS n FROM ev WHERE NOT (org = 'error' AND value > 100) GROUP BY 1) x USING (org)""", EVENTS)
def _(b):
    e = landed(b)
    whole = e.groupBy("org").agg(F.count("*").alias("total"))
    windows = e.filter(~((c("org") == "error") & (c("value") > 100))).groupBy("org", "day").agg(F.count("*").alias("total"))
    return g.check_rollup_counts(whole, windows, ["org"]).select("org", "total", "window_total", "accepted")


FATES = {**EVENTS, "fates": """SELECT *, CASE WHEN k IS NULL THEN 'no_key' WHEN row_number() OVER (PARTITION BY k ORDER BY day, event_id) = 1 THEN 'first' ELSE 'dup' END AS fate
    FROM (SELECT *, CASE WHEN value > 5 THEN key END AS k FROM ev)"""}


@query("qg10_dedupe_seams", "SELECT strftime(day, '%Y-%m-%d') AS day, fate, count(*) AS n FROM fates GROUP BY 1, 2", FATES)
def _(b):
    e = landed(b).withColumn("k", F.when(c("value") > 5, c("key")))
    return g.dedupe_seams(e, "k", ["day", "event_id"]).groupBy("day", "fate").agg(F.count("*").alias("n"))


@query("qg11_window_tallies", """SELECT strftime(day, '%Y-%m-%d') AS day, org AS status, count(*) FILTER (value < 1) AS n_new, count(*) FILTER (value >= 1 AND value < 5) AS n_changed, count(*) FILTER (value >= 5 AND value < 50) AS n_unchanged,
    count(*) FILTER (value >= 50) AS n_dup, count(*) AS n FROM ev GROUP BY 1, 2""", EVENTS)
def _(b):
    outcome = F.when(c("value") < 1, F.lit("new")).when(c("value") < 5, F.lit("changed")).when(c("value") < 50, F.lit("unchanged")).otherwise(F.lit("dup"))
    return g.window_tallies(landed(b).select("day", c("org").alias("status"), outcome.alias("outcome")), ["day"])


@query("qg12_valid_key", rf"""SELECT id, regexp_full_match(id, '[0-9Α-Ω]+-[0-9Α-Ω]+') AS decision, regexp_full_match(id, '\d+') AS organisation, regexp_full_match(id, '[0-9A-Z]{{6,40}}') AS procurement, regexp_full_match(id, '[0-9Α-ΩA-Z]{{2,40}}') AS term
    FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN {sql_key('o_orderkey')} WHEN '2-HIGH' THEN CAST(o_orderkey AS VARCHAR) WHEN '3-MEDIUM' THEN '24SYMV' || o_orderkey WHEN '4-NOT SPECIFIED' THEN '../' || o_orderkey ELSE 'ΝΗΣΟΣ' || chr(10) || o_orderkey END AS id FROM orders)""")
def _(b):
    o = c("o_orderkey").cast("string")
    ident = (F.when(prio() == "1-URGENT", key("o_orderkey")).when(prio() == "2-HIGH", o).when(prio() == "3-MEDIUM", q("24SYMV", o)).when(prio() == "4-NOT SPECIFIED", q("../", o)).otherwise(q("ΝΗΣΟΣ\n", o)))
    return b.star.orders.select(ident.alias("id")).select("id", *[valid_key(c("id"), k).alias(k) for k in fv.KEY_SHAPES])


PURGE = {**EVENTS, "personal": "SELECT DISTINCT key FROM ev WHERE value > 300", "caps": "SELECT event_id AS page_id, org || '/' || CAST(key AS VARCHAR) AS slot, key, value FROM ev",
         "doomed": "SELECT page_id, slot FROM caps WHERE value > 20 AND key IN (SELECT key FROM personal)",
        "stuck": "SELECT slot FROM caps GROUP BY slot HAVING count(*) = count(*) FILTER (page_id IN (SELECT page_id FROM doomed))",
        "waits": "SELECT page_id FROM doomed WHERE slot IN (SELECT slot FROM stuck)"}


def purge(b):
    e = landed(b)
    caps = e.select(c("event_id").alias("page_id"), F.concat_ws("/", "org", c("key").cast("string")).alias("slot"))
    holds = e.filter(c("value") > 20).select(c("event_id").alias("page_id"), c("key").alias("ada"))
    return g.purge_plan(e.filter(c("value") > 300).select(c("key").alias("ada")), caps, holds)


@query("qg14_purge_plan", """SELECT 'page' AS what, CAST(page_id AS VARCHAR) AS id FROM doomed WHERE page_id NOT IN (SELECT page_id FROM waits) UNION ALL SELECT 'blocked', slot FROM stuck
    UNION ALL SELECT 'record', CAST(key AS VARCHAR) FROM personal WHERE key NOT IN (SELECT key FROM caps WHERE value > 20 AND page_id IN (SELECT page_id FROM waits))""", PURGE)
def _(b):
    plan = purge(b)
    return (plan["pages"].select(F.lit("page").alias("what"), c("page_id").cast("string").alias("id"))
            .unionByName(plan["records"].select(F.lit("record").alias("what"), c("ada").cast("string").alias("id")))
            .unionByName(plan["blocked"].select(F.lit("blocked").alias("what"), c("slot").alias("id"))))


@query("qg15_landing_status", "SELECT entity, CAST(year AS BIGINT) AS year, status, count(*) AS n_files, count(DISTINCT o_custkey) AS n_keys FROM act_doc GROUP BY 1, 2, 3", DOCS)
def _(b):
    files = b.decisions.select("entity", "year", by_value(c("o_orderstatus"), ACT_STATUS).alias("status"), "o_custkey")
    return g.landing_status(files, ["entity", "year", "status"], "o_custkey")


@query("qg15_last_record", "SELECT count(DISTINCT key) AS n_runs, count(*) AS n_records, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts, arg_max(org, (ts, org)) AS last_org FROM ev", EVENTS)
def _(b):
    e = landed(b).select(c("key").cast("string").alias("run"), "ts", "org", F.lit("ok").alias("status"))
    return g.last_record(e).drop("last_status")


COVER = "(SELECT entity AS issuer, year, d.doc_id IS NOT NULL AS has, ada FROM decisions LEFT JOIN documents d ON d.doc_id = o_custkey)"


def coverage(b):
    dec = b.decisions.select(c("o_custkey").alias("ada"), c("entity").alias("issuer"), "year", c("ada").alias("own"))
    return g.document_coverage(dec, b.star.documents.select(c("doc_id").alias("ada")))


@query("qg16_document_coverage", f"SELECT issuer, CAST(year AS BIGINT) AS year, count(*) AS n_kept, count(*) FILTER (has) AS n_with_document FROM {COVER} GROUP BY 1, 2")
def _(b):
    return coverage(b)[0]


@query("qg16_missing_documents", f"SELECT issuer, ada FROM {COVER} WHERE NOT has")
def _(b):
    return coverage(b)[1].select("issuer", c("own").alias("ada"))


@query("qg17_registry_drift", """SELECT CAST(c_custkey AS VARCHAR) AS uid, CASE WHEN s_suppkey IS NULL THEN 'missing' ELSE array_to_string(list_filter([CASE WHEN c_nationkey <> s_nationkey THEN 'parent' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'category' END], lambda x: x IS NOT NULL), '|') END AS drift
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey WHERE s_suppkey IS NULL OR c_nationkey <> s_nationkey OR c_mktsegment = 'BUILDING'""")
def _(b):
    reg = b.star.customer.select(c("c_custkey").cast("string").alias("uid"), F.lit(None).cast("string").alias("afm"), c("c_nationkey").alias("parent"), F.when(c("c_mktsegment") == "BUILDING", F.lit("b")).alias("category"), F.lit(None).cast("string").alias("name"))
    src = b.star.supplier.select(c("s_suppkey").cast("string").alias("uid"), F.lit("1").alias("afm"), c("s_nationkey").alias("parent"), F.lit("a").alias("category"), c("s_name").alias("name"))
    return g.registry_drift(reg, src)


@query("qg18_scope_guard", """SELECT CAST(c_custkey AS VARCHAR) AS uid, CASE WHEN s_suppkey IS NULL THEN 'unknown' WHEN s_nationkey >= 12 THEN 'out_of_scope' ELSE 'ok' END AS fate FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def _(b):
    req = b.star.customer.select(c("c_custkey").cast("string").alias("uid"))
    reg = b.star.supplier.select(c("s_suppkey").cast("string").alias("uid"), (c("s_nationkey") < 12).alias("in_scope"))
    ok, refused = g.scope_guard(req, reg)
    return ok.select("uid", F.lit("ok").alias("fate")).unionByName(refused.select("uid", c("refused").alias("fate")))


# ---- landing ------------------------------------------------------------------------------------------------------------------------
VERSIONS = {**EVENTS, "inc": "SELECT CAST(key AS VARCHAR) AS key, sha256(org) AS digest, event_id AS seq FROM ev", "held": "SELECT DISTINCT CAST(key AS VARCHAR) AS key, sha256(org) AS digest FROM ev WHERE value > 250"}


def versions(b):
    e = landed(b)
    inc = e.select(c("key").cast("string").alias("key"), F.sha2("org", 256).alias("digest"), c("event_id").alias("seq"))
    held = e.filter(c("value") > 250).select(c("key").cast("string").alias("key"), F.sha2("org", 256).alias("digest")).distinct()
    return inc, held


OUTCOME = """SELECT key, seq, CASE WHEN (key, digest) IN (SELECT (key, digest) FROM held) OR seq > min(seq) OVER (PARTITION BY key, digest) THEN 'unchanged'
    WHEN key NOT IN (SELECT key FROM held) AND seq = min(seq) OVER (PARTITION BY key) THEN 'new' ELSE 'changed' END AS outcome FROM inc"""


@query("src07_land_versioned", OUTCOME, VERSIONS)
def _(b):
    return ld.version_outcomes(*versions(b)).select("key", "seq", "outcome")


@query("src08_land_content_addressed", """SELECT sha256(body) AS digest, min(event_id) AS seq FROM (SELECT event_id, value, '{"kind":"' || org || '","user":' || key || '}' AS body FROM ev)
    GROUP BY 1 HAVING sha256(body) NOT IN (SELECT sha256('{"kind":"' || org || '","user":' || key || '}') FROM ev WHERE value > 250)""", EVENTS)
def _(b):
    body = F.struct(c("org").alias("kind"), c("key").alias("user"), c("ts").cast("string").alias("echo"))
    e = landed(b).select(c("event_id").alias("seq"), body.alias("body"), "value")
    held = e.filter(c("value") > 250).select(ld.content_digest(c("body"), ["echo"]).alias("digest")).distinct()
    return ld.land_content_addressed(e.drop("value"), held, "body", ["echo"]).select("digest", "seq")


@query("src09_first_capture", """SELECT key, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS captured_at, arg_min(org, (ts, sha256(org))) AS org FROM ev WHERE key IN (SELECT s_suppkey FROM supplier) GROUP BY 1""", EVENTS)
def _(b):
    held = landed(b).select("key", c("ts").alias("captured_at"), "org", F.sha2("org", 256).alias("digest"))
    return ld.find_by_key(held, b.star.supplier.select(c("s_suppkey").alias("key"))).select("key", "captured_at", "org")


@query("src10_canonical_digest", """SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}') AS digest FROM orders""")
def _(b):
    return b.star.orders.select("o_orderkey", canonical_digest("o_orderkey", "o_custkey", "o_orderpriority").alias("digest"))


ROWS = """SELECT 'act' AS "table", count(*) AS n FROM act UNION ALL SELECT 'payment', count(*) FROM payment UNION ALL SELECT 'commitment', count(*) FROM commitment UNION ALL SELECT 'award', count(*) FROM award
    UNION ALL SELECT 'counterparty', count(DISTINCT counterparty_afm) FROM payment WHERE NOT is_payroll UNION ALL SELECT 'entity', count(*) FROM entity UNION ALL SELECT 'budget_line', count(*) FROM budget_line
    UNION ALL SELECT 'procurement', count(*) FROM procurement UNION ALL SELECT 'procurement_party', count(*) FROM procurement_party UNION ALL SELECT 'grant_decision', count(*) FROM grant_decision
    UNION ALL SELECT 'grant_line', count(*) FROM grant_line UNION ALL SELECT 'acceptance', count(*) FROM acceptance"""


VIEW_ROWS = " UNION ALL ".join(f"SELECT '{v}', count(*) FROM {'act' if v == 'v_act' else v}" for v in NUMBERED)


@query("src13_register_release", f"{ROWS} UNION ALL {VIEW_ROWS}", VIEWS)
def _(b):
    return ld.register_release(b.spark, ld.stored_release(b.stored().release, ["budget_line"]), prefix="bound_")


SETTINGS = {"payment_amount_suspect_above": fv.SUSPECT_ABOVE, "nearby_days": fv.NEARBY_DAYS, "dates": fv.CIVIL_ZONE, "counterparty_resolution": "exact id"}
COUNTED = ("v_yearly", "v_budget_month", "v_payment_combined")
SOURCE_LANES = " || ':' || ".join(f"CAST(sum(CAST('0x' || substr(sha256(ada), {8 * i + 1}, 8) AS BIGINT)) AS VARCHAR)" for i in range(8))


@query("src14_build_manifest", f"""SELECT 'rows' AS metric, "table" AS key, CAST(n AS VARCHAR) AS value FROM ({ROWS}) UNION ALL SELECT 'payment.payee_class' AS metric, payee_class AS key, CAST(count(*) AS VARCHAR) AS value FROM payment GROUP BY 2 UNION ALL SELECT 'payment.payroll_kind', coalesce(payroll_kind, 'none'), CAST(count(*) AS VARCHAR) FROM payment GROUP BY 2
    UNION ALL SELECT 'grant_line.validation', coalesce(validation, 'none'), CAST(count(*) AS VARCHAR) FROM grant_line GROUP BY 2 UNION ALL SELECT 'grant_decision.read_status', read_status, CAST(count(*) AS VARCHAR) FROM grant_decision GROUP BY 2
    UNION ALL SELECT 'procurement.endpoint', endpoint, CAST(count(*) AS VARCHAR) FROM procurement GROUP BY 2 UNION ALL SELECT 'procurement_party.role', role, CAST(count(*) AS VARCHAR) FROM procurement_party GROUP BY 2
    UNION ALL SELECT 'excluded_pending', type, CAST(count(*) AS VARCHAR) FROM act WHERE status = 'PENDING_REVOCATION' AND type <> 'Β.3' GROUP BY 2
    UNION ALL SELECT 'sources', 'count', CAST(count(*) AS VARCHAR) FROM decisions UNION ALL SELECT 'sources', 'digest', sha256(CAST(count(DISTINCT ada) AS VARCHAR) || ':' || {SOURCE_LANES}) FROM decisions
    UNION ALL SELECT 'refused', CASE WHEN o_orderstatus = 'F' THEN 'unknown month' ELSE 'spending does not add up' END, CAST(count(*) AS VARCHAR) FROM decisions WHERE o_orderpriority = '5-LOW' GROUP BY 2
    UNION ALL SELECT 'setting', k, v FROM (VALUES {', '.join(f"('{k}', '{v}')" for k, v in SETTINGS.items())}) t(k, v)
    {' '.join(f"UNION ALL SELECT 'view_rows', '{v}', CAST(count(*) AS VARCHAR) FROM {v}" for v in COUNTED)}""", VIEWS)
def _(b):
    b = b.stored()
    pending = b.act.filter((c("status") == "PENDING_REVOCATION") & (c("type") != "Β.3")).groupBy("type").agg(F.count("*").alias("n"))
    refused = b.decisions.filter(prio() == "5-LOW").select(c("ada").alias("doc_id"), F.when(c("o_orderstatus") == "F", F.lit("unknown month")).otherwise(F.lit("spending does not add up")).alias("reason"))
    return ld.build_manifest(ld.stored_release(b.release, ["budget_line"]), pending, b.decisions.select(F.sha2("ada", 256).alias("sha256")), refused, SETTINGS, COUNTED)


@query("src03_decisions_first_capture", "SELECT ada, entity AS issuer, 'Απόδοση ' || ada AS subject, true AS hashed FROM decisions WHERE o_orderstatus <> 'P'")
def _(b):
    """A kept decision per order; the revoked orders' files are later captures."""
    text = F.to_json(record(c("ada"), c("entity"), F.lit(None).cast("boolean")))
    name = F.when(c("o_orderstatus") == "P", q(c("ada"), ".0123456789ab")).otherwise(c("ada"))
    files = b.decisions.select(q("/decisions/", c("entity"), "/", name, ".json").alias("path"), F.encode(text, "UTF-8").alias("content"))
    return docs.scan_decisions_first_capture(files).select(c("doc.ada").alias("ada"), "issuer", c("doc.subject").alias("subject"), (F.length("sha256") == 64).alias("hashed"))


@query("src05_load_registry", """SELECT d.entity AS uid, n_name AS name, n_regionkey < 3 AS in_scope, CASE WHEN n_regionkey < 3 THEN lpad(CAST(n_nationkey AS VARCHAR), 9, '0') END AS term, CASE WHEN n_regionkey = 4 THEN 'g4' END AS grantor_group,
    CASE WHEN n_regionkey = 4 THEN '%s' END AS keep, count(*) AS n FROM decisions d JOIN nation ON CAST(n_nationkey AS VARCHAR) = d.entity GROUP BY ALL""" % fv.KEEP_RULES[0])
def _(b):
    """The nations as the hand-kept registry of bodies, grantors and anchors, against the acts posted by them."""
    rows = b.star.nation.collect()  # 25 bodies: a registry is a list we keep ourselves
    body = lambda r: {"uid": r["n_nationkey"], "name": r["n_name"], "afm": f"{r['n_nationkey']:09d}"}
    doc = {"in_scope": [body(r) for r in rows if r["n_regionkey"] < 3], "out_of_scope": [body(r) | {"reason": "far"} for r in rows if r["n_regionkey"] >= 3],
           "grantors": [{"uid": r["n_nationkey"], "name": r["n_name"], "keep": list(fv.KEEP_RULES[:1]), "group": "g4"} for r in rows if r["n_regionkey"] == 4]}
    reg = registry.registry(b.spark, doc)
    acts = b.decisions.groupBy(c("entity").alias("uid")).agg(F.count("*").alias("n"))
    grantors = reg["grantor"].select("uid", "grantor_group", F.array_join("keep", "|").alias("keep"))
    return acts.join(reg["entity"].select("uid", "name", "in_scope"), "uid").join(reg["anchor"], "uid", "left").join(grantors, "uid", "left").select("uid", "name", "in_scope", "term", "grantor_group", "keep", "n")


@query("src06_load_corrections", """SELECT ada, CAST(CASE WHEN n.k % 3 = 0 THEN n.k + 0.25 END AS DOUBLE) AS corr_amount, CASE WHEN n.k % 3 <> 2 THEN '6' || n.k END AS corr_kae, CASE WHEN n.k % 2 = 0 THEN 'A1' END AS duplicate_of
    FROM decisions JOIN (SELECT n_nationkey AS k FROM nation) n ON ada = 'A' || (n.k * 10)""")
def _(b):
    """Corrections kept by hand, several for one document, against the acts they are about."""
    rows = [r["n_nationkey"] for r in b.star.nation.select("n_nationkey").collect()]  # a short list
    mismatch = [{"ada": f"A{k * 10}", "metadata_amount": 1, "kae": "0"} for k in rows] + [{"ada": f"A{k * 10}", "metadata_amount": f"{k}.25" if k % 3 == 0 else None, "kae": f"6{k}" if k % 3 != 2 else None} for k in rows]
    duplicate = [{"ada": f"A{k * 10}", "duplicate_of": x} for k in rows if k % 2 == 0 for x in ("A0", "A1")]
    fixed = registry.corrections(b.spark, {"mismatch": mismatch, "duplicate": duplicate})
    d = b.decisions.select("ada").join(fixed["mismatch"].withColumnRenamed("doc", "ada"), "ada").join(fixed["duplicate"].withColumnRenamed("doc", "ada"), "ada", "left")
    return d.select("ada", "corr_amount", "corr_kae", "duplicate_of")


@query("src11_audit_log", "SELECT entity, CAST(2 * count(*) AS BIGINT) AS runs, CAST(2 * sum(year) AS BIGINT) AS years, true AS stamped FROM decisions GROUP BY 1")
def _(b):
    """A run record for each act, appended twice; the log holds both, each with its time."""
    path = f"{shared_folder(b.spark)}/audit-{uuid.uuid4().hex}"
    records = b.decisions.select("entity", "ada", "year")
    for _ in range(2):
        ld.append_audit(records, path)
    log = ld.read_audit(b.spark, path, "entity string, ada string, year int")
    return log.groupBy("entity").agg(F.count("*").alias("runs"), F.sum("year").alias("years"), F.bool_and(c("ts").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$")).alias("stamped"))


@query("src12_write_curated", "SELECT entity, year, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS eur, true AS sorted FROM payment GROUP BY 1, 2")
def _(b):
    """Payments in their declared columns, sorted by their keys and in folders by year, read back: the rows, and
    that each file holds them in order."""
    path = f"{shared_folder(b.spark)}/curated-{uuid.uuid4().hex}"
    ld.write_curated(b.payment, path, ("entity", "date", "source_ada"), ("entity", "date", "source_ada", "amount", "year"), partition_by=("year",))
    back = b.spark.read.schema("entity string, date date, source_ada string, amount decimal(18,2), year int").parquet(path)
    key = F.concat_ws("/", "entity", c("date").cast("string"), "source_ada")
    by_file = back.select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row"))
    order = by_file.withColumn("before", F.lag(key).over(Window.partitionBy("file").orderBy("row"))).withColumn("ok", F.coalesce(c("before") <= key, F.lit(True)))
    return order.groupBy("entity", "year").agg(F.count("*").alias("n"), F.sum("amount").alias("eur"), F.bool_and("ok").alias("sorted"))


@query("src15_set_digest", "SELECT ada, sha256(array_to_string(list_sort(list_distinct([sha256(entity), sha256(c_mktsegment), sha256(entity)])), chr(10))) AS digest FROM decisions")
def _(b):
    h = lambda x: F.sha2(c(x), 256)
    return b.decisions.select("ada", set_digest(F.array(h("entity"), h("c_mktsegment"), h("entity"))).alias("digest"))


LANES = " || ':' || ".join(f"CAST(sum(CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)) AS VARCHAR)" for i in range(8))


@query("src15_group_digest", f"SELECT org, sha256(CAST(count(*) AS VARCHAR) || ':' || {LANES}) AS digest FROM (SELECT DISTINCT org, sha256(CAST(key AS VARCHAR)) AS h FROM ev) GROUP BY 1", EVENTS)
def _(b):
    return group_digest(landed(b).select("org", F.sha2(c("key").cast("string"), 256).alias("h")), ["org"], "h")

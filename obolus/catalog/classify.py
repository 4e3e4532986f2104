"""CL1-CL18: ordered rules over folded text on payment lines and titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.catalog.functions import sql_fold
from obolus.catalog.oracle import pick
from obolus.catalog.registry import query
from obolus.operators import classify as k
from obolus.operators.resolve import class_targets, counterparties, counterparty_names, counterparty_sources, propagate_payee_class
from obolus.operators.rules import first_match, first_match_by_set, lookup
from obolus.session import written

c = F.col


def sql_upper(x: str) -> str:
    return f"upper(replace(strip_accents({x}), 'ß', 'SS'))"


def sql_word(p: str) -> str:
    return rf"(^|[^\p{{L}}])(?:{p})($|[^\p{{L}}])"


SCHEME = r"CASE WHEN regexp_matches(kae, '^\d{2}[.\-]\d{4}') THEN 'old' WHEN regexp_matches(kae, '^\d{4}(\.\d+)?$') THEN 'bare' WHEN regexp_matches(kae, '^\d{3}\.\d{7}') THEN 'new' ELSE 'unknown' END"
MAJOR = r"CASE WHEN regexp_matches(kae, '^\d{2}[.\-]\d{4}') THEN substr(kae, 4, 2) WHEN regexp_matches(kae, '^\d{4}(\.\d+)?$') THEN substr(kae, 1, 2) WHEN regexp_matches(kae, '^\d{3}\.\d{7}') THEN substr(kae, 5, 2) END"
LEGAL = (sql_word(r"ΟΕ|Ο\.Ε\.?|ΑΕ|Α\.Ε\.?|ΕΠΕ|ΑΦΟΙ|ΔΗΜΟΣ|ΤΑΜΕΙΟ") + "|ΥΠΟΥΡΓΕΙ|ΤΡΑΠΕΖ")
NATURAL = (rf"coalesce(length(name) > 0 AND (contains(name, ',,') OR regexp_matches(un, 'ΥΠΟΛΟΓΟΣ') OR (regexp_matches(afm, '^\d{{9}}$') AND coalesce(afm_type, 'EL') = 'EL' "
           rf"AND regexp_matches(afm, '^[0-3]') AND NOT regexp_matches(afm, '^0[89]') AND len(list_filter(string_split(un, ' '), lambda w: w <> '')) <= 4 "
           rf"AND NOT regexp_matches(un, '{LEGAL}'))), false)")

# names repeat, so their folded forms are taken once per distinct name and subject
CLASSIFIED = {
    "name_forms": f"SELECT name, {sql_upper('name')} AS un FROM (SELECT DISTINCT name FROM raw_payment)",
    "kinds": rf"""SELECT r.*, n.un, {sql_upper('subject')} AS us, {SCHEME} AS scheme, {MAJOR} AS major, {NATURAL} AS is_person
        FROM raw_payment r JOIN name_forms n USING (name)""",
    "payroll": r"""SELECT *, CASE WHEN regexp_matches(un, '(&|\bΚΑΙ)\s*ΛΟΙΠ(ΟΙ|ΕΣ|ΩΝ)') THEN 'batch'
        WHEN contains(name, ',,') AND regexp_matches(us, 'ΜΙΣΘΟΔΟΣ|ΑΠΟΔΟΧ|ΥΠΕΡΩΡΙ') THEN 'named'
        WHEN is_person AND ((scheme IN ('old', 'bare') AND major = '60') OR (scheme = 'new' AND major = '21')) THEN 'personnel_kae' END AS payroll_kind FROM kinds""",
    "classified": rf"""SELECT *, CASE WHEN payroll_kind IS NOT NULL THEN 'payroll' WHEN afm IN (SELECT DISTINCT s_afm FROM supplier_name WHERE s_nationkey = 7) THEN 'internal_transfer'
        WHEN remit THEN 'remittance'
        WHEN coalesce(major = '63', false) OR regexp_matches(un, 'ΥΠΟΥΡΓΕΙΟ ΟΙΚΟΝΟΜ') OR regexp_matches(us, 'ΕΝΦΙΑ') THEN 'tax'
        WHEN coalesce(major = '65', false) OR regexp_matches(un, 'ΤΡΑΠΕΖ') THEN 'debt_service'
        WHEN regexp_matches(un, 'ΔΗΜΟΣ |ΥΠΟΥΡΓΕΙ') THEN 'other_public_body' ELSE 'supplier' END AS payee_class,
        CASE WHEN payroll_kind IS NULL THEN CASE WHEN is_person THEN 'φυσικό πρόσωπο' ELSE name END END AS counterparty_display,
        CASE WHEN payroll_kind IS NULL THEN afm END AS counterparty_afm, CASE WHEN payroll_kind IS NULL THEN name END AS counterparty_name_raw,
        CASE WHEN payroll_kind IS NULL THEN afm_type END AS counterparty_afm_type,
        CASE WHEN amount > 100000 THEN 'threshold' END AS suspect_reason, amount > 100000 AS amount_suspect, payroll_kind IS NOT NULL AS is_payroll
        FROM (SELECT *, payroll_kind IS NULL AND (coalesce((scheme IN ('old', 'bare') AND major = '82') OR (scheme = 'new' AND major = '59'), false)
              OR regexp_matches(us, 'ΚΡΑΤΗΣ')) AS remit FROM payroll)""",
}


def classified(b):
    family = b.supplier_name.filter(c("s_nationkey") == 7).select(c("s_afm").alias("afm")).distinct()
    lines = b.raw_payment.withColumns({"doc_mismatch": F.lit(False), "duplicate": F.lit(False)})
    return k.classify_payment_lines(lines, family, suspect_above=100_000)


def classified_once(b):
    """The classified lines as a table, for a query that reads them more than once (the registry does: sums and
    digests); the subject, which only the classification reads, is not stored."""
    return written(classified(b).drop("subject"))


SEGMENTS = (("money", "ΑΠΟΔΟΧ"), ("works", "ΑΝΑΤΡΟΠ|ΥΠΟΧΡΕΩΣ"), ("people", "ΜΙΣΘΟΔΟΣ"), ("reports", "ΕΚΤΕΛΕΣ"))


@query("cl01_first_match", f"""SELECT CASE WHEN regexp_matches(f, 'ΑΠΟΔΟΧ') THEN 'money' WHEN regexp_matches(f, 'ΑΝΑΤΡΟΠ|ΥΠΟΧΡΕΩΣ') THEN 'works'
    WHEN regexp_matches(f, 'ΜΙΣΘΟΔΟΣ') THEN 'people' WHEN regexp_matches(f, 'ΕΚΤΕΛΕΣ') THEN 'reports' ELSE 'other' END AS label, type, count(*) AS n
    FROM (SELECT type, {sql_fold('subject')} AS f FROM act) GROUP BY ALL""")
def _(b):
    from obolus.functions.text import fold
    return b.act.select(first_match(fold(c("subject")), SEGMENTS, "other").alias("label"), "type").groupBy("label", "type").agg(F.count("*").alias("n"))


@query("cl02_reversal", f"SELECT ada, regexp_matches({sql_upper('subject')}, 'ΑΝΑΤΡΟΠ|ΑΝΑΚΛΗΣ') OR status = 'REVOKED' AS is_reversal FROM act")
def _(b):
    return b.act.select("ada", k.is_reversal(c("subject"), c("status") == "REVOKED").alias("is_reversal"))


@query("cl03_remittance", "SELECT source_ada, CAST(line_no AS BIGINT) AS line_no, remit AS is_remittance, kae FROM classified", CLASSIFIED)
def _(b):
    return classified(b).select("source_ada", "line_no", "is_remittance", "kae")


@query("cl04_natural_person", f"SELECT name, afm, afm_type, {NATURAL} AS is_person, count(*) AS n FROM raw_payment JOIN name_forms USING (name) GROUP BY ALL", CLASSIFIED)
def _(b):
    parties = b.raw_payment.groupBy("name", "afm", "afm_type").agg(F.count("*").alias("n"))
    return parties.select("name", "afm", "afm_type", k.is_natural_person(c("name"), c("afm"), c("afm_type")).alias("is_person"), "n")


@query("cl05_payroll_kind", """SELECT payroll_kind, is_payroll, counterparty_afm IS NULL AS no_id, counterparty_name_raw IS NULL AS no_name,
    count(*) AS n, CAST(sum(amount) AS DOUBLE) AS eur FROM classified GROUP BY ALL""", CLASSIFIED)
def _(b):
    return (classified(b).groupBy("payroll_kind", "is_payroll", c("counterparty_afm").isNull().alias("no_id"), c("counterparty_name_raw").isNull().alias("no_name"))
            .agg(F.count("*").alias("n"), F.sum("amount").alias("eur")))


@query("cl06_payee_class", pick("source_ada line_no:i payee_class counterparty_afm amount:m", "classified"), CLASSIFIED)
def _(b):
    return classified(b).select("source_ada", "line_no", "payee_class", "counterparty_afm", "amount")


@query("cl07_suspect", pick("source_ada line_no:i amount:m amount_suspect suspect_reason", """(SELECT source_ada, line_no, amount, reason IS NOT NULL AS amount_suspect, reason AS suspect_reason
    FROM (SELECT *, CASE WHEN amount > 100000 THEN 'threshold' WHEN entity = '3' AND line_no = 2 THEN 'document_mismatch' WHEN act_status = 'REVOKED' THEN 'duplicate_posting' END AS reason
    FROM raw_payment))"""))
def _(b):
    reason = k.suspect_reason(c("amount"), (c("entity") == "3") & (c("line_no") == 2), c("act_status") == "REVOKED", 100_000)
    return b.raw_payment.withColumn("suspect_reason", reason).select("source_ada", "line_no", "amount", c("suspect_reason").isNotNull().alias("amount_suspect"), "suspect_reason")


@query("cl08_line_corrections", """SELECT source_ada, CAST(line_no AS BIGINT) AS line_no, o_orderpriority = '1-URGENT' OR coalesce(o_orderpriority = '2-HIGH' AND line_no = 2 AND twos = 1, false) AS doc_mismatch
    FROM raw_payment JOIN decisions ON ada = source_ada LEFT JOIN (SELECT source_ada AS s2, count(*) AS twos FROM raw_payment WHERE line_no = 2 GROUP BY 1) ON s2 = source_ada""")
def _(b):
    """Corrections are a table of their own, with two entries for each document: line 2 of urgent acts
    first, then all their lines; every line of high ones first, then line 2 as it still stands, where
    one line has that number. The later entry holds."""
    lines = b.raw_payment.select("source_ada", "line_no", "amount", "kae")
    p = b.decisions.select(c("ada").alias("doc"), "o_orderpriority")
    whole = [F.lit(None).cast("int").alias("corr_line"), F.lit(None).cast("decimal(18,2)").alias("corr_amount"), F.lit(None).cast("string").alias("corr_kae")]
    twos = (lines.filter(c("line_no") == 2).groupBy(c("source_ada").alias("doc")).agg(F.count("*").alias("n"), F.max("amount").alias("corr_amount")).filter(c("n") == 1).join(p, "doc"))
    two = [F.lit(2).alias("corr_line"), "corr_amount", F.lit(None).cast("string").alias("corr_kae")]
    urgent, high = c("o_orderpriority") == "1-URGENT", c("o_orderpriority") == "2-HIGH"
    entries = (twos.filter(urgent).select("doc", *two, F.lit(0).alias("corr_seq")).unionByName(p.filter(urgent).select("doc", *whole, F.lit(1).alias("corr_seq")))
               .unionByName(twos.filter(high).select("doc", *whole, F.lit(0).alias("corr_seq"))).unionByName(twos.filter(high).select("doc", *two, F.lit(1).alias("corr_seq"))))
    return k.apply_line_corrections(lines, entries).select("source_ada", "line_no", "doc_mismatch")


@query("cl09_execution_statement", f"SELECT ada, type = 'Β.3' AND contains(f, 'ΕΚΤΕΛΕΣ') AND (contains(f, 'ΠΡΟΥΠΟΛΟΓΙΣΜ') OR contains(f, 'Π/Υ')) AS is_statement FROM (SELECT ada, type, {sql_fold('subject')} AS f FROM act)")
def _(b):
    return b.act.select("ada", k.is_execution_statement(c("type"), c("subject")).alias("is_statement"))


@query("cl10_family_sets", f"""SELECT ada, CASE WHEN entity IN ('1', '2') THEN CASE WHEN regexp_matches(f, 'ΑΠΟΔΟΧ') THEN 'grant' ELSE 'other' END
    ELSE coalesce(CASE WHEN entity = '3' AND regexp_matches(f, 'ΑΝΑΤΡΟΠ') THEN 'reversal' END, CASE WHEN regexp_matches(f, 'ΜΙΣΘΟΔΟΣ') THEN 'pay' WHEN regexp_matches(f, 'ΑΠΟΔΟΧ|ΕΠΙΧΟΡΗΓ') THEN 'money' ELSE 'other' END) END AS family
    FROM (SELECT ada, entity, {sql_fold('subject')} AS f FROM act)""")
def _(b):
    from obolus.functions.text import fold
    f = fold(c("subject"))
    own = {"1": (("grant", "ΑΠΟΔΟΧ"),), "2": (("grant", "ΑΠΟΔΟΧ"),), "3": (("reversal", "ΑΝΑΤΡΟΠ"),)}
    closed = c("entity").isin("1", "2")  # issuers the default set does not apply to
    default = first_match(f, (("pay", "ΜΙΣΘΟΔΟΣ"), ("money", "ΑΠΟΔΟΧ|ΕΠΙΧΟΡΗΓ")), "other")
    return b.act.select("ada", F.coalesce(first_match_by_set(f, c("entity"), own), F.when(closed, F.lit("other")).otherwise(default)).alias("family"))


@query("cl12_category_of", """SELECT ada, CASE WHEN family = 'kap_general' AND budget_year IN (1996, 1997) THEN 'kap_other' ELSE category END AS category FROM grant_decision""")
def _(b):
    by_year = {"kap_general/1996": "kap_other", "kap_general/1997": "kap_other"}
    of_family = {"kap_general": "kap_general", "region_credit": "investment_programmes", "region_fund_payment": "kap_investment",
                 "foundation_statutory_grant": "state_grants", "ped_grant": None}
    key = F.concat_ws("/", "family", c("budget_year").cast("string"))
    return b.grant_decision.select("ada", F.coalesce(lookup(key, by_year), lookup(c("family"), of_family)).alias("category"))


@query("cl15_acceptance", f"""SELECT ada, CASE WHEN regexp_matches(f, '^ΕΙΣΗΓΗΣΗ') THEN 'proposal' ELSE 'acceptance' END AS kind,
    CASE WHEN regexp_matches(f, 'ΠΡΑΣΙΝΟ ΤΑΜΕΙΟ') THEN 'green_fund' WHEN regexp_matches(f, 'ΥΠΕΣ') THEN 'interior' ELSE 'unknown' END AS grantor,
    CAST(price * 100 AS BIGINT) AS amount_cents FROM (SELECT a.ada, d.price, {sql_fold('a.subject')} AS f FROM act a JOIN decisions d USING (ada)) WHERE regexp_matches(f, 'ΑΠΟΔΟΧΗΣ? (ΧΡΗΜΑΤΟΔΟΤ|ΕΠΙΧΟΡΗΓ)')""")
def _(b):
    return b.act.select("ada", k.acceptance(c("subject")).alias("a")).filter(c("a").isNotNull()).select("ada", "a.kind", "a.grantor", "a.amount_cents")


@query("cl16_whitelist_reason", f"""SELECT ada, CASE WHEN regexp_matches(f, 'ΠΡΟΣΩΠΙΚΟΥ ΚΑΘ|@') THEN 'personal'
    WHEN year = 1999 OR (entity <> '4' AND regexp_matches(f, 'ΑΠΟΔΟΣ[ΗΕ]|ΕΠΙΧΟΡΗΓ|ΧΡΗΜΑΤΟΔΟΤ')) OR (entity <> '4' AND type = 'Β.1.1') OR regexp_matches(f, 'ΔΗΜΟΥ ΝΗΣΙΔΟΣ') THEN NULL ELSE 'not_a_grant' END AS reason
    FROM (SELECT ada, entity, type, year, {sql_fold('subject')} AS f FROM act)""")
def _(b):
    only = F.array(F.lit("own_body"))
    every = F.array(*[F.lit(r) for r in fv.KEEP_DEFAULT])
    keep = F.when(c("entity") == "4", only).otherwise(every)
    return b.act.select("ada", k.whitelist_reason(c("subject"), c("type"), c("year") == 1999, keep, "ΔΗΜΟΥ ΝΗΣΙΔΟΣ").alias("reason"))


@query("cl17_keep_rules", """SELECT ada, CASE WHEN has_foundation AND has_other THEN 'grant_words|investment_acts|own_body|statutory_grant'
    WHEN has_foundation THEN 'own_body|statutory_grant' ELSE 'grant_words|investment_acts|own_body' END AS keep
    FROM (SELECT ada, bool_or(issuer = '9') AS has_foundation, bool_or(issuer <> '9') AS has_other
          FROM (SELECT ada, CAST(s_nationkey AS VARCHAR) AS issuer FROM lines JOIN supplier ON s_suppkey = l_suppkey) GROUP BY 1)""")
def _(b):
    found = b.lines.join(b.star.supplier, c("s_suppkey") == c("l_suppkey")).select("ada", c("s_nationkey").cast("string").alias("issuer"))
    rules = F.when(c("uid") == "9", F.array(F.lit("own_body"), F.lit("statutory_grant")))  # others: the default
    return k.keep_rules(found, b.entity.select("uid", rules.alias("keep")))


@query("cl18_mask_person", "SELECT counterparty_display, is_payroll, count(*) AS n FROM classified GROUP BY ALL", CLASSIFIED)
def _(b):
    return classified(b).groupBy("counterparty_display", "is_payroll").agg(F.count("*").alias("n"))


# ---- class propagation and the counterparty registry ------------------------------------------------------
VOTES = {**CLASSIFIED, "votes": """SELECT counterparty_afm, sum(amount) AS total, sum(amount) FILTER (payee_class = 'supplier') AS sup,
    coalesce(sum(amount) FILTER (payee_class = 'remittance'), 0) AS r, coalesce(sum(amount) FILTER (payee_class = 'tax'), 0) AS t,
    coalesce(sum(amount) FILTER (payee_class = 'debt_service'), 0) AS d, coalesce(sum(amount) FILTER (payee_class = 'other_public_body'), 0) AS o
    FROM classified WHERE counterparty_afm IS NOT NULL AND act_status = 'PUBLISHED' AND NOT amount_suspect AND amount <> 0 GROUP BY 1""",
    "targets": """SELECT counterparty_afm, CASE WHEN r >= t AND r >= d AND r >= o THEN 'remittance' WHEN t >= d AND t >= o THEN 'tax' WHEN d >= o THEN 'debt_service' ELSE 'other_public_body' END AS target_class
        FROM votes WHERE total > 0 AND sup > 0 AND (r + t + d + o) >= total * 0.4"""}


@query("ag18_class_targets", "SELECT counterparty_afm, target_class FROM targets", VOTES)
def _(b):
    return class_targets(classified(b), share=0.4)


@query("ag18_propagate_class", """SELECT CASE WHEN c.payee_class = 'supplier' AND t.target_class IS NOT NULL THEN t.target_class ELSE c.payee_class END AS payee_class,
    CASE WHEN c.payee_class = 'supplier' AND t.target_class IS NOT NULL THEN 'afm_propagation' ELSE 'line' END AS payee_class_rule, act_status,
    count(*) AS n, CAST(sum(amount) AS DOUBLE) AS eur FROM classified c LEFT JOIN targets t USING (counterparty_afm) GROUP BY ALL""", VOTES)
def _(b):
    return (propagate_payee_class(classified(b), share=0.4).groupBy("payee_class", "payee_class_rule", "act_status")
            .agg(F.count("*").alias("n"), F.sum("amount").alias("eur")))


from obolus.catalog.functions import sql_norm  # noqa: E402

LANES = " || ':' || ".join(f"CAST(sum(CAST('0x' || substr(source_sha256, {8 * i + 1}, 8) AS BIGINT)) AS VARCHAR)" for i in range(8))
REGISTRY_SQL = {
    **CLASSIFIED,
    "ided": "SELECT *, counterparty_afm AS id FROM classified WHERE NOT is_payroll AND counterparty_afm IS NOT NULL",
    "id_names": f"""SELECT id, counterparty_name_raw AS name, {sql_norm('counterparty_name_raw')} AS norm, count(*) AS n, min((date, source_ada, line_no)) AS first
        FROM ided WHERE length(counterparty_name_raw) > 0 GROUP BY 1, 2""",
    "id_best": "SELECT id, arg_min(name, (-n, first)) AS canonical_name, count(*) AS n_names, count(DISTINCT norm) AS n_norms FROM id_names GROUP BY 1",
    "id_class": """SELECT id, arg_min(payee_class, (-n, first)) AS payee_class FROM
        (SELECT id, payee_class, count(*) AS n, min((date, source_ada, line_no)) AS first FROM ided GROUP BY 1, 2) GROUP BY 1""",
    "id_digest": f"SELECT id, sha256(CAST(count(*) AS VARCHAR) || ':' || {LANES}) AS source_digest FROM (SELECT DISTINCT id, source_sha256 FROM ided) GROUP BY 1",
    "id_first": "SELECT id, arg_min(coalesce(counterparty_afm_type, '-'), (date, source_ada, line_no)) AS first_type, max(counterparty_afm_type) AS any_type FROM ided GROUP BY 1",
    "id_natural": f"""SELECT id, bool_or(is_person) AS is_person FROM (SELECT id, {NATURAL.replace("coalesce(afm_type, 'EL') = 'EL'", "first_type IN ('-', 'EL')")} AS is_person
        FROM (SELECT i.id, i.id AS afm, i.name, {sql_upper('i.name')} AS un, f.first_type FROM id_names i JOIN id_first f USING (id))) GROUP BY 1""",
    "id_base": """SELECT id AS afm, arg_min(source_ada, (-coalesce(amount, 0), date, source_ada)) FILTER (act_status = 'PUBLISHED' AND NOT amount_suspect) AS largest_payment_ada,
        min(date) AS first_seen, max(date) AS last_seen,
        coalesce(sum(amount) FILTER (act_status = 'PUBLISHED' AND NOT amount_suspect), 0) AS total_received,
        coalesce(sum(amount) FILTER (act_status = 'PUBLISHED' AND NOT amount_suspect AND payee_class = 'supplier'), 0) AS total_received_supplier,
        count(*) FILTER (act_status = 'PUBLISHED' AND NOT amount_suspect) AS n_payments, count(*) FILTER (act_status <> 'PUBLISHED') AS n_payments_revoked,
        count(*) FILTER (amount_suspect) AS n_payments_suspect, bool_and(remit) AS is_remittance_payee, list_sort(list(DISTINCT entity)) AS entities,
        count(DISTINCT entity) AS n_entities FROM ided GROUP BY 1""",
    "registry": """SELECT b.*, d.source_digest, k.payee_class, t.any_type AS afm_type, n.canonical_name, n.n_names AS n_name_variants, n.n_norms AS n_name_variants_normalised, p.is_person AS is_natural_person,
        CASE WHEN p.is_person THEN 'φυσικό πρόσωπο' ELSE n.canonical_name END AS display_name, n.n_norms > 1 AS needs_review, CASE WHEN n.n_norms > 1 THEN 'name_variants' END AS review_reason
        FROM id_base b JOIN id_digest d ON d.id = b.afm JOIN id_class k ON k.id = b.afm JOIN id_best n ON n.id = b.afm JOIN id_natural p ON p.id = b.afm JOIN id_first t ON t.id = b.afm""",
}
REG_COLS = ("afm afm_type canonical_name display_name is_natural_person payee_class largest_payment_ada n_name_variants:i n_name_variants_normalised:i first_seen:d last_seen:d "
            "total_received:m total_received_supplier:m n_payments:i n_payments_revoked:i n_payments_suspect:i is_remittance_payee entities:a n_entities:i "
            "needs_review review_reason source_digest")


@query("ag17_counterparties", pick(REG_COLS, "registry"), REGISTRY_SQL)
def _(b):
    return counterparties(classified_once(b)).select(*[x.partition(":")[0] for x in REG_COLS.split()])


@query("ag17_counterparty_names", "SELECT id AS afm, name, n FROM id_names", REGISTRY_SQL)
def _(b):
    return counterparty_names(classified(b)).select("afm", "name", "n")


@query("ag17_counterparty_sources", "SELECT DISTINCT id AS afm, source_ada FROM ided", REGISTRY_SQL)
def _(b):
    return counterparty_sources(classified(b))

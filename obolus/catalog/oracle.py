"""The bound role tables as DuckDB CTEs, and the helper that puts the ones a query needs in
front of it. Written apart from the Spark bindings so that the two check each other."""

from __future__ import annotations

import re

from obolus.plans import bindings as b


def _case(key: str, table: dict, default: str = "NULL") -> str:
    lit = lambda v: "NULL" if v is None else f"'{v}'"
    k = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {key} " + " ".join(f"WHEN {k(x)} THEN {lit(y)}" for x, y in table.items()) + f" ELSE {default} END"


def amt(factor: str) -> str:
    return f"CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * ({factor}), 2) AS DECIMAL(18,2))"


DISC = amt("1 - CAST(l_discount AS DECIMAL(4,2))")
TAXED = amt("1 + CAST(l_tax AS DECIMAL(4,2))")
UNTAXED = amt("1 - CAST(l_tax AS DECIMAL(4,2))")
PUB = "CASE WHEN l_linestatus = 'F' THEN 'PUBLISHED' ELSE 'REVOKED' END"
EU = "replace(format('{:,}', CAST(floor(price) AS BIGINT)), ',', '.') || ',' || lpad(CAST(CAST(price * 100 AS BIGINT) % 100 AS VARCHAR), 2, '0')"
AFM9 = "lpad(CAST(l_suppkey AS VARCHAR), 9, '0')"

CTES: dict[str, str] = {
    "decisions": """SELECT o_orderkey, 'A' || o_orderkey AS ada, CAST(c_nationkey AS VARCHAR) AS entity, c_mktsegment, o_custkey,
        o_orderpriority, o_orderstatus, c_nationkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
        CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS year
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "lines": "SELECT l.*, d.* FROM lineitem l JOIN decisions d ON l.l_orderkey = d.o_orderkey",
    "act": f"""SELECT ada, entity, {_case('o_orderpriority', b.ACT_TYPE)} AS type, date, year,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Αποδοχή χρηματοδότησης ποσού ' || {EU} || ' € από το Πράσινο Ταμείο έτους ' || year
             WHEN 'BUILDING' THEN 'Ανατροπή ανάληψης  υποχρέωσης, απόδοση κρατήσεων ' || ada
             WHEN 'FURNITURE' THEN 'Μισθοδοσία μηνός και υπερωρίες προσωπικού'
             WHEN 'MACHINERY' THEN 'Εισήγηση για αποδοχή επιχορήγησης ποσού ' || {EU} || ' € από το ΥΠΕΣ'
             ELSE 'ΔΗΜΟΣΙΕΥΣΗ ΣΤΟΙΧΕΙΩΝ EΚΤΕΛΕΣΗΣ ΠΡOΫΠΟΛΟΓΙΣΜΟΥ, ΕΝΦΙΑ' END AS subject,
        {_case('o_orderstatus', b.ACT_STATUS)} AS status FROM decisions""",
    "supplier_name": """SELECT s_suppkey, s_nationkey, CASE s_nationkey WHEN 0 THEN 'ΔΗΜΟΣ ' || s_name WHEN 1 THEN 'Τράπεζα ' || s_name
        WHEN 2 THEN 'Υπουργείο Οικονομικών ' || s_name WHEN 3 THEN 'ΕΠΩΝΥΜΟ,,ΟΝΟΜΑ ' || s_name WHEN 4 THEN 'Αφοί ' || s_name || ' Ο.Ε.'
        WHEN 5 THEN 'Υπόλογος εντάλματος ' || s_name WHEN 6 THEN s_name || ' & Λοιποί' ELSE s_name END AS s_raw_name,
        lpad(CAST(s_nationkey * 4 AS VARCHAR), 2, '0') || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS s_afm FROM supplier""",
    "part_code": """SELECT p_partkey, n AS brand_no, '6' || two || '1' AS code, CASE WHEN n <= 10 THEN two || '.' || four WHEN n <= 15 THEN four
        WHEN n <= 20 THEN '0' || two || '.' || four || '001' WHEN n <= 23 THEN 'K' || four WHEN n = 24 THEN '' END AS raw_code
        FROM (SELECT p_partkey, n, lpad(CAST(n AS VARCHAR), 2, '0') AS two, lpad(CAST(40 + p_size AS VARCHAR), 2, '0') || lpad(CAST(n AS VARCHAR), 2, '0') AS four
              FROM (SELECT p_partkey, p_size, CAST(substr(p_brand, 7) AS INTEGER) AS n FROM part))""",
    "raw_payment": f"""SELECT l.ada AS source_ada, l_linenumber AS line_no, l.entity, l.date, l.year, {PUB} AS act_status,
        CASE WHEN l_quantity <> 50 THEN s_afm END AS afm, CASE WHEN l_returnflag = 'R' THEN 'EL' END AS afm_type,
        CASE l_returnflag WHEN 'A' THEN upper(s_raw_name) WHEN 'R' THEN replace(s_raw_name, '#', '. ') ELSE s_raw_name END AS name,
        a.subject, raw_code AS kae, {DISC} AS amount, sha256(l.ada) AS source_sha256
        FROM lines l JOIN act a ON a.ada = l.ada JOIN supplier_name s ON s.s_suppkey = l.l_suppkey JOIN part_code p ON p.p_partkey = l.l_partkey""",
    "payment": f"""SELECT *, payee_class = 'internal_transfer' AS is_internal_transfer, payee_class = 'remittance' AS is_remittance,
        suspect_reason IS NOT NULL AS amount_suspect FROM (
        SELECT *, CASE WHEN is_payroll THEN 'payroll' ELSE {_case('s_nationkey', b.PAYEE_CLASS, "'supplier'")} END AS payee_class,
        CASE WHEN is_payroll THEN 'batch' END AS payroll_kind,
        CASE WHEN NOT is_payroll AND l_quantity <> 50 THEN {AFM9} END AS counterparty_afm,
        CASE WHEN NOT is_payroll THEN s_name END AS counterparty_display, CASE WHEN NOT is_payroll THEN s_name END AS counterparty_name_raw,
        CASE WHEN amount > {b.SUSPECT_OVER} THEN 'threshold' WHEN l_returnflag = 'R' AND l_quantity = 2 THEN 'duplicate_posting' END AS suspect_reason
        FROM (SELECT l.ada AS source_ada, l_linenumber AS line_no, entity, date, year, {PUB} AS act_status, l_returnflag = 'N' AND l_quantity = 1 AS is_payroll,
              CASE WHEN NOT (l_linenumber = 7 AND l_tax = 0.08) THEN {DISC} END AS amount, '20.' || code AS kae, sha256(l.ada) AS source_sha256,
              s_nationkey, s_name, l_suppkey, l_returnflag, l_quantity
              FROM lines l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN part_code p ON p.p_partkey = l.l_partkey))""",
    "commitment": f"""SELECT ada AS source_ada, l_linenumber AS line_no, entity, date, year, {PUB} AS act_status,
        CASE WHEN l_quantity <> 13 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount, l_linenumber = 7 AS is_reversal,
        l_quantity > 1 AS has_kae_lines FROM lines""",
    "award": f"""SELECT ada AS source_ada, entity, date, year, CASE WHEN o_orderstatus = 'F' THEN 'PUBLISHED' ELSE 'REVOKED' END AS act_status,
        CASE WHEN o_orderpriority <> '5-LOW' THEN price END AS amount, {AFM9} AS person_afm FROM lines""",
    "entity": """SELECT CAST(n_nationkey AS VARCHAR) AS uid, n_name AS name,
        CASE WHEN n_regionkey <> 4 THEN lpad(CAST(n_nationkey AS VARCHAR), 9, '0') END AS afm, CAST(n_regionkey AS VARCHAR) AS category FROM nation""",
    "budget_first": f"""SELECT 'S-' || entity || '-' || year || '-' || month AS statement_ada, entity, CAST(last_day(make_date(year, month, 1)) + 15 AS DATE) AS statement_date,
        last_day(make_date(year, month, 1)) AS period_end, year AS period_year, month AS period_month, month = 12 AS is_year_end, side, kae,
        substr(kae, 1, 2) AS kae_group, 'Γραμμή ' || n || ' τρίμηνο ' || quarter(make_date(year, month, 1)) AS description,
        CASE WHEN side = 'revenue' THEN CASE WHEN n <= 5 THEN 'kap_general' WHEN n <= 10 THEN 'kap_investment' WHEN n <= 15 THEN 'state_grants'
             WHEN n <= 18 THEN 'investment_programmes' END END AS grant_category,
        sum(bb) OVER w AS budgeted, sum(aa) OVER w AS assessed_or_warranted, sum(pp) OVER w AS collected_or_paid
        FROM (SELECT entity, CASE WHEN l_returnflag = 'A' THEN 'revenue' ELSE 'spending' END AS side, year, CAST(month(date) AS INTEGER) AS month,
              CASE WHEN l_returnflag = 'A' THEN '1' || lpad(CAST(brand_no AS VARCHAR), 2, '0') || '1' ELSE code END AS kae, brand_no AS n,
              sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS bb, sum({DISC}) AS aa, sum({UNTAXED}) AS pp
              FROM lines JOIN part_code ON p_partkey = l_partkey GROUP BY ALL)
        WINDOW w AS (PARTITION BY entity, side, year, kae ORDER BY month)""",
    "budget_line": """SELECT * FROM budget_first UNION ALL
        SELECT * REPLACE (statement_ada || 'b' AS statement_ada, CAST(statement_date + 10 AS DATE) AS statement_date, budgeted + 1 AS budgeted)
        FROM budget_first WHERE is_year_end""",
    "grant_decision": f"""SELECT ada, entity AS issuer, {_case('n_regionkey', b.GRANTORS)} AS grantor, entity AS issuer_label, date, year,
        CASE WHEN month(date) = 12 THEN year + 1 ELSE year END AS budget_year, {_case('o_orderpriority', b.ACT_TYPE)} AS decision_type,
        {_case('o_orderstatus', b.ACT_STATUS)} AS status, 'Απόδοση ' || c_mktsegment || ' Δήμου Νησίδος' AS subject,
        {_case('o_orderpriority', b.GRANT_FAMILY)} AS family, {_case('o_orderpriority', b.GRANT_CATEGORY)} AS category,
        CAST(o_custkey AS VARCHAR) AS protocol_number, CAST(date AS VARCHAR) || 'T' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS submission_ts,
        CASE o_orderpriority {' '.join(f"WHEN '{k}' THEN {v}::VARCHAR[]" for k, v in b.FOUND_BY.items())} END AS found_by,
        o_orderstatus = 'F' AS text_indexed, {_case('o_orderpriority', b.READ_STATUS)} AS read_status,
        CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS n_amounts, CASE WHEN o_orderpriority <> '5-LOW' THEN ada END AS pdf_sha256,
        CASE WHEN c_mktsegment = 'HOUSEHOLD' AND o_orderpriority = '5-LOW' THEN 'A0' END AS duplicate_of
        FROM decisions JOIN nation ON n_nationkey = c_nationkey""",
    "grant_line": f"""SELECT ada, {_case('n_regionkey', b.GRANTORS)} AS grantor, entity AS recipient_entity, date, year,
        CASE WHEN month(date) = 12 THEN year + 1 ELSE year END AS budget_year, {PUB} AS status, {_case('o_orderpriority', b.GRANT_FAMILY)} AS family,
        {_case('o_orderpriority', b.GRANT_CATEGORY)} AS category, {amt('1')} AS amount, CASE WHEN l_returnflag = 'N' THEN {UNTAXED} END AS net_paid,
        {_case('l_returnflag', b.VALIDATION)} AS validation, CASE WHEN l_linenumber = 7 THEN 'A0' END AS duplicate_of
        FROM lines JOIN nation ON n_nationkey = c_nationkey""",
    "acceptance": f"""SELECT ada, entity, date, year, {_case('o_orderstatus', b.ACT_STATUS)} AS status, lower(c_mktsegment) AS grantor,
        {_case('o_orderpriority', b.ACCEPTANCE_KIND)} AS kind,
        CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(floor(price / 10000) * 10000 AS DECIMAL(18,2)) END AS amount_stated FROM decisions""",
    "procurement": f"""SELECT ada AS ref, {_case('o_orderpriority', b.ENDPOINT)} AS endpoint, entity, date AS submission_date, year,
        o_orderstatus = 'P' AS cancelled, {_case('c_mktsegment', b.PROCEDURE)} AS procedure_type, price AS total_cost_without_vat FROM decisions""",
    "procurement_party": f"""SELECT 'R-' || l_orderkey || '-' || l_linenumber AS ref, entity, CAST(l_shipdate AS DATE) AS submission_date,
        CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag = 'N' AND l_quantity = 3 AS cancelled,
        CASE WHEN l_quantity = 4 THEN 'contractor' ELSE 'payee' END AS role, CASE WHEN l_quantity <> 5 THEN {AFM9} END AS afm,
        {AFM9} AS display_name, {TAXED} AS amount_with_vat FROM lines""",
}


def needed(sql: str, extra: dict[str, str]) -> list[str]:
    """The CTEs a query names, in dependency order."""
    every = CTES | extra
    order: list[str] = []

    def visit(text: str, skip: str = "") -> None:
        for name in every:
            if name != skip and name not in order and re.search(rf"\b(?:FROM|JOIN)\s+\(?\s*{name}\b", text):
                visit(every[name], name)
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def with_tables(sql: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` with the role tables it reads as CTEs in front."""
    extra = extra or {}
    names = needed(sql, extra)
    if not names:
        return sql
    every = CTES | extra
    return "WITH " + ",\n".join(f"{n} AS (\n{every[n]})" for n in names) + "\n" + sql


def pick(cols: str, source: str, tail: str = "") -> str:
    """SELECT of ``name:type`` columns with the types both engines print alike:
    i integer, m money or ratio, d date, a array, plain text otherwise."""
    forms = {"i": "CAST({0} AS BIGINT)", "m": "CAST({0} AS DOUBLE)", "d": "strftime({0}, '%Y-%m-%d')",
             "a": "array_to_string({0}, '|')", "": "{0}"}
    out = []
    for col in cols.split():
        name, _, kind = col.partition(":")
        out.append(f"{forms[kind].format(name)} AS {name}")
    return f"SELECT {', '.join(out)} FROM {source} {tail}"

"""RP1-RP28 and the finder of double postings, on the bound tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from obolus.catalog.classify import REGISTRY_SQL, classified_once
from obolus.catalog.oracle import pick
from obolus.catalog.registry import query
from obolus.catalog.views import OK, SQL as V
from obolus.operators.resolve import counterparties
from obolus.plans import reports as rp
from obolus.plans.views import Release

c = F.col

# the registry over the bound payments, for the report queries that read it
COUNTERPARTY = {**V, "ided": "SELECT *, counterparty_afm AS id FROM payment WHERE NOT is_payroll AND counterparty_afm IS NOT NULL",
    "cp": f"""SELECT id AS afm, min(counterparty_name_raw) AS display_name, coalesce(sum(amount) FILTER ({OK}), 0) AS total_received,
        coalesce(sum(amount) FILTER ({OK} AND payee_class = 'supplier'), 0) AS total_received_supplier, count(*) FILTER ({OK}) AS n_payments,
        min(date) AS first_seen, max(date) AS last_seen, arg_min(source_ada, (-coalesce(amount, 0), date, source_ada)) FILTER ({OK}) AS largest_payment_ada FROM ided GROUP BY 1"""}


def yearly(where: str) -> str:
    cols = ", ".join(f"CAST(sum({k}) AS {'BIGINT' if k.startswith('n_') else 'DOUBLE'}) AS {k}" for k in rp.YEARLY)
    return f"SELECT CAST(year AS BIGINT) AS year, {cols} FROM v_yearly WHERE {where} GROUP BY year"


def add(name, sql, fn, extra=V):
    query(name, sql, extra)(lambda b: fn(b.release))


add("rp01_corpus_by_entity", "SELECT entity, count(*) AS n, CAST(min(year) AS BIGINT) AS first_year, CAST(max(year) AS BIGINT) AS last_year FROM act GROUP BY 1", rp.corpus_by_entity)
add("rp02_status_counts", "SELECT status, count(*) AS n FROM act GROUP BY 1", rp.status_counts)
add("rp03_types_by_year", """SELECT CAST(year AS BIGINT) AS year, count(*) AS total, count(*) FILTER (rk = 1) AS t1, count(*) FILTER (rk = 2) AS t2, count(*) FILTER (rk = 3) AS t3,
    count(*) FILTER (rk > 3) AS other FROM act JOIN (SELECT type, row_number() OVER (ORDER BY count(*) DESC, type) AS rk FROM act GROUP BY 1) USING (type) GROUP BY 1""", rp.types_by_year)
add("rp04_yearly_money_all", yearly("true"), rp.yearly_money)
add("rp04_yearly_money_one", yearly("entity = '7'"), lambda r: rp.yearly_money(r, r.home))
add("rp05_payee_classes", "SELECT payee_class, CAST(sum(n_lines) AS BIGINT) AS n_lines, CAST(sum(n_acts) AS BIGINT) AS n_acts, CAST(sum(eur) AS DOUBLE) AS eur FROM v_payee_class_year GROUP BY 1", rp.payee_classes)
add("rp06_internal_transfers", "SELECT counterparty_display, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS eur FROM v_internal_transfer GROUP BY 1 ORDER BY sum(amount) DESC, 1 LIMIT 6", rp.largest_internal_transfers)
add("rp07_supplier_series", pick("entity year:i n_own:i n_suppliers:i n_only_procurement:i supplier_eur:m top10_share:m top1_share:m",
    "(SELECT c.*, d.n_suppliers AS n_own FROM v_supplier_year_combined c LEFT JOIN v_counterparty_year d USING (entity, year))"), rp.supplier_series)
add("rp08_registry_review", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_review, CAST(sum(total_received) AS DOUBLE) AS total_received FROM cp", rp.registry_review, COUNTERPARTY)


def raw_release(b) -> Release:
    """The release over classified raw payment lines, where natural persons occur. They are classified once: the
    registry and the views read them from a table."""
    lines = classified_once(b)
    return Release(lambda name: {"payment": lines, "counterparty": counterparties(lines)}[name] if name in ("payment", "counterparty") else getattr(b, name), home="7")


query("rp10_natural_persons", """SELECT count(DISTINCT c.counterparty_afm) AS n_persons, count(*) AS n_lines, CAST(sum(c.amount) AS DOUBLE) AS eur,
    CAST(sum(c.amount) AS DOUBLE) / (SELECT CAST(sum(amount) AS DOUBLE) FROM classified WHERE act_status = 'PUBLISHED' AND NOT amount_suspect AND payee_class = 'supplier') AS share
    FROM classified c JOIN registry r ON r.afm = c.counterparty_afm WHERE r.is_natural_person AND c.act_status = 'PUBLISHED' AND NOT c.amount_suspect AND c.payee_class = 'supplier'""",
    REGISTRY_SQL)(lambda b: rp.natural_persons_line(raw_release(b)))
query("rp09_top_payees", pick("afm display_name total_received_supplier:m",
    "(SELECT * FROM registry WHERE total_received_supplier > 0 AND NOT is_natural_person ORDER BY total_received_supplier DESC, afm LIMIT 40)"),
    REGISTRY_SQL)(lambda b: rp.top_payees(raw_release(b), 40).select("afm", "display_name", "total_received_supplier"))
query("pv06_person_free_ranking", pick("afm display_name total_received_supplier:m n_payments:i first_seen:d last_seen:d largest_payment_ada",
    "(SELECT * FROM registry WHERE total_received_supplier > 0 AND NOT is_natural_person ORDER BY total_received_supplier DESC, afm LIMIT 15)"),
    REGISTRY_SQL)(lambda b: rp.top_payees(raw_release(b)))
add("rp11_suspect_lines", pick("entity date:d source_ada amount:m suspect_reason payee subject", """(SELECT p.entity, p.date, p.source_ada, p.amount, p.suspect_reason, substr(p.counterparty_display, 1, 40) AS payee,
    substr(a.subject, 1, 70) AS subject FROM v_payment_suspect p JOIN act a ON a.ada = p.source_ada)"""), rp.suspect_lines)
add("rp12_largest_lines", pick("entity date:d source_ada amount:m payee kae subject", """(SELECT p.entity, p.date, p.source_ada, p.amount, substr(p.counterparty_display, 1, 40) AS payee, p.kae,
    substr(a.subject, 1, 70) AS subject FROM v_supplier_payment p JOIN act a ON a.ada = p.source_ada ORDER BY p.amount DESC NULLS LAST, p.source_ada, p.line_no, payee, p.kae LIMIT 8)"""), rp.largest_lines)
add("rp13_reversals", "SELECT count(DISTINCT source_ada) AS n_acts, CAST(sum(amount) AS DOUBLE) AS eur FROM v_commitment_reversal", rp.reversals)
add("rp14_gap_counters", f"""SELECT (SELECT count(*) FROM act WHERE status = 'PENDING_REVOCATION') AS pending, (SELECT count(*) FROM act WHERE status = 'REVOKED') AS revoked,
    (SELECT count(*) FROM act WHERE type = 'Δ.1' AND year = 1997 AND entity = '7') AS awards_of_type, (SELECT count(*) FROM v_payroll) AS payroll_lines,
    (SELECT count(*) FROM v_award WHERE amount IS NULL) AS awards_without_amount, (SELECT count(*) FROM v_commitment WHERE NOT has_kae_lines) AS commitments_without_lines""",
    lambda r: rp.gap_counters(r, "Δ.1", 1997, r.home))
add("rp15_reversal_years", pick("year:i reversal_eur:m commitment_eur:m", "v_yearly", "WHERE entity = '7' AND year >= 1996 AND coalesce(reversal_eur, 0) > coalesce(commitment_eur, 0)"),
    lambda r: rp.reversal_years(r, r.home, 1996))
add("rp16_payroll_kinds", "SELECT payroll_kind, count(*) AS n FROM payment WHERE is_payroll GROUP BY 1", rp.payroll_kinds)
add("rp17_acts_without_amount", """SELECT CAST(year AS BIGINT) AS year, count(*) FILTER (m = 0) AS n_empty, count(*) AS n, count(*) FILTER (m = 0) > 0.05 * count(*) AS thin
    FROM (SELECT year, source_ada, max(coalesce(amount, 0)) AS m FROM commitment WHERE entity = '7' AND act_status = 'PUBLISHED' GROUP BY 1, 2) GROUP BY 1""", lambda r: rp.acts_without_amount(r, r.home))
add("rp18_one_year_totals", """SELECT CAST(sum(payment_eur) AS DOUBLE) AS payment_eur, CAST(sum(n_payroll_acts) AS BIGINT) AS n_payroll_acts, CAST(sum(commitment_eur) AS DOUBLE) AS commitment_eur,
    CAST(sum(n_payment_acts) AS BIGINT) AS n_payment_acts, CAST(sum(remittance_eur) AS DOUBLE) AS remittance_eur, CAST(sum(reversal_eur) AS DOUBLE) AS reversal_eur FROM v_yearly
    WHERE entity = '7' AND year = 1997""", lambda r: rp.one_year_totals(r, r.home, 1997))
add("rp19_coverage_by_year", """SELECT CAST(year AS BIGINT) AS year, CAST(sum(paid_per_statement) AS DOUBLE) AS paid_per_statement, CAST(sum(paid_in_register) AS DOUBLE) AS paid_in_register,
    CAST(sum(paid_in_register) FILTER (kae_group <> '60') AS DOUBLE) / CAST(sum(paid_per_statement) FILTER (kae_group <> '60') AS DOUBLE) AS coverage_without, min(statement_ada) AS statement_ada
    FROM v_payment_coverage WHERE entity = '7' GROUP BY 1""", lambda r: rp.coverage_by_year(r, r.home, "60"))
GROUPS = {"general": ("kap_general",), "works": ("kap_investment", "investment_programmes"), "state": ("state_grants",)}
add("rp20_grants_by_category", """SELECT CAST(year AS BIGINT) AS year, CAST(sum(n_decisions) AS BIGINT) AS n_decisions, CAST(sum(allocated) FILTER (category = 'kap_general') AS DOUBLE) AS general,
    CAST(sum(allocated) FILTER (category IN ('kap_investment', 'investment_programmes')) AS DOUBLE) AS works, CAST(sum(allocated) FILTER (category = 'state_grants') AS DOUBLE) AS state,
    CAST(sum(allocated) AS DOUBLE) AS allocated FROM v_grant_year WHERE grantor = 'interior' GROUP BY 1""", lambda r: rp.grants_by_category(r, "interior", GROUPS))
add("rp21_read_status", "SELECT read_status, count(*) AS n FROM grant_decision WHERE grantor = 'interior' GROUP BY 1", lambda r: rp.read_status_counts(r, "interior"))
add("rp21_found_counters", """SELECT count(*) FILTER (list_contains(found_by, 'ΝΗΣΙΔΟΣ')) AS named, count(*) FILTER (read_status = 'read' AND NOT text_indexed AND NOT list_contains(found_by, 'ΝΗΣΙΔΟΣ')) AS hidden
    FROM grant_decision WHERE grantor = 'interior'""", lambda r: rp.found_counters(r, "interior", "ΝΗΣΙΔΟΣ"))
add("rp22_validated_lines", """SELECT count(*) AS n, count(validation) AS n_validated FROM grant_line WHERE category IS NOT NULL AND status = 'PUBLISHED' AND duplicate_of IS NULL AND grantor = 'interior'""",
    lambda r: rp.validated_lines(r, "interior"))
add("rp23_regional_money", """SELECT CAST(budget_year AS BIGINT) AS year, count(DISTINCT ada) FILTER (category IS NOT NULL) AS n_decisions, CAST(sum(amount) FILTER (family = 'region_credit') AS DOUBLE) AS credit,
    CAST(sum(amount) FILTER (family = 'region_fund_payment') AS DOUBLE) AS fund, CAST(sum(coalesce(net_paid, amount)) FILTER (family IN ('kap_general', 'ped_grant')) AS DOUBLE) AS agreement,
    CAST(sum(coalesce(net_paid, amount)) FILTER (category IS NOT NULL) AS DOUBLE) AS net, CAST(sum(amount) FILTER (family = 'ped_grant') AS DOUBLE) AS utility
    FROM v_grant_line WHERE grantor = 'region' GROUP BY 1""", lambda r: rp.regional_money(r, "region", "region_credit", "region_fund_payment", ("kap_general", "ped_grant"), "ped_grant"))
add("rp24_families_of_ours", """SELECT family, count(*) AS n FROM grant_decision WHERE grantor = 'region' AND duplicate_of IS NULL
    AND (regexp_matches(subject, 'BUILDING') OR len(list_filter(found_by, lambda t: regexp_matches(t, '^\\d+$'))) > 0) GROUP BY 1""", lambda r: rp.families_of_ours(r, "region", "BUILDING"))
add("rp25_statutory_vs_booked", """SELECT CAST(g.year AS BIGINT) AS year, g.n, CAST(g.eur AS DOUBLE) AS eur, CAST(g.spelled AS DOUBLE) AS spelled, CAST(r.collected AS DOUBLE) AS collected
    FROM (SELECT year, count(DISTINCT ada) AS n, sum(amount) AS eur, sum(amount) FILTER (validation = 'words_and_figures') AS spelled FROM v_grant_line
          WHERE grantor = 'foundation' AND recipient_entity = '7' AND family = 'foundation_statutory_grant' GROUP BY 1) g
    LEFT JOIN (SELECT year, collected FROM v_revenue_grant_year WHERE entity = '7' AND category = 'state_grants') r USING (year)""",
    lambda r: rp.statutory_vs_booked(r, "foundation", "foundation_statutory_grant", "state_grants"))
add("rp25_decision_counters", """SELECT count(*) AS n, count(pdf_sha256) AS n_docs, count(*) FILTER (family = 'ped_grant' OR read_status = 'absent') AS n_others, count(*) FILTER (family = 'kap_general') AS n_water
    FROM grant_decision WHERE grantor = 'foundation' AND duplicate_of IS NULL""", lambda r: rp.decision_counters(r, "foundation", ("ped_grant",), "kap_general"))
CELL = """CASE WHEN abs(d) < 0.005 THEN '=' WHEN a <> 0 AND s <> 0 AND abs(d / a - 0.0015) < 0.00002 THEN '≈0.15%' ELSE printf('%+.2f', d) END"""
add("rp26_reconciliation_matrix", "SELECT category, " + ", ".join(f'min(cell) FILTER (year = {y}) AS "{y}"' for y in range(1995, 2003)) + f"""
    FROM (SELECT category, year, {CELL} AS cell FROM (SELECT category, year, CAST(coalesce(net_paid, allocated) AS DOUBLE) AS a, CAST(coalesce(assessed, 0) AS DOUBLE) AS s,
    CAST(coalesce(net_paid, allocated) AS DOUBLE) - CAST(coalesce(assessed, 0) AS DOUBLE) AS d FROM v_grant_reconciliation WHERE category IS NOT NULL)) GROUP BY 1""", lambda r: rp.reconciliation_matrix(r, range(1995, 2003)))
MAIN = ("interior", "region", "foundation")
add("rp27_other_grantors", "SELECT grantor, count(*) AS n, count(pdf_sha256) AS n_docs FROM grant_decision WHERE grantor NOT IN ('interior', 'region', 'foundation') AND duplicate_of IS NULL GROUP BY 1",
    lambda r: rp.other_grantors(r, MAIN))
add("rp27_other_grantor_lines", """SELECT grantor, CAST(budget_year AS BIGINT) AS budget_year, recipient_entity, family, count(DISTINCT ada) AS n_decisions, CAST(sum(amount) AS DOUBLE) AS eur
    FROM v_grant_line WHERE grantor NOT IN ('interior', 'region', 'foundation') AND category IS NOT NULL GROUP BY 1, 2, 3, 4""", lambda r: rp.other_grantor_lines(r, MAIN))
add("rp28_subsidiaries_coverage", f"""SELECT s.entity, CAST(s.year AS BIGINT) AS year, CAST(s.paid AS DOUBLE) AS paid, CAST(coalesce(p.pub, 0) AS DOUBLE) AS published, CAST(coalesce(p.pub, 0) AS DOUBLE) / nullif(CAST(s.paid AS DOUBLE), 0) AS coverage
    FROM (SELECT entity, year, sum(paid_per_statement) AS paid FROM v_payment_coverage WHERE entity <> '7' GROUP BY 1, 2) s
    LEFT JOIN (SELECT entity, year, sum(amount) AS pub FROM payment WHERE {OK} AND amount IS NOT NULL GROUP BY 1, 2) p USING (entity, year)""", rp.subsidiaries_coverage)


def stepped(b) -> Release:
    """The release with dates cut to months and amounts to steps of 20,000, so that lines coincide."""
    lines = b.payment.withColumn("amount", (F.floor(c("amount") / 20000) * 20000).cast("decimal(18,2)")).withColumn("date", F.trunc("date", "month"))
    return Release(lambda name: lines if name == "payment" else getattr(b, name), home="7")


query("ag20_double_posted_lines", """SELECT entity, strftime(date_trunc('month', date), '%Y-%m-%d') AS date, kae, CAST(floor(amount / 20000) * 20000 AS DOUBLE) AS amount, counterparty_afm, count(DISTINCT source_ada) AS n_acts, count(*) AS n_lines FROM payment
    WHERE act_status = 'PUBLISHED' AND amount IS NOT NULL AND counterparty_afm IS NOT NULL GROUP BY ALL HAVING count(DISTINCT source_ada) > 1""")(lambda b: rp.double_posted_lines(stepped(b)))
add("ag20_same_day_payees", """SELECT entity, strftime(date, '%Y-%m-%d') AS date, counterparty_afm, count(DISTINCT source_ada) AS n_acts, count(*) AS n_lines FROM payment
    WHERE act_status = 'PUBLISHED' AND amount IS NOT NULL AND counterparty_afm IS NOT NULL GROUP BY ALL HAVING count(DISTINCT source_ada) > 1""",
    lambda r: rp.double_posted_lines(r, ["entity", "date", "counterparty_afm"]))

"""JN, AG, WN, TK, SO: the joins, aggregates, windows, rankings and set operations the views are
made of, each checked on its own."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.catalog.oracle import pick
from obolus.catalog.registry import query
from obolus.catalog.views import CODE, OK, SQL as V
from obolus.functions.codes import four_digit_code
from obolus.operators.shape import latest_per_key, lookup_left, top_k, without_nearby
from obolus.plans.views import EY, v_grant_line, v_payment, year_end_statements

c = F.col


# ---- joins -------------------------------------------------------------------------------------
@query("jn01_left_chain", pick("entity name year:i n:i lines:i", """(SELECT a.entity, e.name, a.year, a.n, p.lines FROM (SELECT entity, year, count(*) AS n FROM act GROUP BY 1, 2) a
    LEFT JOIN (SELECT entity, year, count(*) AS lines FROM payment WHERE is_payroll GROUP BY 1, 2) p USING (entity, year) LEFT JOIN entity e ON e.uid = a.entity)"""))
def _(b):
    a = b.act.groupBy(*EY).agg(F.count("*").alias("n"))
    p = b.payment.filter(c("is_payroll")).groupBy(*EY).agg(F.count("*").alias("lines"))
    return a.join(p, EY, "left").join(b.entity.select(c("uid").alias("entity"), "name"), "entity", "left").select("entity", "name", "year", "n", "lines")


@query("jn02_statement_pick", pick("entity statement_ada", "picked"), V)
def _(b):
    return year_end_statements(b.release)


@query("jn03_left_coverage", pick("ada n:i eur:m", "(SELECT a.ada, coalesce(p.n, 0) AS n, coalesce(p.eur, 0) AS eur FROM act a LEFT JOIN (SELECT source_ada, count(*) AS n, sum(amount) AS eur FROM payment GROUP BY 1) p ON p.source_ada = a.ada)"))
def _(b):
    p = b.payment.groupBy(c("source_ada").alias("ada")).agg(F.count("*").alias("n"), F.sum("amount").alias("eur"))
    return b.act.select("ada").join(p, "ada", "left").select("ada", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("eur", F.lit(0)).alias("eur"))


# part keys of two sides with nulls on both: nulls match nothing and stay on both sides
@query("jn04_full_outer_null_keys", pick("k a:i z:i", """(SELECT coalesce(x.k, y.k) AS k, x.a, y.z FROM (SELECT counterparty_afm AS k, count(*) AS a FROM payment WHERE act_status = 'PUBLISHED' GROUP BY 1) x
    FULL JOIN (SELECT afm AS k, count(*) AS z FROM procurement_party WHERE NOT cancelled GROUP BY 1) y ON x.k = y.k)"""))
def _(b):
    x = b.payment.filter(c("act_status") == "PUBLISHED").groupBy(c("counterparty_afm").alias("k")).agg(F.count("*").alias("a")).alias("x")
    y = b.procurement_party.filter(~c("cancelled")).groupBy(c("afm").alias("k")).agg(F.count("*").alias("z")).alias("y")
    return x.join(y, c("x.k") == c("y.k"), "full").select(F.coalesce("x.k", "y.k").alias("k"), "a", "z")


@query("jn05_semi_restrict", pick("source_ada line_no:i amount:m", "payment", "WHERE (entity, year) IN (SELECT (entity, year) FROM v_budget_year)"), V)
def _(b):
    years = b.release.view("v_budget_year").select(*EY).distinct()
    return b.payment.join(years, EY, "left_semi").select("source_ada", "line_no", "amount")


MONTHS = "SELECT entity, period_year AS year, side, kae, period_month AS month, collected_or_paid AS v FROM budget_first"


@query("jn06_theta_grid", pick("entity year:i side kae month:i", f"""(WITH m AS ({MONTHS}) SELECT k.entity, k.year, k.side, k.kae, s.month FROM (SELECT entity, year, side, kae, min(month) AS f FROM m GROUP BY 1, 2, 3, 4) k
    JOIN (SELECT DISTINCT entity, year, side, month FROM m) s ON s.entity = k.entity AND s.year = k.year AND s.side = k.side AND s.month >= k.f)"""))
def _(b):
    m = b.budget_line.select("entity", c("period_year").alias("year"), "side", "kae", c("period_month").alias("month"))
    k = m.groupBy("entity", "year", "side", "kae").agg(F.min("month").alias("first"))
    return k.join(m.select("entity", "year", "side", "month").distinct(), ["entity", "year", "side"]).filter(c("month") >= c("first")).drop("first")


@query("jn07_gap_fill", "SELECT absent, count(*) AS n, CAST(sum(collected_to_date) AS DOUBLE) AS v FROM v_budget_month GROUP BY 1", V)
def _(b):
    return b.release.view("v_budget_month").groupBy("absent").agg(F.count("*").alias("n"), F.sum("collected_to_date").alias("v"))


@query("jn08_interval_anti_join", pick("o_orderkey:i", """orders o WHERE NOT EXISTS (SELECT 1 FROM (SELECT o_custkey, CAST(l_shipdate AS DATE) AS d FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag <> 'A') s
    WHERE s.o_custkey = o.o_custkey AND s.d BETWEEN CAST(o.o_orderdate AS DATE) - INTERVAL 60 DAY AND CAST(o.o_orderdate AS DATE) + INTERVAL 60 DAY)"""))
def _(b):
    orders = b.star.orders.select("o_orderkey", "o_custkey", c("o_orderdate").cast("date").alias("day"))
    shipped = (b.star.lineitem.filter(c("l_returnflag") != "A").select(c("l_orderkey").alias("o_orderkey"), c("l_shipdate").cast("date").alias("shipped"))
               .join(orders.select("o_orderkey", "o_custkey"), "o_orderkey"))
    return without_nearby(orders, shipped, ["o_custkey"], "shipped", "day", fv.NEARBY_DAYS).select("o_orderkey")


@query("jn09_flag_join", pick("ref afm family", "(SELECT ref, afm, coalesce(afm IN (SELECT afm FROM entity WHERE afm IS NOT NULL), false) AS family FROM procurement_party)"))
def _(b):
    family = b.entity.filter(c("afm").isNotNull()).select("afm").distinct().withColumn("f", F.lit(True))
    return lookup_left(b.procurement_party.select("ref", "afm"), family, "afm", "ref").select("ref", "afm", F.coalesce("f", F.lit(False)).alias("family"))


@query("jn10_until_last_day", "SELECT CAST(g.year AS BIGINT) AS year, count(*) AS n, CAST(sum(l.amount) AS DOUBLE) AS eur FROM v_grant_line l JOIN home_last g ON l.budget_year = g.year AND l.date <= last_day(make_date(g.year, g.month, 1)) GROUP BY 1", V)
def _(b):
    months = b.release.view("v_revenue_grant_month").filter(c("entity") == b.release.home)
    last = months.groupBy(c("year").alias("y")).agg(F.max("month").alias("m"))
    lines = v_grant_line(b.release)
    until = F.last_day(F.make_date("y", "m", F.lit(1)))
    return lines.join(last, (c("budget_year") == c("y")) & (c("date") <= until)).groupBy(c("y").alias("year")).agg(F.count("*").alias("n"), F.sum("amount").alias("eur"))


@query("jn11_lookup", pick("source_ada line_no:i subject", "(SELECT p.source_ada, p.line_no, a.subject FROM payment p JOIN act a ON a.ada = p.source_ada WHERE p.amount_suspect)"))
def _(b):
    return b.payment.filter(c("amount_suspect")).join(b.act.select(c("ada").alias("source_ada"), "subject"), "source_ada").select("source_ada", "line_no", "subject")


@query("jn12_detail_join", "SELECT validation, family, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS eur FROM v_grant_line GROUP BY 1, 2", V)
def _(b):
    return v_grant_line(b.release).groupBy("validation", "family").agg(F.count("*").alias("n"), F.sum("amount").alias("eur"))


@query("jn15_anchor_semi", pick("ada anchored", "(SELECT ada, len(list_intersect(found_by, ['999000111', '58000'])) > 0 AS anchored FROM grant_decision)"))
def _(b):
    anchors = F.array(F.lit("999000111"), F.lit("58000"))
    return b.grant_decision.select("ada", F.arrays_overlap("found_by", anchors).alias("anchored"))


@query("jn16_document_left_text", pick("ada has_text read_status", "(SELECT d.ada, t.doc_id IS NOT NULL AS has_text, CASE WHEN t.doc_id IS NULL THEN 'no_pdf' ELSE 'read' END AS read_status FROM decisions d LEFT JOIN documents t ON t.doc_id = d.o_custkey)"))
def _(b):
    stored = b.star.documents.select(c("doc_id").alias("o_custkey"), F.lit(True).alias("t"))
    return b.decisions.select("ada", "o_custkey").join(stored, "o_custkey", "left").select(
        "ada", c("t").isNotNull().alias("has_text"), F.when(c("t").isNull(), F.lit("no_pdf")).otherwise(F.lit("read")).alias("read_status"))


# ---- aggregates ----------------------------------------------------------------------------------
@query("ag01_lines_docs_sum", pick("entity year:i payee_class n_lines:i n_acts:i eur:m", "v_payee_class_year"), V)
def _(b):
    return b.release.view("v_payee_class_year")


@query("ag02_conditional_measures", """SELECT entity, CAST(year AS BIGINT) AS year, count(DISTINCT source_ada) FILTER (NOT is_payroll) AS n_acts, count(DISTINCT counterparty_afm) FILTER (payee_class = 'supplier') AS n_suppliers,
    CAST(sum(amount) FILTER (is_payroll) AS DOUBLE) AS payroll FROM payment GROUP BY 1, 2""")
def _(b):
    docs = b.payment.groupBy(*EY, "source_ada").agg(F.max(F.when(~c("is_payroll"), 1).otherwise(0)).alias("x"), F.sum(F.when(c("is_payroll"), c("amount"))).alias("p"))
    docs = docs.groupBy(*EY).agg(F.sum("x").alias("n_acts"), F.sum("p").alias("payroll"))
    sup = (b.payment.filter((c("payee_class") == "supplier") & c("counterparty_afm").isNotNull()).select(*EY, "counterparty_afm").distinct()
           .groupBy(*EY).agg(F.count("*").alias("n_suppliers")))
    return docs.join(sup, EY, "left").select(*EY, "n_acts", F.coalesce("n_suppliers", F.lit(0)).alias("n_suppliers"), "payroll")


@query("ag03_dedupe_then_sum", """SELECT entity, CAST(year AS BIGINT) AS year, count(DISTINCT source_ada) AS n, CAST(sum(amount) AS DOUBLE) AS eur FROM (SELECT DISTINCT source_ada, entity, year, amount FROM award) GROUP BY 1, 2""")
def _(b):
    return (b.award.select("source_ada", *EY, "amount").distinct().groupBy(*EY, "source_ada").agg(F.sum("amount").alias("a"))
            .groupBy(*EY).agg(F.count("*").alias("n"), F.sum("a").alias("eur")))


@query("ag07_arg_max", """SELECT entity, arg_max(source_ada, (amount, source_ada)) AS largest_ada, CAST(max(amount) AS DOUBLE) AS largest_amount FROM payment WHERE amount IS NOT NULL GROUP BY 1""")
def _(b):
    return (b.payment.filter(c("amount").isNotNull()).groupBy("entity")
            .agg(F.max_by("source_ada", F.struct("amount", "source_ada")).alias("largest_ada"), F.max("amount").alias("largest_amount")))


@query("ag08_ordered_string_agg", "SELECT entity, CAST(year AS BIGINT) AS year, category, kae_lines FROM v_revenue_grant_year", V)
def _(b):
    return b.release.view("v_revenue_grant_year").select(*EY, "category", "kae_lines")


@query("ag09_distinct_string_agg", "SELECT side, string_agg(DISTINCT kae, ', ' ORDER BY kae) AS kaes FROM budget_line GROUP BY 1")
def _(b):
    codes = b.budget_line.select("side", "kae").distinct()  # a chart's codes: bounded by the chart
    return codes.groupBy("side").agg(F.array_join(F.array_sort(F.collect_list("kae")), ", ").alias("kaes"))


@query("ag10_filtered_aggregates", "SELECT entity, count(*) FILTER (kind = 'acceptance') AS a, CAST(sum(amount_stated) FILTER (kind <> 'acceptance') AS DOUBLE) AS o FROM acceptance GROUP BY 1")
def _(b):
    return b.acceptance.groupBy("entity").agg(F.count_if(c("kind") == "acceptance").alias("a"), F.sum(F.when(c("kind") != "acceptance", c("amount_stated"))).alias("o"))


@query("ag11_sum_of_distinct", "SELECT grantor, CAST(sum(DISTINCT amount_stated) AS DOUBLE) AS eur FROM acceptance GROUP BY 1")
def _(b):
    return b.acceptance.select("grantor", "amount_stated").distinct().groupBy("grantor").agg(F.sum("amount_stated").alias("eur"))


@query("ag12_bool_and", "SELECT counterparty_afm, bool_and(act_status = 'PUBLISHED') AS all_published, bool_or(amount_suspect) AS any_suspect FROM payment GROUP BY 1")
def _(b):
    return b.payment.groupBy("counterparty_afm").agg(F.bool_and(c("act_status") == "PUBLISHED").alias("all_published"), F.bool_or("amount_suspect").alias("any_suspect"))


@query("ag13_last_known_attribute", "SELECT entity, side, CAST(period_year AS BIGINT) AS year, kae, arg_max(description, (period_month, description)) AS description, CAST(min(period_month) AS BIGINT) AS first_month FROM budget_first GROUP BY 1, 2, 3, 4")
def _(b):
    return b.budget_line.groupBy("entity", "side", c("period_year").alias("year"), "kae").agg(
        F.max_by("description", F.struct("period_month", "description")).alias("description"), F.min("period_month").alias("first_month"))


@query("ag19_build_tallies", """SELECT 'payee_class' AS tally, payee_class AS key, count(*) AS n FROM payment GROUP BY 2 UNION ALL SELECT 'validation', coalesce(validation, 'none'), count(*) FROM grant_line GROUP BY 2
    UNION ALL SELECT 'endpoint', endpoint, count(*) FROM procurement GROUP BY 2 UNION ALL SELECT 'role', role, count(*) FROM procurement_party GROUP BY 2""")
def _(b):
    tally = lambda df, name, key: df.groupBy(key.alias("key")).agg(F.count("*").alias("n")).select(F.lit(name).alias("tally"), "key", "n")
    return (tally(b.payment, "payee_class", c("payee_class")).unionByName(tally(b.grant_line, "validation", F.coalesce("validation", F.lit("none"))))
            .unionByName(tally(b.procurement, "endpoint", c("endpoint"))).unionByName(tally(b.procurement_party, "role", c("role"))))


# ---- windows ---------------------------------------------------------------------------------------
TOTALS = f"SELECT entity, year, counterparty_afm, sum(amount) AS eur FROM payment WHERE {OK} AND counterparty_afm IS NOT NULL GROUP BY 1, 2, 3"


@query("wn01_top_n_per_group", pick("entity year:i counterparty_afm eur:m rk:i", f"(SELECT *, row_number() OVER (PARTITION BY entity, year ORDER BY eur DESC NULLS LAST, counterparty_afm) AS rk FROM ({TOTALS}) QUALIFY rk <= 10)"))
def _(b):
    t = b.release.counted.filter(c("counterparty_afm").isNotNull()).groupBy(*EY, "counterparty_afm").agg(F.sum("amount").alias("eur"))
    return top_k(t, EY, [c("eur").desc_nulls_last(), c("counterparty_afm")], 10)


@query("wn02_share_of_total", pick("entity year:i counterparty_afm share:m", f"(SELECT entity, year, counterparty_afm, CAST(eur AS DOUBLE) / CAST(sum(eur) OVER (PARTITION BY entity, year) AS DOUBLE) AS share FROM ({TOTALS}))"))
def _(b):
    t = b.release.counted.filter(c("counterparty_afm").isNotNull()).groupBy(*EY, "counterparty_afm").agg(F.sum("amount").alias("eur"))
    whole = t.groupBy(*EY).agg(F.sum("eur").alias("total"))  # joined back, so no group is gathered for a window
    return t.join(whole, EY).select(*EY, "counterparty_afm", (c("eur").cast("double") / c("total").cast("double")).alias("share"))


@query("wn03_latest_per_key", pick("o_custkey:i ada date:d price:m", "(SELECT * FROM decisions QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY date DESC, ada) = 1)"))
def _(b):
    d = b.decisions.select("o_custkey", "ada", "date", "price")
    return latest_per_key(d, ["o_custkey"], F.struct(-F.unix_date("date"), "ada"), largest=False)


LAG = """(SELECT entity, period_year AS year, side, kae, period_month AS month, collected_or_paid - coalesce(lag(collected_or_paid) OVER w, 0) AS delta, period_month - coalesce(lag(period_month) OVER w, 0) AS months
    FROM budget_first WINDOW w AS (PARTITION BY entity, period_year, side, kae ORDER BY period_month))"""


@query("wn04_lag_delta", pick("entity year:i side kae month:i delta:m", LAG))
def _(b):
    w = Window.partitionBy("entity", "year", "side", "kae").orderBy("month")  # twelve rows at most
    s = b.budget_line.filter(~c("statement_ada").endswith("b")).select("entity", c("period_year").alias("year"), "side", "kae", c("period_month").alias("month"), "collected_or_paid")
    return s.withColumn("delta", c("collected_or_paid") - F.coalesce(F.lag("collected_or_paid").over(w), F.lit(0))).drop("collected_or_paid")


@query("wn05_lag_gap", pick("entity year:i side kae month:i months:i", LAG))
def _(b):
    w = Window.partitionBy("entity", "year", "side", "kae").orderBy("month")
    s = b.budget_line.filter(~c("statement_ada").endswith("b")).select("entity", c("period_year").alias("year"), "side", "kae", c("period_month").alias("month"))
    return s.withColumn("months", c("month") - F.coalesce(F.lag("month").over(w), F.lit(0)))


@query("wn07_share_inside_record", pick("ref:i afm:i share:m", """(SELECT l_orderkey AS ref, l_suppkey AS afm, CAST(net AS DOUBLE) / nullif(CAST(sum(net) OVER (PARTITION BY l_orderkey) AS DOUBLE), 0) AS share
    FROM (SELECT l_orderkey, l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS net FROM lineitem GROUP BY 1, 2))"""))
def _(b):
    net = b.star.lineitem.groupBy(c("l_orderkey").alias("ref"), c("l_suppkey").alias("afm")).agg(F.sum(c("l_extendedprice").cast("decimal(18,2)")).alias("net"))
    whole = net.groupBy("ref").agg(F.sum("net").alias("total"))
    return net.join(whole, "ref").select("ref", "afm", F.try_divide(c("net").cast("double"), c("total").cast("double")).alias("share"))


@query("wn09_section_ids", """SELECT doc_id, CAST(line AS BIGINT) AS line, CAST(sum(CASE WHEN length(content) < 60 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) AS BIGINT) AS section
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS content, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents)""")
def _(b):
    from obolus.plans.documents import running_sections
    lines = b.star.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "content")).withColumn("line", c("p") + 1)
    return running_sections(lines, ["doc_id"], ["line"], F.length("content") < 60).select("doc_id", "line", "section")


# ---- rankings and set operations ---------------------------------------------------------------------
@query("tk01_ordered_view", pick("year:i type status n:i", "v_type_year", "ORDER BY year, type, status"), V)
def _(b):
    return b.release.view("v_type_year").orderBy("year", "type", "status")


@query("tk02_global_top_k", pick("source_ada line_no:i amount:m", "(SELECT * FROM payment WHERE amount IS NOT NULL ORDER BY amount DESC, source_ada, line_no LIMIT 15)"))
def _(b):
    return v_all(b).orderBy(c("amount").desc(), "source_ada", "line_no").limit(15)


def v_all(b):
    return b.payment.filter(c("amount").isNotNull()).select("source_ada", "line_no", "amount")


@query("tk03_nulls_last", "SELECT payee_class, CAST(sum(amount) FILTER (payee_class <> 'tax') AS DOUBLE) AS eur FROM payment GROUP BY 1 ORDER BY sum(amount) FILTER (payee_class <> 'tax') DESC NULLS LAST LIMIT 4")
def _(b):
    return (b.payment.groupBy("payee_class").agg(F.sum(F.when(c("payee_class") != "tax", c("amount"))).alias("eur"))
            .orderBy(c("eur").desc_nulls_last()).limit(4))


@query("tk04_top_k_share", pick("entity year:i n_suppliers:i supplier_eur:m top10_share:m top1_share:m", "v_counterparty_year"), V)
def _(b):
    return b.release.view("v_counterparty_year")


@query("so01_union_sources", "SELECT source, payee_class, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS eur FROM v_payment_combined GROUP BY 1, 2", V)
def _(b):
    return b.release.view("v_payment_combined").groupBy("source", "payee_class").agg(F.count("*").alias("n"), F.sum("amount").alias("eur"))


@query("so02_distinct", "SELECT DISTINCT entity, statement_ada, strftime(period_end, '%Y-%m-%d') AS period_end FROM budget_line")
def _(b):
    return b.budget_line.select("entity", "statement_ada", "period_end").distinct()


@query("so03_array_algebra", """SELECT ada, array_to_string(list_sort(list_filter(found_by, lambda x: x <> '58000')), '|') AS without, array_to_string(list_sort(list_intersect(found_by, ['58000', 'ΝΗΣΙΔΟΣ'])), '|') AS common,
    array_to_string(list_sort(list_distinct(found_by || ['58000'])), '|') AS together FROM grant_decision""")
def _(b):
    one = F.array(F.lit("58000"))
    return b.grant_decision.select("ada", F.array_sort(F.array_except("found_by", one)).alias("without"),
                                   F.array_sort(F.array_intersect("found_by", F.array(F.lit("58000"), F.lit("ΝΗΣΙΔΟΣ")))).alias("common"),
                                   F.array_sort(F.array_union("found_by", one)).alias("together"))


@query("v17_code_groups", f"SELECT {CODE} AS code, count(*) AS n FROM payment GROUP BY 1")
def _(b):
    return b.payment.groupBy(four_digit_code(c("kae")).alias("code")).agg(F.count("*").alias("n"))


@query("jn08_payment_floor", pick("ref afm amount:m", "v_payment_combined", "WHERE source = 'procurement'"), V)
def _(b):
    own = v_payment(b.release).filter(c("amount").isNotNull()).select("entity", "date", c("counterparty_afm").alias("afm"))
    paid = b.procurement_party.filter((c("role") == "payee") & ~c("cancelled") & c("amount_with_vat").isNotNull())
    return without_nearby(paid, own, ["entity", "afm"], "date", "submission_date", fv.NEARBY_DAYS).select("ref", "afm", c("amount_with_vat").alias("amount"))

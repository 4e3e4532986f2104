"""DQ1-DQ7 and PV1-PV7."""

from __future__ import annotations

from pyspark.sql import functions as F

from obolus.catalog.functions import sql_norm
from obolus.catalog.oracle import pick
from obolus.catalog.registry import query
from obolus.operators import dedupe as dq
from obolus.operators import privacy as pv
from obolus.session import written

c = F.col

# decisions posted per customer, issuer and month, so that postings coincide; amounts in steps
POSTED = {"posted": """SELECT ada, entity AS issuer, CAST(o_custkey AS VARCHAR) AS protocol_number, date_trunc('year', date) AS date, o_orderpriority AS subject, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS n_amounts,
    lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS submission_ts, CAST(floor(price / 100000) AS BIGINT) AS step FROM decisions""",
    "same": """SELECT ada, first(ada) OVER w AS keep, count(*) OVER (PARTITION BY issuer, protocol_number, date, subject) AS n FROM posted WINDOW w AS (PARTITION BY issuer, protocol_number, date, subject ORDER BY n_amounts = 0, submission_ts, ada)""",
    "retyped": """SELECT ada, first(ada) OVER w AS keep, count(*) OVER g AS n, (min(subject) OVER g) <> (max(subject) OVER g) AS differ FROM posted
        WINDOW w AS (PARTITION BY issuer, protocol_number, date, step ORDER BY n_amounts = 0, submission_ts, ada), g AS (PARTITION BY issuer, protocol_number, date, step)"""}


def posted(b):
    return b.decisions.select("ada", c("entity").alias("issuer"), c("o_custkey").cast("string").alias("protocol_number"), F.trunc("date", "year").alias("date"), c("o_orderpriority").alias("subject"),
                              F.when(c("o_orderstatus") == "F", 0).otherwise(1).alias("n_amounts"), F.lpad(c("o_orderkey").cast("string"), 12, "0").alias("submission_ts"), F.floor(c("price") / 100000).alias("step"))


def steps(b):
    return b.decisions.select("ada", F.lit(0).alias("line_no"), F.lit("7").alias("recipient_entity"), F.floor(c("price") / 100000).alias("amount"),
                              F.when(c("o_orderstatus") != "P", F.lit("words_and_figures")).alias("validation"))


@query("dq01_same_posting", "SELECT ada, keep AS duplicate_of FROM same WHERE n > 1 AND ada <> keep", POSTED)
def _(b):
    from obolus.functions.text import fold
    return dq._kept_by_group(posted(b).withColumn("s", fold(c("subject"))), ["issuer", "protocol_number", "date", "s"])


@query("dq02_retyped_posting", """SELECT s.ada, CASE WHEN r.n > 1 AND r.differ AND r.ada <> r.keep THEN r.keep WHEN s.n > 1 AND s.ada <> s.keep THEN s.keep END AS duplicate_of FROM same s JOIN retyped r USING (ada)""", POSTED)
def _(b):
    return dq.mark_duplicate_postings(posted(b), dq.document_amounts(steps(b))).select("ada", "duplicate_of")


# every decision cites its customer's first one; urgent ones pay the high-priority ones they cite
CITES = {"first_of": "SELECT o_custkey, min(ada) AS cited FROM decisions GROUP BY 1", "cites": "SELECT d.ada, f.cited FROM decisions d JOIN first_of f USING (o_custkey)",
         "fam": "SELECT ada, entity AS issuer, o_orderpriority AS family, date FROM decisions"}
ISSUERS = tuple(str(i) for i in range(25))
PAYS = [("1-URGENT", ("2-HIGH", "3-MEDIUM"), ISSUERS), ("5-LOW", ("2-HIGH", "4-NOT SPECIFIED"), ISSUERS)]


def cites(b):
    first = b.decisions.groupBy("o_custkey").agg(F.min("ada").alias("cited"))
    return b.decisions.select("ada", "o_custkey").join(first, "o_custkey").select("ada", "cited")


def families(b):
    return b.decisions.select("ada", c("entity").alias("issuer"), c("o_orderpriority").alias("family"), "date", F.lit(None).cast("string").alias("duplicate_of"))


@query("dq03_paid_by_citation", """SELECT d.ada, arg_min(p.ada, (CASE WHEN p.family = '1-URGENT' THEN 0 ELSE 1 END, p.date, p.ada)) AS paid_by FROM cites k JOIN fam p ON p.ada = k.ada JOIN fam d ON d.ada = k.cited AND d.issuer = p.issuer AND d.ada <> p.ada
    WHERE (p.family = '1-URGENT' AND d.family IN ('2-HIGH', '3-MEDIUM')) OR (p.family = '5-LOW' AND d.family IN ('2-HIGH', '4-NOT SPECIFIED')) GROUP BY 1""", CITES)
def _(b):
    return dq.paid_by_citation(families(b), cites(b), PAYS)


@query("dq03_replaced_by_citation", "SELECT d.ada, min(p.ada) AS paid_by FROM cites k JOIN fam p ON p.ada = k.ada JOIN fam d ON d.ada = k.cited WHERE p.issuer = '7' AND d.issuer = '7' AND d.family = '2-HIGH' AND d.date < p.date GROUP BY 1", CITES)
def _(b):
    return dq.replaced_by_citation(families(b), cites(b), "7", "2-HIGH")


def served(grants: str, payments: str) -> dict[str, str]:
    """First come, first served, as SQL: the payments of a group in order, each with how many of its
    grants are too old (lo) and how many not too young (hi); what is used up so far walks along."""
    return {
        "waiting": f"SELECT ada, grp, date, row_number() OVER (PARTITION BY grp ORDER BY date, ada) AS i FROM ({grants})",
        "paying": f"SELECT ada, grp, date, row_number() OVER (PARTITION BY grp ORDER BY date, ada) AS k FROM ({payments})",
        "reach": "SELECT p.grp, p.k, any_value(p.ada) AS ada, count(*) FILTER (p.date - w.date > 366) AS lo, count(*) FILTER (w.date <= p.date) AS hi FROM paying p LEFT JOIN waiting w USING (grp) GROUP BY 1, 2",
        "walk": """WITH RECURSIVE step(grp, k, used, hit) AS (SELECT DISTINCT grp, CAST(0 AS BIGINT), CAST(0 AS BIGINT), false FROM reach
            UNION ALL SELECT s.grp, r.k, greatest(s.used, r.lo) + CAST(greatest(s.used, r.lo) < r.hi AS BIGINT), greatest(s.used, r.lo) < r.hi FROM step s JOIN reach r ON r.grp = s.grp AND r.k = s.k + 1)
            SELECT * FROM step""",
        "paired": "SELECT w.ada, r.ada AS paid_by FROM walk JOIN reach r USING (grp, k) JOIN waiting w ON w.grp = walk.grp AND w.i = walk.used WHERE hit"}


STEP = "CAST(CAST(floor(price / 100000) AS BIGINT) AS VARCHAR)"


@query("dq04_greedy_pairing", "SELECT ada, paid_by FROM paired", served(*(f"SELECT ada, date, entity || '/' || {STEP} AS grp FROM decisions WHERE o_orderpriority = '{x}'" for x in ("1-URGENT", "5-LOW"))))
def _(b):
    d = b.decisions.select("ada", c("entity").alias("issuer"), "date", F.floor(c("price") / 100000).cast("string").alias("amounts"), "o_orderpriority")
    return dq.pair_in_time(d.filter(c("o_orderpriority") == "1-URGENT"), d.filter(c("o_orderpriority") == "5-LOW"), ["issuer", "amounts"])


PAID = {**CITES, "cited": """SELECT d.ada, arg_min(p.ada, (CASE WHEN p.family = '1-URGENT' THEN 0 ELSE 1 END, p.date, p.ada)) AS paid_by FROM cites k JOIN fam p ON p.ada = k.ada JOIN fam d ON d.ada = k.cited AND d.issuer = p.issuer AND d.ada <> p.ada
    WHERE (p.family = '1-URGENT' AND d.family IN ('2-HIGH', '3-MEDIUM')) OR (p.family = '5-LOW' AND d.family IN ('2-HIGH', '4-NOT SPECIFIED')) GROUP BY 1""",
    "replaced": """SELECT d.ada, min(p.ada) AS paid_by FROM cites k JOIN fam p ON p.ada = k.ada JOIN fam d ON d.ada = k.cited
    WHERE p.issuer = '7' AND d.issuer = '7' AND d.family = '2-HIGH' AND d.date < p.date AND d.ada NOT IN (SELECT ada FROM cited) GROUP BY 1""",
    "known": "SELECT * FROM cited UNION ALL SELECT * FROM replaced",
    "open_ones": f"SELECT ada, date, o_orderpriority AS family, CASE WHEN o_orderstatus <> 'P' THEN {STEP} ELSE '' END AS grp FROM decisions WHERE entity = '7'",
    **served("SELECT ada, grp, date FROM open_ones WHERE family = '2-HIGH' AND ada NOT IN (SELECT ada FROM known)", "SELECT ada, grp, date FROM open_ones WHERE family = '5-LOW' AND ada NOT IN (SELECT paid_by FROM known)")}


@query("dq04_mark_paid_through", "SELECT f.ada, f.issuer, f.family, coalesce(k.paid_by, x.paid_by) AS paid_by FROM fam f LEFT JOIN known k USING (ada) LEFT JOIN paired x USING (ada)", PAID)
def _(b):
    return dq.mark_paid_through(families(b), dq.validated_amounts(steps(b)), cites(b), PAYS, "7", "2-HIGH", "5-LOW").select("ada", "issuer", "family", "paid_by")


@query("dq05_suppress_counted", """SELECT g.ada, CASE WHEN p.paid_by IS NULL THEN g.category END AS category, CASE WHEN p.paid_by IS NOT NULL THEN g.validation || '; counted at ' || p.paid_by ELSE g.validation END AS detail, CAST(g.amount AS DOUBLE) AS amount
    FROM (SELECT * REPLACE (coalesce(validation, 'none') AS validation) FROM grant_line) g LEFT JOIN paid p USING (ada)""",
       {**CITES, "paid": "SELECT d.ada, min(p.ada) AS paid_by FROM cites k JOIN fam p ON p.ada = k.ada JOIN fam d ON d.ada = k.cited WHERE p.issuer = '7' AND d.issuer = '7' AND d.family = '2-HIGH' AND d.date < p.date GROUP BY 1"})
def _(b):
    lines = b.grant_line.withColumn("detail", F.coalesce("validation", F.lit("none")))
    return dq.suppress_counted(lines, dq.replaced_by_citation(families(b), cites(b), "7", "2-HIGH")).select("ada", "category", "detail", "amount")


@query("dq06_duplicate_integrity", """SELECT doc, duplicate_of, why FROM (SELECT c_custkey AS doc, c_nationkey AS duplicate_of FROM customer) d JOIN (VALUES ('document not held'), ('kept document not held'), ('kept document is a duplicate')) w(why)
    ON (why = 'document not held' AND doc NOT IN (SELECT s_suppkey FROM supplier)) OR (why = 'kept document not held' AND duplicate_of NOT IN (SELECT s_suppkey FROM supplier)) OR (why = 'kept document is a duplicate' AND duplicate_of IN (SELECT c_custkey FROM customer))""")
def _(b):
    dup = b.star.customer.select(c("c_custkey").alias("doc"), c("c_nationkey").cast("bigint").alias("duplicate_of"))
    return dq.check_duplicates(dup, b.star.supplier.select(c("s_suppkey").alias("ada")))


@query("dq07_own_project", "SELECT ada, family = 'region_credit' AND NOT (len(found_by) > 1 OR regexp_matches(subject, 'BUILDING')) AS own FROM grant_decision")
def _(b):
    return b.grant_decision.select("ada", dq.own_project(c("family"), F.size("found_by") > 1, c("subject"), "U.LD").alias("own"))


# ---- privacy: any two words of a turn that stand side by side name a person, any line of a benchmark item a legal body ----
TOKENS = "list_filter(string_split(translate({0}, 'ABEZHIKMNOPTXY', 'ΑΒΕΖΗΙΚΜΝΟΡΤΧΥ'), ' '), lambda t: t <> '')"


def sql_tokens(x: str) -> str:
    return TOKENS.replace("{0}", sql_norm(x))


PRIVACY = {
    "turn_words": "SELECT string_split(line, ' ') AS ws FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM conversations)",
    "signed": "SELECT DISTINCT ws[i] || ',,' || ws[i + 1] AS name FROM turn_words, range(1, len(ws)) r(i)",
    "titled": f"SELECT DISTINCT name FROM (SELECT unnest(string_split(text, chr(10))) AS name FROM benchmark)",
    "people": f"SELECT DISTINCT {sql_tokens('name')} AS t FROM signed",
    "keys": "SELECT DISTINCT unnest([t[1] || ' ' || t[2], t[2] || ' ' || t[1]]) AS name_key FROM (SELECT list_filter(t, lambda x: length(x) >= 3 AND x NOT IN ('ΚΑΙ', 'ΤΟΥ', 'ΤΗΣ')) AS t FROM people) WHERE len(t) >= 2",
    "legal": f"SELECT DISTINCT {sql_tokens('name')} AS n FROM titled WHERE len({sql_tokens('name')}) >= 3",
    "corpus": """SELECT 'd' || doc_id AS path, text FROM documents UNION ALL SELECT 'b' || item_id, text FROM benchmark
        UNION ALL SELECT 'p' || page_id, html FROM pages UNION ALL SELECT 'c' || conv_id || '/' || turn, text FROM conversations""",
    "corpus_lines": "SELECT path, unnest(string_split(text, chr(10))) AS content, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM corpus",
    "toks": f"SELECT path, line, {sql_tokens('content')} AS t FROM corpus_lines",
    "pairs": "SELECT path, line, j, t[j] || ' ' || t[j + 1] AS name_key FROM (SELECT *, unnest(generate_series(1, len(t) - 1)) AS j FROM toks WHERE len(t) >= 2)",
    "name_hits": "SELECT * FROM pairs WHERE name_key IN (SELECT name_key FROM keys)",
    "starts": "SELECT path, line, t, i FROM (SELECT *, unnest(generate_series(1, len(t) - 2)) AS i FROM toks WHERE len(t) >= 3)",
    "ranges": "SELECT DISTINCT path, line, i, i + k - 1 AS z FROM (SELECT s.*, n.n, unnest(generate_series(3, len(n.n))) AS k FROM starts s JOIN legal n ON n.n[1] = s.t[s.i] AND n.n[2] = s.t[s.i + 1] AND n.n[3] = s.t[s.i + 2]) WHERE t[i:i + k - 1] = n[1:k]",
    "leaks": """SELECT path, line, name_key FROM name_hits h WHERE NOT (EXISTS (SELECT 1 FROM ranges r WHERE r.path = h.path AND r.line = h.line AND h.j BETWEEN r.i AND r.z)
        AND EXISTS (SELECT 1 FROM ranges r WHERE r.path = h.path AND r.line = h.line AND h.j + 1 BETWEEN r.i AND r.z))""",
}


def people(b):
    lines = lambda df: df.select(F.explode(F.split("text", "\n")).alias("name"))
    words = lines(b.star.conversations).select(F.split("name", " ").alias("ws")).filter(F.size("ws") > 1)
    pairs = words.select(F.explode(F.transform(F.sequence(F.lit(0), F.size("ws") - 2), lambda i: F.concat(F.get("ws", i), F.lit(",,"), F.get("ws", i + 1)))).alias("name"))
    of = lambda df, afm: df.distinct().select(F.lit(afm).alias("afm"), F.lit("EL").alias("afm_type"), "name")
    return written(of(pairs, "123456789").unionByName(of(lines(b.star.benchmark), "999999999")))


def corpus(b):
    """Every text that is published: documents, benchmark items, pages, turns."""
    s = b.star
    return (s.documents.select(F.concat(F.lit("d"), "doc_id").alias("path"), "text").unionByName(s.benchmark.select(F.concat(F.lit("b"), "item_id").alias("path"), "text"))
            .unionByName(s.pages.select(F.concat(F.lit("p"), "page_id").alias("path"), c("html").alias("text")))
            .unionByName(s.conversations.select(F.concat(F.lit("c"), "conv_id", F.lit("/"), "turn").alias("path"), "text")))


@query("pv01_name_keys", "SELECT name_key FROM keys", PRIVACY)
def _(b):
    return pv.person_markers(people(b))[0]


@query("pv01_legal_names", "SELECT array_to_string(n, ' ') AS name FROM legal", PRIVACY)
def _(b):
    return pv.person_markers(people(b))[2].select(F.array_join("legal", " ").alias("name"))


@query("pv02_name_leaks", pick("path line:i kind match", "(SELECT path, line, 'name' AS kind, name_key AS match FROM leaks)"), PRIVACY)
def _(b):
    keys, _, legal = pv.person_markers(people(b))
    return pv.find_name_leaks(pv.lines_of(corpus(b), "path", "text"), keys, legal)


IDS = {"numbered": "SELECT 'A' || o_orderkey AS path, 'Ref ' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || ' x' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || chr(10) || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || ',' AS text, * FROM orders"}


@query("pv03_id_leaks", """SELECT path, CAST(1 AS BIGINT) AS line, 'afm' AS kind, lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS match FROM numbered WHERE o_custkey IN (SELECT s_suppkey FROM supplier)
    UNION ALL SELECT path, 2, 'afm', lpad(CAST(o_orderkey AS VARCHAR), 9, '0') FROM numbered WHERE o_orderkey IN (SELECT s_suppkey FROM supplier)""", IDS)
def _(b):
    nine = lambda x: F.lpad(c(x).cast("string"), 9, "0")
    texts = b.star.orders.select(F.concat(F.lit("A"), "o_orderkey").alias("path"), F.concat(F.lit("Ref "), nine("o_custkey"), F.lit(" x"), nine("o_custkey"), F.lit("\n"), nine("o_orderkey"), F.lit(",")).alias("text"))
    return pv.find_id_leaks(pv.lines_of(texts, "path", "text"), b.star.supplier.select(nine("s_suppkey").alias("afm")))


@query("pv04_form_leaks", r"""SELECT path, CAST(line AS BIGINT) AS line, 'person_form' AS kind, unnest(regexp_extract_all(replace(content, ', ', ' ,, '), '\p{L}+\s*,,\s*\p{L}')) AS match FROM corpus_lines""", PRIVACY)
def _(b):
    texts = corpus(b).withColumn("text", F.replace("text", F.lit(", "), F.lit(" ,, ")))
    return pv.find_form_leaks(pv.lines_of(texts, "path", "text"))


MARKED = {**PRIVACY, **IDS, "corpus": PRIVACY["corpus"] + " UNION ALL SELECT path, text FROM numbered UNION ALL SELECT 'f' || doc_id, replace(text, ', ', ' ,, ') FROM documents"}


@query("pv05_scan_corpus", r"""SELECT kind, count(*) AS n, count(DISTINCT path) AS n_texts FROM (SELECT path, 'name' AS kind FROM leaks UNION ALL
    SELECT path, 'person_form' FROM (SELECT path, unnest(regexp_extract_all(content, '\p{L}+\s*,,\s*\p{L}')) AS m FROM corpus_lines) UNION ALL
    SELECT path, 'afm' FROM numbered WHERE o_custkey IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT path, 'afm' FROM numbered WHERE o_orderkey IN (SELECT s_suppkey FROM supplier)) GROUP BY 1""", MARKED)
def _(b):
    """All kinds of leaks: names in published texts, ids in references, the form of two names."""
    nine = lambda x: F.lpad(c(x).cast("string"), 9, "0")
    refs = b.star.orders.select(F.concat(F.lit("A"), "o_orderkey").alias("path"), F.concat(F.lit("Ref "), nine("o_custkey"), F.lit(" x"), nine("o_custkey"), F.lit("\n"), nine("o_orderkey"), F.lit(",")).alias("text"))
    forms = b.star.documents.select(F.concat(F.lit("f"), "doc_id").alias("path"), F.replace("text", F.lit(", "), F.lit(" ,, ")).alias("text"))
    keys, _, legal = pv.person_markers(people(b))
    leaks = pv.scan_corpus(corpus(b).unionByName(refs).unionByName(forms), "path", "text", (keys, b.star.supplier.select(nine("s_suppkey").alias("afm")), legal))
    return leaks.groupBy("kind", "path").agg(F.count("*").alias("k")).groupBy("kind").agg(F.sum("k").alias("n"), F.count("path").alias("n_texts"))


@query("pv07_allowed_columns", "SELECT ref, entity FROM procurement")
def _(b):
    return pv.assert_allowed_columns(b.procurement).select("ref", "entity")

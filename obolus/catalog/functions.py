"""FN1-FN28: scalar functions over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.catalog.registry import query
from obolus.functions import codes, money, text
from obolus.plans.bindings import Bound, by_value

c = F.col

# DuckDB spellings, from its own functions
SPACES1 = r"trim(regexp_replace({0}, '[\s\p{Z}\x{85}]+', ' ', 'g'))"
NORM = r"trim(upper(replace(regexp_replace(strip_accents({0}), '[^\p{L}\p{N}_]+', ' ', 'g'), 'ß', 'SS')))"


def sql_fold(x: str) -> str:
    up = f"upper(replace(strip_accents({x}), 'ß', 'SS'))"
    return SPACES1.replace("{0}", f"translate({up}, 'ABEHIKMNOPTXYZ', 'ΑΒΕΗΙΚΜΝΟΡΤΧΥΖ')")


def sql_norm(x: str) -> str:
    return NORM.replace("{0}", x)


def sql_eu(x: str) -> str:
    """DECIMAL(18,2) -> '1.234,56'."""
    return (f"(replace(format('{{:,}}', CAST(floor({x}) AS BIGINT)), ',', '.') || ',' || "
            f"lpad(CAST(CAST({x} * 100 AS BIGINT) % 100 AS VARCHAR), 2, '0'))")


EVERY_TEXT = """SELECT 'd' || doc_id AS id, text FROM documents UNION ALL SELECT 'c' || conv_id || '-' || turn, text FROM conversations
    UNION ALL SELECT 'p' || page_id, html FROM pages UNION ALL SELECT 'b' || item_id, text FROM benchmark"""
TEXTS = {"texts": EVERY_TEXT}


def texts(b: Bound):
    s = b.star
    return (s.documents.select(F.concat(F.lit("d"), c("doc_id")).alias("id"), "text")
            .unionByName(s.conversations.select(F.concat(F.lit("c"), c("conv_id"), F.lit("-"), c("turn")).alias("id"), "text"))
            .unionByName(s.pages.select(F.concat(F.lit("p"), c("page_id")).alias("id"), c("html").alias("text")))
            .unionByName(s.benchmark.select(F.concat(F.lit("b"), c("item_id")).alias("id"), "text")))


@query("fn01_strip_accents", "SELECT id, md5(strip_accents(text)) AS digest, CAST(length(strip_accents(text)) AS BIGINT) AS n FROM texts", TEXTS)
def _(b):
    s = text.strip_accents(c("text"))
    return texts(b).select("id", F.md5(s).alias("digest"), F.length(s).alias("n"))


@query("fn02_fold", f"SELECT id, md5({sql_fold('text')}) AS digest, CAST(length({sql_fold('text')}) AS BIGINT) AS n FROM texts", TEXTS)
def _(b):
    s = text.fold(c("text"))
    return texts(b).select("id", F.md5(s).alias("digest"), F.length(s).alias("n"))


@query("fn03_normalise_name", f"""SELECT name, {sql_norm('name')} AS norm, count(*) AS n FROM raw_payment GROUP BY 1, 2
    UNION ALL SELECT id, md5({sql_norm('text')}), CAST(length({sql_norm('text')}) AS BIGINT) FROM texts""", TEXTS)
def _(b):
    names = b.raw_payment.groupBy("name").agg(F.count("*").alias("n")).select("name", text.normalise_name(c("name")).alias("norm"), "n")
    s = text.normalise_name(c("text"))
    return names.unionByName(texts(b).select(c("id").alias("name"), F.md5(s).alias("norm"), F.length(s).cast("bigint").alias("n")))


@query("fn04_symbol_repair", "SELECT id, md5(translate(text, 'aeou', 'ΔμΩΣ')) AS digest FROM texts", TEXTS)
def _(b):
    printed = F.translate("text", "aeou", "∆µΩ΢")
    return texts(b).select("id", F.md5(text.symbol_repair(printed)).alias("digest"))


@query("fn06_parse_amount_eu", "SELECT ada, CAST(price * 100 AS BIGINT) AS cents, -CAST(price * 100 AS BIGINT) AS negative FROM decisions")
def _(b):
    printed = money.format_amount_eu((c("price") * 100).cast("bigint"))
    return b.decisions.select("ada", money.cents_eu(printed).alias("cents"), money.cents_eu(F.concat(F.lit("-"), printed)).alias("negative"))


@query("fn07_parse_number_any", """SELECT ada, CAST(floor(price) AS BIGINT) * 100 AS whole, CAST(floor(price) AS BIGINT) * 100 + 50 AS tenths,
    CAST(price * 100 AS BIGINT) AS cents FROM decisions""")
def _(b):
    whole = F.translate(F.format_number(F.floor("price"), 0), ",", ".")
    return b.decisions.select("ada", money.number_cents(whole).alias("whole"), money.number_cents(F.concat(whole, F.lit(",5"))).alias("tenths"),
                              money.number_cents(money.format_amount_eu((c("price") * 100).cast("bigint"))).alias("cents"))


@query("fn08_parse_amount_en", "SELECT ada, CAST(price * 100 AS BIGINT) AS cents, o_orderstatus <> 'F' AND price >= 1000 AS english FROM decisions")
def _(b):
    greek = money.format_amount_eu((c("price") * 100).cast("bigint"))
    english = F.format_number("price", 2)
    line = F.concat(F.lit("row 14.10.2024  "), F.when(c("o_orderstatus") == "F", greek).otherwise(english), F.lit("  -"))
    d = b.decisions.withColumn("line", line).withColumn("english", money.votes_english(c("line")))
    found = money.amounts_at_locale(c("line"), c("english") | (c("o_orderstatus") != "F"))
    return d.select("ada", F.filter(found, lambda x: x["cents"].isNotNull())[F.size(found) - 1]["cents"].alias("cents"), "english")


@query("fn09_extract_amounts", """SELECT ada || '-' || l_linenumber AS id, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS first,
    CAST(NULL AS BIGINT) AS malformed, CAST(0 AS BIGINT) AS dash, CAST(CAST(l_tax AS DECIMAL(18,2)) * 100 AS BIGINT) AS last, CAST(4 AS BIGINT) AS n,
    CAST(6 + length(%s) AS BIGINT) AS first_end FROM lines""" % sql_eu("CAST(l_extendedprice AS DECIMAL(18,2))"))
def _(b):
    eu = lambda x: money.format_amount_eu((x.cast(money.MONEY) * 100).cast("bigint"))
    line = F.concat(F.lit("  γρ. "), eu(c("l_extendedprice")), F.lit("  50.0000,00   - €  0,50%  230,242 "), eu(c("l_tax")), F.lit(" €"))
    a = money.amounts_at(c("line"))
    return b.lines.withColumn("line", line).select(
        F.concat_ws("-", "ada", c("l_linenumber").cast("string")).alias("id"), a[0]["cents"].alias("first"), a[1]["cents"].alias("malformed"),
        a[2]["cents"].alias("dash"), a[3]["cents"].alias("last"), F.size(a).alias("n"), a[0]["end"].alias("first_end"))


@query("fn09_amounts_in_texts", r"""SELECT id, CAST(len(a) AS BIGINT) AS n, CAST(list_sum(list_transform(a, lambda x: CAST(replace(replace(x, '.', ''), ',', '') AS BIGINT))) AS BIGINT) AS cents
    FROM (SELECT id, list_filter(regexp_extract_all(text, '(^|[^\d.,])(-?\d{1,3}(?:\.\d{3})*,\d{2})(?:[^\d%]|$)', 2), lambda x: x <> '') AS a FROM texts)""", TEXTS)
def _(b):
    a = money.amounts_in(c("text"))
    zero = F.lit(0).cast("bigint")
    total = F.when(F.size(a) > 0, F.aggregate(a, zero, lambda s, x: s + x))
    return texts(b).select("id", F.size(a).alias("n"), total.alias("cents"))


@query("fn10_format_amount_eu", f"SELECT ada, {sql_eu('price')} AS printed FROM decisions")
def _(b):
    return b.decisions.select("ada", money.format_amount_eu((c("price") * 100).cast("bigint")).alias("printed"))


UNITS = ["", "ένα", "δύο", "τρία", "τέσσερα", "πέντε", "έξι", "επτά", "οκτώ", "εννέα", "δέκα", "έντεκα", "δώδεκα", "δεκατρία",
         "δεκατέσσερα", "δεκαπέντε", "δεκαέξι", "δεκαεπτά", "δεκαοκτώ", "δεκαεννέα"]
TENS = ["", "", "είκοσι", "τριάντα", "σαράντα", "πενήντα"]
HUNDREDS = ["", "εκατόν", "διακοσίων", "τριακοσίων", "τετρακοσίων", "πεντακοσίων", "εξακοσίων", "επτακοσίων"]


def spelled(n):
    """1..59 in words."""
    unit = lambda k: F.array(*[F.lit(x) for x in UNITS])[k]
    ten = F.array(*[F.lit(x) for x in TENS])[F.floor(n / 10).cast("int")]
    return F.when(n < 20, unit(F.when(n < 20, n).otherwise(0))).otherwise(F.concat_ws(" ", ten, unit(n - F.floor(n / 10).cast("int") * 10)))


@query("fn11_words_to_cents", """SELECT ada || '-' || l_linenumber AS id,
    (CAST(l_quantity AS BIGINT) * 1000 + CAST(l_linenumber AS BIGINT) * 100 + CAST(l_quantity AS BIGINT)) * 100 + CAST(round(l_discount * 100) AS BIGINT) AS cents,
    CAST(CAST(l_quantity AS BIGINT) * 100000000 AS BIGINT) AS millions, CAST(NULL AS BIGINT) AS other FROM lines""")
def _(b):
    q, d = c("l_quantity").cast("int"), F.round(c("l_discount") * 100).cast("int")
    hundred = F.array(*[F.lit(x) for x in HUNDREDS])[c("l_linenumber")]
    words = F.concat_ws(" ", spelled(q), F.lit("χιλιάδων"), hundred, spelled(q), F.lit("ευρώ και"), F.when(d == 0, F.lit("μηδέν")).otherwise(spelled(d)), F.lit("λεπτών"))
    return b.lines.select(F.concat_ws("-", "ada", c("l_linenumber").cast("string")).alias("id"), money.words_to_cents(words).alias("cents"),
                          money.words_to_cents_lenient(F.concat(spelled(q), F.lit(" εκατομμύρια"))).alias("millions"),
                          money.words_to_cents(F.concat(spelled(q), F.lit(" λίτρα ευρώ"))).alias("other"))


@query("fn12_parse_codes", r"""SELECT kae, CASE WHEN coalesce(kae, '') = '' THEN NULL WHEN regexp_matches(kae, '^\d{2}[.\-]\d{4}') THEN 'old'
    WHEN regexp_matches(kae, '^\d{4}(\.\d+)?$') THEN 'bare' WHEN regexp_matches(kae, '^\d{3}\.\d{7}') THEN 'new' ELSE 'unknown' END AS scheme,
    CASE WHEN regexp_matches(kae, '^\d{2}[.\-]\d{4}') THEN substr(kae, 4, 2) WHEN regexp_matches(kae, '^\d{4}(\.\d+)?$') THEN substr(kae, 1, 2)
    WHEN regexp_matches(kae, '^\d{3}\.\d{7}') THEN substr(kae, 5, 2) END AS major, count(*) AS n FROM raw_payment GROUP BY ALL""")
def _(b):
    return (b.raw_payment.groupBy("kae").agg(F.count("*").alias("n"))
            .select("kae", codes.code_scheme(c("kae")).alias("scheme"), codes.code_major(c("kae")).alias("major"), "n"))


STAMP = "strftime(ts, '%d/%m/%Y %H:%M:%S')"


@query("fn13_iso_from_dmy", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%d/%m/%Y') AS short FROM events")
def _(b):
    printed = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    return b.star.events.select("event_id", text.iso_from_dmy(printed).alias("iso"), text.iso_from_dmy(F.substring(printed, 1, 10)).alias("short"))


@query("fn14_issue_day", "SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS day FROM events")
def _(b):
    printed = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    bad = F.when(c("event_type") == "error", F.replace(printed, F.lit("/"), F.lit("."))).otherwise(printed)
    return b.star.events.select("event_id", text.issue_day(bad).alias("day"))


@query("fn15_civil_date", """SELECT 'e' || event_id AS id, strftime(timezone('Europe/Athens', timezone('UTC', ts)), '%Y-%m-%d') AS day FROM events
    UNION ALL SELECT 'l' || o_orderkey, strftime(o_orderdate, '%Y-%m-%d') FROM orders""")
def _(b):
    ms = F.unix_millis(F.to_utc_timestamp(c("o_orderdate").cast("timestamp"), fv.CIVIL_ZONE))  # local midnight of a civil date
    events = b.star.events.select(F.concat(F.lit("e"), "event_id").alias("id"), text.civil_date(F.unix_millis(c("ts").cast("timestamp"))).alias("day"))
    return events.unionByName(b.star.orders.select(F.concat(F.lit("l"), "o_orderkey").alias("id"), text.civil_date(ms).alias("day")))


@query("fn16_utc_ts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def _(b):
    return b.star.events.select("event_id", text.utc_ts(F.unix_millis(c("ts").cast("timestamp"))).alias("at"))


@query("fn20_related_keys", """SELECT ada, CASE o_orderpriority WHEN '1-URGENT' THEN 'A' || o_custkey || '|' || 'B' || o_custkey
    WHEN '2-HIGH' THEN 'A' || o_custkey ELSE '' END AS keys FROM decisions""")
def _(b):
    key = F.concat(F.lit("A"), c("o_custkey"))
    one = F.to_json(F.struct(key.alias("k")))
    many = F.to_json(F.array(F.struct(key.alias("k")), F.struct(F.concat(F.lit("B"), c("o_custkey")).alias("k")), F.struct(key.alias("k"))))
    raw = F.when(c("o_orderpriority") == "1-URGENT", many).when(c("o_orderpriority") == "2-HIGH", one)
    keys = F.transform(codes.as_list(raw, "struct<k:string>"), lambda x: x["k"])
    return b.decisions.select("ada", codes.distinct_sorted(keys).alias("keys"))


@query("fn21_links_of", """SELECT ada, CASE o_orderpriority WHEN '1-URGENT' THEN 'R' || o_custkey || '|S' || o_custkey
    WHEN '2-HIGH' THEN 'R' || o_custkey ELSE '' END AS links FROM decisions""")
def _(b):
    one = F.concat(F.lit(" R"), c("o_custkey"), F.lit(" "))
    many = F.to_json(F.array(F.concat(F.lit("S"), c("o_custkey")), one, F.lit(" "), one))
    raw = F.when(c("o_orderpriority") == "1-URGENT", many).when(c("o_orderpriority") == "2-HIGH", one)
    return b.decisions.select("ada", codes.string_list(raw).alias("links"))


@query("fn23_record_type", "SELECT ada, upper(substr(c_mktsegment, 1, 4)) AS kind FROM decisions")
def _(b):
    ref = F.concat(F.lit("24"), F.upper(F.substring("c_mktsegment", 1, 4)), F.lpad(c("o_orderkey").cast("string"), 9, "0"))
    return b.decisions.select("ada", text.record_type(ref).alias("kind"))


@query("fn24_budget_year", "SELECT ada, CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN year + 18 ELSE year END AS BIGINT) AS budget_year FROM decisions")
def _(b):
    y = (c("year") + 18).cast("string")
    subject = (F.when(c("o_orderpriority") == "1-URGENT", F.concat(F.lit("Απόδοση ΚΑΠ  έτους "), y, F.lit(" – κατανομή")))
               .when(c("o_orderpriority") == "2-HIGH", F.concat(F.lit("ΚΑΠ "), y))
               .when(c("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("διδακτικό έτος "), y, F.lit("-"), (c("year") + 19).cast("string")))
               .otherwise(F.lit("Απόδοση εσόδων")))
    return b.decisions.select("ada", codes.budget_year(subject, c("year")).alias("budget_year"))


@query("fn25_cited_keys", """SELECT ada, lpad(CAST(o_custkey AS VARCHAR), 7, '0') || '-ΑΒΓ' AS cited FROM decisions""")
def _(b):
    own = F.concat(F.lpad(c("o_orderkey").cast("string"), 7, "0"), F.lit("-ΩΩΩ"))
    other = F.concat(F.lpad(c("o_custkey").cast("string"), 7, "0"), F.lit("-ΑΒΓ"))
    doc = F.concat(F.lit("Σχετ. ADA "), own, F.lit(" και "), other, F.lit(", "), other, F.lit(" x123456-ΑΒΓΔ"))
    return b.decisions.select("ada", text.cited_keys(doc, own, fv.CITED_KEY).alias("cited"))


@query("fn27_safe_cell", "SELECT id, md5(replace(replace(" + SPACES1.replace("{0}", "text") + r", '|', '\|'), '<', '&lt;')) AS digest FROM texts", TEXTS)
def _(b):
    return texts(b).select("id", F.md5(text.safe_cell(c("text"))).alias("digest"))


@query("fn28_lead_words", rf"""SELECT id, word, count(*) AS n FROM (SELECT id, unnest(regexp_extract_all({sql_fold('text')}, '\p{{Greek}}+')) AS word FROM texts)
    WHERE word IN (SELECT DISTINCT unnest(regexp_extract_all({sql_fold('p_name')}, '\p{{Greek}}+')) FROM part) GROUP BY 1, 2""".replace(r"\p{Greek}", "[Α-Ω]"), TEXTS)
def _(b):
    from obolus.operators.privacy import lead_words
    words = F.explode(F.regexp_extract_all(text.fold(c("p_name")), F.lit("([Α-Ω]+)"), 1))
    vocabulary = b.star.part.select(words.alias("word")).distinct()
    return lead_words(texts(b), "id", "text", vocabulary)


@query("fn28_name_vocabulary", """SELECT word, count(*) AS n FROM (SELECT DISTINCT p_partkey % 50 AS k, chr(CAST(913 + p_partkey % 17 AS INTEGER)) || 'ΝΝ' || s.e AS word
        FROM part, (VALUES (0, 'ΟΣ'), (0, 'ΟΥ'), (0, 'Ο'), (1, 'ΗΣ'), (1, 'Η'), (2, 'Α'), (2, 'ΑΣ'), (3, '')) s(d, e) WHERE s.d = p_size % 4) GROUP BY 1""")
def _(b):
    """Names of three declensions and whole forms, counted by the tens of parts that carry them."""
    from obolus.operators.privacy import name_vocabulary
    stem = F.concat(F.substring(F.lit("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡ"), (c("p_partkey") % 17 + 1).cast("int"), F.lit(1)), F.lit("ΝΝ"))
    kinds = F.element_at(F.array(F.lit("os"), F.lit("is"), F.lit("a"), F.lit("whole")), (c("p_size") % 4 + 1).cast("int"))
    stems = b.star.part.select((c("p_partkey") % 50).alias("k"), stem.alias("stem"), kinds.alias("declension")).distinct()
    words = name_vocabulary(stems)
    held = stems.select("k", F.col("stem"), F.explode(F.when(c("declension") == "os", F.array(*map(F.lit, ("ΟΣ", "ΟΥ", "Ο")))).when(c("declension") == "is", F.array(*map(F.lit, ("ΗΣ", "Η")))).when(c("declension") == "a", F.array(*map(F.lit, ("Α", "ΑΣ")))).otherwise(F.array(F.lit("")))).alias("e"))
    return held.select("k", F.concat("stem", "e").alias("word")).distinct().join(words, "word").groupBy("word").agg(F.count("*").alias("n"))


SHIFTED = {"1-URGENT": ("ηεζζάπων χιλιάδων ευπώ", "ΤΕΣΣΑΡΩΝ ΧΙΛΙΑΔΩΝ ΕΥΡΩ"), "2-HIGH": ("δύο χιλιάδων", "ΔΥΟ ΧΙΛΙΑΔΩΝ"), "3-MEDIUM": ("είκοζι", "ΕΙΚΟΣΙ"), "4-NOT SPECIFIED": ("λέξη & ηπία", "ΛΕΞΗ & ΤΡΙΑ"), "5-LOW": ("", "")}


@query("fn05_unshift_words", "SELECT ada, CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v[1]}'" for k, v in SHIFTED.items()) + " END || ' ' || c_mktsegment AS words FROM decisions")
def _(b):
    """Number words as a letter-shifting font prints them, and words that are none."""
    printed = F.concat(by_value(c("o_orderpriority"), {k: v[0] for k, v in SHIFTED.items()}), F.lit(" "), c("c_mktsegment"))
    words = money.unshift_words(text.upper_plain(printed))
    return b.decisions.select("ada", F.when(c("o_orderpriority") == "5-LOW", F.concat(F.lit(" "), words)).otherwise(words).alias("words"))

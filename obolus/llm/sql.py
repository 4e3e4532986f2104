"""The same results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from obolus.llm import decontaminate, license_scan, quality_rules, spelling, url_filter

LOWER = f"translate({{}}, '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', '{'abcdefghijklmnopqrstuvwxyz'}')"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _url() -> str:
    host = lambda u: LOWER.format(f"regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1)")
    path = lambda u: f"regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    query = lambda u: (f"regexp_replace(regexp_replace(regexp_extract({u}, '(?s)^[^?#]*(\\?[^#]*)', 1), '([?&])(((utm_[a-z]+|gclid|fbclid|ref)=[^&]*(&|$))+)', '\\1', 'g'), '[?&]$', '')")
    address = lambda u: f"CASE WHEN {host(u)} <> '' THEN {host(u)} || {path(u)} || {query(u)} END"
    value = r"\s*=\s*[\"'']?([^\"''\s>]+)"
    rules = ", ".join(f"({_quoted(r)}, {_quoted(v)}, {_quoted(r.partition('/')[0])}, {_quoted('/' + r.partition('/')[2])})" for v, r in url_filter.RULES)
    return f"""WITH RECURSIVE rules(rule, verdict, h, p) AS (VALUES {rules}),
    mine AS (SELECT page_id, {host("coalesce(url, '')")} AS host, {path("coalesce(url, '')")} AS path, {address("coalesce(url, '')")} AS address FROM pages),
    tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) AS tag FROM pages WHERE regexp_matches(html, '(?i)canonical|http-equiv|og:url')),
    hrefs AS (SELECT url, CASE WHEN regexp_matches(tag, '(?i)\\brel\\s*=\\s*["'']?canonical\\b') THEN regexp_extract(tag, '(?i)\\bhref{value}', 1)
            WHEN regexp_matches(tag, '(?i)\\bhttp-equiv\\s*=\\s*["'']?refresh\\b') THEN regexp_extract(tag, '(?i)\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1)
            WHEN regexp_matches(tag, '(?i)\\bproperty\\s*=\\s*["'']?og:url\\b') THEN regexp_extract(tag, '(?i)\\bcontent{value}', 1) END AS h FROM tags),
    hrefs_plain AS (SELECT url, regexp_replace(h, '(?i)&(?:amp|#0*38|#x0*26);', '&', 'g') AS h FROM hrefs),
    full_href AS (SELECT url, CASE WHEN contains(h, '://') THEN h WHEN starts_with(h, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || h
            WHEN starts_with(h, '/') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || '://' || {host('url')} || h
            ELSE regexp_replace(regexp_extract(url, '(?s)^([^?#]*?://[^/?#]*[^?#]*/|[^?#]*://[^/?#]*)', 1), '/$', '') || '/' || h END AS u FROM hrefs_plain WHERE h <> ''),
    edges AS (SELECT DISTINCT {address('url')} AS a, {address('u')} AS b, {host('u')} AS host, {path('u')} AS path FROM full_href),
    nodes AS (SELECT address, host, path FROM mine WHERE address IS NOT NULL UNION SELECT b, host, path FROM edges WHERE a <> b),
    ruled AS (SELECT address, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
              FROM nodes JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY 1),
    pairs AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
    reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b),
    spread AS (SELECT r.a AS address, min(least(r.a, r.b)) AS root, bool_or(coalesce(x.verdict = 'block', false)) AND NOT bool_or(coalesce(x.verdict = 'allow', false)) AS blocked
               FROM reach r LEFT JOIN ruled x ON x.address = r.b GROUP BY 1)
    SELECT page_id, host, path, r.rule, coalesce(r.verdict, CASE WHEN s.blocked THEN 'block' END, 'allow') AS verdict, s.root AS alias_of
    FROM mine m LEFT JOIN ruled r ON r.address = m.address LEFT JOIN spread s ON s.address = m.address"""


def _license() -> str:
    rows = [(t.label, len(t.words), t.need, w) for t in license_scan.templates_of() for w in t.words]
    ids = [i for i, t in enumerate(license_scan.templates_of()) for _ in t.words]
    width = max(len(t.split()) for t, _ in license_scan.TEMPLATES)
    values = ", ".join(f"({i}, {_quoted(a)}, {b}, {c}, {_quoted(d)})" for i, (a, b, c, d) in zip(ids, rows))
    words = lambda t: f"regexp_extract_all({LOWER.format(t)}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    at = " UNION ALL ".join(
        f"SELECT k, i - 1 AS i, {_quoted(label)} AS label FROM w, range(1, len(ws) + 1) r(i) WHERE " + " AND ".join(f"ws[i + {j}] = {_quoted(x)}" for j, x in enumerate(p.split()))
        for p, label in license_scan.PHRASES)
    return f"""WITH tpl(t, label, size, need, word) AS (VALUES {values}),
    w AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, {words("coalesce(text, '')")} AS ws FROM documents),
    hits AS ({at}),
    base AS (SELECT k, count(*) AS n, min(i) AS lo, max(i) AS hi, list_sort(list(DISTINCT label)) AS labels FROM hits GROUP BY 1),
    token AS (SELECT k, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM w),
    place AS (SELECT k, t, label, size, need, i, word FROM token JOIN tpl USING (word)),
    inside AS (SELECT p.k, p.t, p.label, p.size, p.need, p.i AS start, p.word AS first, q.word, q.i FROM place p JOIN place q ON p.k = q.k AND p.t = q.t AND q.i >= p.i AND q.i < p.i + {width}),
    firsts AS (SELECT k, t, label, size, need, start, first, word, min(i) AS i FROM inside GROUP BY ALL),
    block AS (SELECT k, t, label, size, start, first, list(word) AS shared, list(i) AS spots, max(i) AS last FROM firsts GROUP BY ALL HAVING count(*) >= any_value(need)),
    matched AS (SELECT k, start, label, size, len(shared) / size AS c, shared, spots FROM block b
                WHERE NOT EXISTS (SELECT 1 FROM place p WHERE p.k = b.k AND p.t = b.t AND p.word = b.first AND p.i > b.start AND p.i < b.last)),
    kept AS (SELECT k, label, c FROM matched a WHERE NOT EXISTS (SELECT 1 FROM matched b WHERE b.k = a.k AND abs(b.start - a.start) < {width} AND (b.c, b.size, b.label) > (a.c, a.size, a.label)
                AND 2 * len(list_filter(a.spots, lambda x: NOT list_contains(b.spots, x))) < len(a.spots) AND list_has_all(b.shared, a.shared))),
    more AS (SELECT k, list(DISTINCT label) AS labels, max(c) AS best FROM kept GROUP BY 1)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
        coalesce(array_to_string(base.labels, ','), '') AS base_labels,
        array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
        CASE WHEN n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
    FROM w LEFT JOIN base USING (k) LEFT JOIN more USING (k)"""


EXACT = """WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
    SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t.text) AS text_sha256 FROM t JOIN g USING (text)"""


def _quality() -> str:
    r, q = quality_rules.Rules(), _quoted
    words = lambda t: f"regexp_extract_all({t}, '[^\\x20\\x09-\\x0D]+')"
    count = lambda t, chars: f"(length({t}) - length(translate({t}, {q(chars)}, '')))"
    return f"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT k, doc_id, text, {words('text')} AS ws FROM d),
    win AS (SELECT k, i, array_to_string(ws[i:i + {r.window - 1}], ' ') AS win FROM w, range(1, len(ws) - {r.window - 2}) r(i)),
    again AS (SELECT k, win FROM win GROUP BY 1, 2 HAVING count(*) > 1),
    covered AS (SELECT k, count(DISTINCT i + j) AS n FROM win JOIN again USING (k, win), range(0, {r.window}) o(j) GROUP BY 1),
    line AS (SELECT k, unnest(string_split(text, chr(10))) AS l FROM w),
    told AS (SELECT k, l, {words('l')} AS lw FROM line),
    judged AS (SELECT k, l, len(lw) AS n,
        (len(lw) >= {r.long_line} AND {count('l', quality_rules.STOPS)} = 0) OR ({count('l', quality_rules.BARS)} >= 3 AND {count('l', quality_rules.BARS)} * 4 >= len(lw))
        OR (len(lw) >= 5 AND {count('l', quality_rules.SYMBOLS)} * 2 >= len(lw)) OR (len(lw) >= 5 AND {count('l', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')} * 2 > length(l))
        OR (len(lw) >= 10 AND len(list_distinct(lw)) * 3 <= len(lw)) OR (len(lw) <= {r.short_line} AND regexp_matches(lower(l), {q('|'.join(quality_rules.BOILERPLATE))})) AS bad
        FROM told WHERE len(lw) > 0),
    lines AS (SELECT k, count(*) - count(DISTINCT l) AS dup, coalesce(sum(n) FILTER (bad), 0) AS lost FROM judged GROUP BY 1),
    m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(text) - length(regexp_replace(text, '[^\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST({count('text', quality_rules.SYMBOLS)} AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(lost, 0) AS BIGINT) AS n_lost_words FROM w LEFT JOIN covered c USING (k) LEFT JOIN lines USING (k)),
    b AS (SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words AS base_failed FROM m)
    SELECT *, NOT base_failed AND 100 * n_lost_words <= {r.max_lost_percent} * n_words AS kept FROM b"""


def _spelling() -> str:
    byte = "list_reduce(list_prepend(c, range(8)::BIGINT[]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)"
    data = "list_transform(range(octet_length(encode(s))), lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::BIGINT)"
    crc = f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda a, b: xor(t.crcs[(xor(a, b) & 255) + 1], a >> 8)))"
    return f"""WITH t AS MATERIALIZED (SELECT list(x ORDER BY c) AS crcs FROM (SELECT c, {byte} AS x FROM range(256) r(c))),
    runs AS (SELECT doc_id, {LOWER.format("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+'))")} AS run FROM documents),
    per AS (SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS s, count(*) AS k FROM runs WHERE length(run) >= {spelling.LENGTH} GROUP BY 1, 2),
    hashed AS (SELECT run, k, {crc} AS h FROM per, t),
    told AS (SELECT CASE WHEN h % {spelling.LOSES} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM hashed),
    v AS (SELECT word, sum(k)::BIGINT AS n FROM told WHERE length(word) >= {spelling.LENGTH} GROUP BY 1 HAVING sum(k) >= {spelling.TIMES}),
    less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS blank FROM v, range(1, length(word) + 1) r(i)),
    near AS (SELECT a.word AS a, b.word AS b, b.n FROM less a JOIN less b ON a.blank = b.blank AND a.word <> b.word
             UNION SELECT l.word, v.word, v.n FROM less l JOIN v ON v.word = l.rest UNION SELECT v.word, l.word, l.n FROM less l JOIN v ON v.word = l.rest),
    best AS (SELECT a, count(*) AS n_near, max(n) AS top FROM near GROUP BY 1),
    chosen AS (SELECT best.a, n_near, top, min(b) AS b FROM best JOIN near ON near.a = best.a AND near.n = top GROUP BY ALL),
    formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= {spelling.RATIO} * n THEN b END AS form, CASE WHEN top >= {spelling.RATIO} * n THEN top END AS form_n FROM v LEFT JOIN chosen ON a = word),
    walk AS (SELECT word, word AS here, 0 AS steps FROM formed UNION ALL SELECT walk.word, form, steps + 1 FROM walk JOIN formed ON formed.word = here WHERE form IS NOT NULL),
    ends AS (SELECT word, arg_max(here, steps) AS root FROM walk GROUP BY 1)
    SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)""".replace("WITH t", "WITH RECURSIVE t", 1)


def _decontaminate() -> str:
    words = lambda t: f"regexp_extract_all({LOWER.format(t)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""WITH item AS (SELECT item_id::VARCHAR AS item, {words("coalesce(text, '')")} AS ws FROM benchmark),
    win AS (SELECT DISTINCT item, array_to_string(ws[i:i + {decontaminate.SIZE - 1}], ' ') AS win, least(len(ws), {decontaminate.SIZE}) AS n FROM item, range(1, greatest(len(ws) - {decontaminate.SIZE - 2}, 2)) r(i) WHERE len(ws) > 0),
    d AS (SELECT row_number() OVER () AS k, doc_id, {words("coalesce(text, '')")} AS ws FROM documents),
    size AS (SELECT DISTINCT n FROM win),
    hit AS (SELECT k, i, p.n, item FROM (SELECT k, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win FROM d, size, range(1, len(ws) - n + 2) r(i)) p JOIN win USING (win, n)),
    inside AS (SELECT k, count(DISTINCT i + j) AS n_hit FROM (SELECT DISTINCT k, i, n FROM hit), range(0, n) o(j) GROUP BY 1),
    items AS (SELECT k, list_sort(list(DISTINCT item) FILTER (item IS NOT NULL)) AS items FROM hit GROUP BY 1)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
        sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN inside USING (k) LEFT JOIN items USING (k)"""


ORACLES: dict[str, str] = {"op1_url_filter": _url(), "op2_license_scan": _license(), "op4_exact_dedup": EXACT, "op6_quality_rules": _quality(),
                           "op11_spelling_variants": _spelling(), "op12_decontamination": _decontaminate()}

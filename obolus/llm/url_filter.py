"""URL filters with redirect equivalence: pages that redirect to, or name as canonical, the same
address are aliases; a block decision on one holds for all, an explicit allow stands above it.

1. Every address (of pages, and those that links lead to) becomes a node: host and path lower-cased
   as the rules see them, the query without campaign parameters; scheme and fragment are left out.
2. Edges: `<link rel="canonical">`, `og:url`, `<meta http-equiv="refresh">`, from the page's html.
3. Rules (host and path prefix, the longest wins) are joined to the nodes on the host's suffixes.
4. Components of the edges are found by distributed joins (``components``).
5. A page's verdict: its own rule's; else `block` if a member of its component is blocked by a rule
   and none is allowed by one; else `allow`.

Only DataFrame functions are used. Pages of one address are reduced to one node before any
shuffle of nodes; nothing is collected. Defined results: a null url, or one without `://`, has an
empty host and path, no rule and no alias, verdict `allow`. Of two rules of the same length that
fit, the allowing one wins. Repeated rows get the same result each. Null or broken html: no edges. An
ampersand written as an entity in a link is one. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obolus.llm.common import ascii_lower
from obolus.llm.components import connected
from obolus.operators.shape import once

#: The rules the query is asked to apply.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Query parameters that tell where a visitor came from, not what the page is.
CAMPAIGN = r"(?<=[?&])(utm_[a-z]+|gclid|fbclid|ref)=[^&]*&?"

#: How html writes an ampersand inside an attribute.
ENTITY = r"(?i)&(?:amp|#0*38|#x0*26);"
#: An attribute's value, in quotes or bare.
_VALUE = r"""\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address_of(url: Column) -> Column:
    """What is compared: host, path and the query that is left; null where there is no host."""
    query = F.regexp_replace(F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1), CAMPAIGN, "")
    return F.nullif(F.concat(host_of(url), F.when(host_of(url) != "", F.concat(path_of(url), F.regexp_replace(query, "[?&]$", ""))).otherwise("")), F.lit(""))


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """(rule, verdict, rule_host, rule_path): a rule is a host and, from its first slash on, a path."""
    return spark.createDataFrame([(r, v, *(lambda h, s, p: (h.lower(), s + p))(*r.partition("/"))) for v, r in rules], "rule string, verdict string, rule_host string, rule_path string")


def judge_by_rules(nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds the longest rule that fits (host, path) of ``nodes`` (``address`` is its key), or null.

    Hosts and paths are judged once each; a rule list of any length may be given, as the join is on
    the host's suffixes, of which a host has a handful."""
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    tried = nodes.select("address", "path", F.explode(suffixes).alias("rule_host")).join(rules, "rule_host").filter(F.startswith("path", "rule_path"))
    best = F.struct(F.length("rule").alias("n"), (F.col("verdict") == "allow").alias("allow"), "rule", "verdict")
    fits = tried.groupBy("address").agg(F.max(best).alias("best"))
    return nodes.join(fits, "address", "left").select(*[nodes[c] for c in nodes.columns], F.col("best.rule").alias("rule"), F.col("best.verdict").alias("ruled"))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b, target_url): a page's address and one that its html gives as the same page's."""
    tags = F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), 0)
    df = pages.filter(F.col("html").rlike(r"(?i)canonical|http-equiv|og:url")).select("url", F.explode(tags).alias("tag"))
    target = (F.when(F.col("tag").rlike(r"""(?i)\brel\s*=\s*["']?canonical\b"""), F.regexp_extract("tag", r"(?i)\bhref" + _VALUE, 1))
              .when(F.col("tag").rlike(r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b"""), F.regexp_extract("tag", r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)""", 1))
              .when(F.col("tag").rlike(r"""(?i)\bproperty\s*=\s*["']?og:url\b"""), F.regexp_extract("tag", r"(?i)\bcontent" + _VALUE, 1)))
    df = df.select("url", F.regexp_replace(target, ENTITY, "&").alias("to")).filter(F.col("to") != "")
    scheme = F.regexp_extract("url", "(?s)^(.*?)://", 1)
    base = F.regexp_extract("url", r"(?s)^([^?#]*?://[^/?#]*[^?#]*/|[^?#]*://[^/?#]*)", 1)
    full = (F.when(F.contains("to", F.lit("://")), F.col("to")).when(F.startswith("to", F.lit("//")), F.concat(scheme, F.lit(":"), "to"))
            .when(F.startswith("to", F.lit("/")), F.concat(scheme, F.lit("://"), host_of(F.col("url")), "to"))
            .otherwise(F.concat(F.regexp_replace(base, "/$", ""), F.lit("/"), F.col("to"))))
    df = once(once(df, "target_url", full), "a", address_of(F.col("url")))  # else every later expression repeats the one above
    df = once(df, "b", address_of(F.col("target_url"))).select("a", "b", "target_url")
    return df.filter("a is not null and b is not null and a != b").distinct()


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, alias_of (the smallest address of its
    component; null without an alias)."""
    url = F.coalesce("url", F.lit(""))
    mine = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), address_of(url).alias("address"))
    edges = alias_edges(pages)
    targets = edges.select(F.col("b").alias("address"), host_of(F.col("target_url")).alias("host"), path_of(F.col("target_url")).alias("path"))
    nodes = mine.filter("address is not null").select("address", "host", "path").unionByName(targets).groupBy("address").agg(F.min("host").alias("host"), F.min("path").alias("path"))
    ruled = judge_by_rules(nodes, rules).select("address", "rule", "ruled")
    roots = connected(edges.select("a", "b")).select(F.col("node").alias("address"), "root")
    roots = roots.unionByName(roots.select(F.col("root").alias("address"), "root").distinct())
    member = ruled.join(roots, "address")
    spread = member.groupBy("root").agg((F.max(F.expr("ruled = 'block'")) & ~F.coalesce(F.max(F.expr("ruled = 'allow'")), F.lit(False))).alias("blocked"))
    aliased = roots.join(spread, "root").select("address", "root", "blocked")
    # two lookups on a key that is unique on the right; pages without an address stay out of them
    some, none = mine.filter("address is not null"), mine.filter("address is null")
    out = some.join(ruled, "address", "left").join(aliased, "address", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("blocked"), F.lit("block")), F.lit("allow")).alias("verdict"), F.col("root").alias("alias_of"))
    null = F.lit(None).cast("string")
    return out.unionByName(none.select("page_id", "host", "path", null.alias("rule"), F.lit("allow").alias("verdict"), null.alias("alias_of")))

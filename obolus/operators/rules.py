"""Ordered first-match rules: a rule table becomes one CASE WHEN over folded text.

CASE short-circuits, so a row pays for the rules up to its match. Rule tables are data:
(label, pattern) pairs, or (rule set, label, pattern) for sets chosen per issuer."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def holds(text: Column, words: str) -> Column:
    """Whether ``text`` holds one of the plain ``words`` (parted by ``|``): a search of bytes, no regular expression."""
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words.split("|")])


def first_match(text: Column, rules: Iterable[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first rule whose pattern is found in ``text``, else ``default``."""
    out = None
    for label, pattern in rules:
        hit = text.rlike(pattern)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    fallback = F.lit(default) if default is not None else F.lit(None).cast("string")
    return fallback if out is None else out.otherwise(fallback)


def first_match_by_set(text: Column, key: Column, sets: dict[str, Iterable[tuple[str, str]]]) -> Column:
    """As ``first_match`` with the rule set chosen by ``key``; null where the set has no match."""
    out = None
    for name, rules in sets.items():
        hit, value = key == name, first_match(text, rules)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return F.lit(None).cast("string") if out is None else out


def lookup(key: Column, table: dict[str, str | None]) -> Column:
    """A fixed table as a literal map; keys with no entry give null."""
    pairs = [x for k, v in table.items() if v is not None for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), key) if pairs else F.lit(None).cast("string")

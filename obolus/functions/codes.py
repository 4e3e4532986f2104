"""Budget codes, polymorphic JSON fields and identifier shapes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.functions.text import fold


def code_scheme(code: Column) -> Column:
    """'old' 00.8231, 'bare' 8211, 'new' 055.2120102001, else 'unknown'; null when blank."""
    c = F.trim(code)
    return (F.when(F.coalesce(c, F.lit("")) == "", F.lit(None))
            .when(c.rlike(fv.CODE_OLD), F.lit("old"))
            .when(c.rlike(fv.CODE_BARE), F.lit("bare"))
            .when(c.rlike(fv.CODE_NEW), F.lit("new"))
            .otherwise(F.lit("unknown")))


def code_major(code: Column) -> Column:
    """The two-digit group of a budget code; null when the scheme is unknown."""
    c = F.trim(code)
    return (F.when(c.rlike(fv.CODE_OLD), F.substring(F.regexp_extract(c, fv.CODE_OLD, 2), 1, 2))
            .when(c.rlike(fv.CODE_BARE), F.substring(c, 1, 2))
            .when(c.rlike(fv.CODE_NEW), F.substring(F.regexp_extract(c, fv.CODE_NEW, 1), 1, 2)))


def four_digit_code(code: Column) -> Column:
    """The four digits the reconciliations compare: from '00.8231...' else from '8231...'.
    No match stays the empty string and a null code stays null, two separate groups."""
    old = F.nullif(F.regexp_extract(code, r"^\d{2}[.\-](\d{4})", 1), F.lit(""))
    return F.coalesce(old, F.regexp_extract(code, r"^(\d{4})", 1))


def valid_key(c: Column, kind: str) -> Column:
    return F.coalesce(c.rlike(fv.KEY_SHAPES[kind]) & ~c.rlike(r"[\r\n]"), F.lit(False))


def as_list(raw: Column, element_schema: str) -> Column:
    """A JSON field that is null, one object or a list of them -> always a list."""
    text = F.trim(raw)
    return (F.when(text.startswith("["), F.from_json(text, f"array<{element_schema}>"))
            .when(text.startswith("{"), F.array(F.from_json(text, element_schema)))
            .otherwise(F.array().cast(f"array<{element_schema}>")))


def string_list(raw: Column) -> Column:
    """A JSON field that is null, a string or a list -> trimmed, distinct, sorted strings."""
    text = F.trim(raw)
    items = F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.array(raw))
    return distinct_sorted(items)


def distinct_sorted(items: Column) -> Column:
    trimmed = F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.trim(x))
    return F.array_sort(F.array_distinct(F.filter(trimmed, lambda x: x.isNotNull() & (x != ""))))


def iso_day(c: Column) -> Column:
    return F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd") if hasattr(F, "try_to_date") \
        else F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def budget_year(subject: Column, issued: Column) -> Column:
    """The year a subject names as the budget's, not a school year; else the issue year."""
    return F.coalesce(F.regexp_extract(fold(subject), fv.BUDGET_YEAR, 1).try_cast("int"), issued)

"""Amounts: parsing and printing, with cents as LONG and money as DECIMAL(18,2)."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.functions.text import fold

MONEY = "decimal(18,2)"


def cents_eu(c: Column) -> Column:
    """'1.234,56' -> 123456. Two decimals are always printed, so the digits are the cents."""
    return F.regexp_replace(c, r"[.,]", "").try_cast("bigint")


def number_cents(c: Column) -> Column:
    """Whole euros or up to two decimals: '29.700' -> 2970000, '8,5' -> 850."""
    whole = F.replace(F.substring_index(c, ",", 1), F.lit("."), F.lit(""))
    decimals = F.when(F.instr(c, ",") > 0, F.substring_index(c, ",", -1)).otherwise(F.lit(""))
    return F.concat(whole, F.rpad(decimals, 2, "0")).try_cast("bigint")


def cents_en(c: Column) -> Column:
    """'8,000.00' -> 800000, '-.54' -> -54."""
    return F.regexp_replace(c, r"[.,]", "").try_cast("bigint")


def euros(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY)


def format_amount_eu(cents: Column) -> Column:
    """123456 -> '1.234,56'."""
    return F.translate(F.format_number(cents.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)"), 2), ",.", ".,")


def amounts_in(c: Column, pattern: str = fv.AMOUNT_IN_LINE) -> Column:
    """Every amount of a line, in cents."""
    return F.transform(F.regexp_extract_all(c, F.lit(f"({pattern})"), 1), cents_eu)


def _ends(pieces: Column, found: Column) -> Column:
    """End offset of each match: the text between matches and the matches, summed up."""
    lengths = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.length(p) + F.length(m))
    empty = F.array().cast("array<int>")
    return F.aggregate(lengths, empty, lambda acc, n: F.concat(acc, F.array(n + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)))))


def amounts_at(c: Column, pattern: str = fv.COLUMN_TOKEN) -> Column:
    """array<struct<cents,end>> of each currency column: a malformed token keeps its
    column with null cents, a dash stands for zero."""
    found = F.regexp_extract_all(c, F.lit(f"({pattern})"), 1)
    value = lambda t: F.when(t == "-", F.lit(0).cast("bigint")).when(t.rlike(f"^{fv.AMOUNT_EU}$"), cents_eu(t))
    return F.zip_with(found, _ends(F.split(c, pattern, -1), found),
                      lambda t, e: F.struct(value(t).alias("cents"), e.alias("end")))


def amounts_at_locale(c: Column, english: Column) -> Column:
    """array<struct<cents,end>> with the document's own number format."""
    def one(pattern: str, parse) -> Column:
        found = F.regexp_extract_all(c, F.lit(f"({pattern})"), 1)
        return F.zip_with(found, _ends(F.split(c, pattern, -1), found),
                          lambda t, e: F.struct(parse(t).alias("cents"), e.alias("end")))
    return F.when(english, one(fv.AMOUNT_IN_LINE_EN, cents_en)).otherwise(one(fv.AMOUNT_IN_LINE, cents_eu))


def votes_english(text: Column) -> Column:
    """True when a document's thousands are printed '8,000.00' more often than '8.000,00'."""
    english = F.regexp_count(text, F.lit(r"(?<![\d.,])\d{1,3}(?:,\d{3})+\.\d{2}(?![\d%])"))
    greek = F.regexp_count(text, F.lit(r"(?<![\d.,])\d{1,3}(?:\.\d{3})+,\d{2}(?![\d%])"))
    return english > greek


def _literal_map(d: dict[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def number_tokens(words: Column) -> Column:
    return F.regexp_extract_all(words, F.lit(r"([\p{L}\p{N}]+|&)"), 1)


def words_to_cents(words: Column, folded: bool = False) -> Column:
    """'τριάντα τεσσάρων χιλιάδων ... ευρώ & τεσσάρων λεπτών' -> cents. Null when a token is
    not a number word or no 'euro' is printed.

    One pass over the tokens with a five-field state: what stands since the last unit
    word, the thousands so far, the euros once 'euro' is met, the cents, and validity."""
    text = words if folded else fold(words)
    units = _literal_map(fv.NUMBER_UNITS)

    def value_of(t: Column) -> Column:
        hundred = F.lit(None).cast("int")
        for stem, v in fv.NUMBER_HUNDREDS.items():
            hundred = F.when(t.startswith(stem), F.lit(v)).otherwise(hundred)
        return F.coalesce(F.try_element_at(units, t), hundred, F.when(t.rlike(r"^\d+$"), t.try_cast("int")))

    typed = F.transform(
        F.filter(number_tokens(text), lambda t: ~t.isin("&", "ΚΑΙ")),
        lambda t: F.struct(value_of(t).cast("bigint").alias("n"),
                           F.when(t.startswith("ΧΙΛΙ"), F.lit("k")).when(t.startswith("ΕΚΑΤΟΜΜΥΡΙ"), F.lit("m"))
                           .when(t == "ΕΥΡΩ", F.lit("e")).when(t.startswith("ΛΕΠΤ"), F.lit("c")).alias("u")))
    zero = F.lit(0).cast("bigint")
    none = F.lit(None).cast("bigint")
    start = F.struct(zero.alias("open"), zero.alias("grouped"), none.alias("euros"), none.alias("cents"),
                     F.lit(True).alias("ok"))

    def step(s: Column, t: Column) -> Column:
        number, unit = t["n"], t["u"]
        is_n = number.isNotNull()
        scale = F.when(unit == "k", F.lit(1000)).when(unit == "m", F.lit(1000000))
        is_scale = ~is_n & F.coalesce(unit.isin("k", "m"), F.lit(False))
        is_euro = ~is_n & F.coalesce(unit == "e", F.lit(False))
        is_cent = ~is_n & F.coalesce(unit == "c", F.lit(False)) & s["euros"].isNotNull()
        so_far = s["grouped"] + s["open"]
        return F.struct(
            F.when(is_n, s["open"] + number).when(is_scale | is_euro, zero).otherwise(s["open"]).alias("open"),
            F.when(is_scale, s["grouped"] + F.greatest(s["open"], F.lit(1)) * scale).when(is_euro, zero)
            .otherwise(s["grouped"]).alias("grouped"),
            F.when(is_euro, so_far).otherwise(s["euros"]).alias("euros"),
            F.when(is_cent, so_far).otherwise(s["cents"]).alias("cents"),
            (s["ok"] & (is_n | is_scale | is_euro | is_cent)).alias("ok"))

    return F.aggregate(typed, start, step, lambda s: F.when(
        s["ok"] & s["euros"].isNotNull(), s["euros"] * 100 + F.coalesce(s["cents"], zero)))


def words_to_cents_lenient(words: Column, folded: bool = False) -> Column:
    """As ``words_to_cents``; 'euro' is understood where the phrase leaves it out."""
    text = words if folded else fold(words)
    return F.when(F.length(text) > 0, words_to_cents(
        F.when(text.contains("ΕΥΡΩ"), text).otherwise(F.concat(text, F.lit(" ΕΥΡΩ"))), folded=True))


def _number_words() -> list[str]:
    hundreds = [stem + end for stem in fv.NUMBER_HUNDREDS for end in fv.HUNDRED_ENDINGS]
    return [*fv.NUMBER_UNITS, *fv.NUMBER_OTHER, *hundreds]


def shifted_words() -> dict[str, str]:
    """What a letter-shifting font prints -> the number word, where only one word fits.

    The table is the rule turned round: each number word in every form the font can give
    it. A printed form two words share is left out."""
    back: dict[str, str] = {}
    for printed, meant in fv.FONT_SHIFT.items():
        for letter in meant:
            back[letter] = back.get(letter, letter) + (printed if printed not in back.get(letter, letter) else "")
    plain = set(_number_words())
    forms: dict[str, set[str]] = {}
    for w in plain:
        for form in product(*[back.get(ch, ch) for ch in w]):
            forms.setdefault("".join(form), set()).add(w)
    return {form: next(iter(ws)) for form, ws in forms.items() if len(ws) == 1 and form not in plain}


def unshift_words(words: Column) -> Column:
    """Number words restored from a letter-shifting font; other tokens stay."""
    table = shifted_words()
    pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in table]), F.array(*[F.lit(v) for v in table.values()]))
    return F.array_join(F.transform(number_tokens(words), lambda t: F.coalesce(F.try_element_at(pairs, t), t)), " ")

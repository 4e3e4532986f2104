"""Text normalisation as Column expressions, correct for Greek and Latin script.

Everything stays in the JVM: ``translate`` with a map derived from the Unicode
decomposition rule, ``upper`` and ``regexp_replace``. Java's ``\\w`` is ASCII, so
patterns name Unicode classes (``\\p{L}``, ``\\p{N}``) instead.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin capitals that look like Greek ones, in both folding maps.
LOOKALIKES = ("ABEHIKMNOPTXYZ", "ΑΒΕΗΙΚΜΝΟΡΤΧΥΖ")
# Symbols some fonts print for Greek letters.
SYMBOLS = ("∆µΩ", "ΔμΩ")
SHIFTED_SIGMA = ("΢", "Σ")

LETTER_START = r"(?<!\p{L})"
LETTER_END = r"(?!\p{L})"


def word(pattern: str) -> str:
    """``pattern`` as a whole word: no letter on either side."""
    return f"{LETTER_START}(?:{pattern}){LETTER_END}"


@lru_cache(maxsize=1)
def _accent_map() -> tuple[str, str]:
    """(accented characters, their base letters) followed by the bare combining marks,
    which have no counterpart and are therefore dropped by ``translate``."""
    source, target, marks = [], [], []
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF or 0xAC00 <= cp <= 0xD7A3:  # surrogates; Hangul syllables part into letters, none of them a mark
            continue
        if unicodedata.category(ch) == "Mn":
            marks.append(ch)
            continue
        parts = unicodedata.normalize("NFD", ch)
        base = [c for c in parts if unicodedata.category(c) != "Mn"]
        if parts != ch and len(base) == 1:
            source.append(ch)
            target.append(base[0])
    return "".join(source + marks), "".join(target)


def strip_accents(c: Column) -> Column:
    source, target = _accent_map()
    plain = F.coalesce(c, F.lit(""))
    # ASCII text (as many bytes as characters) has no accents and skips the table
    return F.when(F.octet_length(plain) == F.length(plain), plain).otherwise(F.translate(plain, source, target))


#: Characters whose folding is looked up in one small table: ASCII, Latin-1, Greek letters, dashes and
#: quotes, the euro, the ohm and the increment sign. Texts of these alone take one pass instead of three.
COMMON = [*range(0x80), *range(0xA0, 0x100), *range(0x386, 0x3CF), *range(0x2010, 0x2028), *range(0x2030, 0x203B), 0x20AC, 0x2126, 0x2206]


@lru_cache(maxsize=4)
def _common_map(lookalikes: bool, repaired: bool) -> tuple[str, str, str]:
    """(pattern of texts of common characters, characters that change, what they become): symbols repaired where
    asked for, accents off, upper case, look-alikes made Greek where asked for."""
    plain = {a: b for a, b in zip(*_accent_map())}
    repair = str.maketrans(SYMBOLS[0] + SHIFTED_SIGMA[0], SYMBOLS[1] + SHIFTED_SIGMA[1]) if repaired else {}
    greek = str.maketrans(*LOOKALIKES) if lookalikes else {}
    becomes = {}
    for ch in map(chr, COMMON):
        base = ch.translate(repair)
        becomes[ch] = plain.get(base, base).upper().translate(greek)
    single = [ord(ch) for ch, x in becomes.items() if len(x) == 1]
    first = [n for n in single if n - 1 not in single]
    last = [n for n in single if n + 1 not in single]
    pattern = "^[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(first, last)) + "]*\\z"
    changed = {ch: x for ch, x in becomes.items() if len(x) == 1 and x != ch}
    return pattern, "".join(changed), "".join(changed.values())


def _in_one_pass(c: Column, slow: Column, lookalikes: bool, repaired: bool = False) -> Column:
    """``slow`` where the text has other characters than the common ones."""
    pattern, source, target = _common_map(lookalikes, repaired)
    plain = F.coalesce(c, F.lit(""))
    return F.when(plain.rlike(pattern), F.translate(plain, source, target)).otherwise(slow)


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[\s\p{Z}\x85]+", " "))


def upper_plain(c: Column) -> Column:
    """Accents off, upper case."""
    return _in_one_pass(c, F.upper(strip_accents(c)), lookalikes=False)


def fold(c: Column) -> Column:
    """Accents off, upper, look-alike Latin capitals made Greek, spaces collapsed."""
    return collapse(fold_in_place(c))


def fold_in_place(c: Column) -> Column:
    """``fold`` that keeps every column position (no space is collapsed)."""
    return _in_one_pass(c, F.translate(F.upper(strip_accents(c)), *LOOKALIKES), lookalikes=True)


def normalise_name(c: Column) -> Column:
    """Key of a name: accents, case, punctuation and spacing do not count."""
    return F.trim(F.regexp_replace(F.upper(F.regexp_replace(strip_accents(c), r"[^\p{L}\p{N}_]+", " ")), " +", " "))


def name_tokens(c: Column) -> Column:
    """Tokens of a normalised name with Latin look-alikes made Greek."""
    return F.filter(F.split(F.translate(normalise_name(c), *LOOKALIKES), " "), lambda t: t != "")


def letter_tokens(c: Column, longer_than: int = 2) -> Column:
    """Distinct runs of letters (accents off, upper) longer than ``longer_than``."""
    runs = F.regexp_extract_all(upper_plain(c), F.lit(r"(\p{L}+)"), 1)
    return F.array_distinct(F.filter(runs, lambda t: F.length(t) > longer_than))


def symbol_repair(c: Column) -> Column:
    # a search of bytes for each sign: a table would be asked for every character
    for printed, meant in zip(SYMBOLS[0] + SHIFTED_SIGMA[0], SYMBOLS[1] + SHIFTED_SIGMA[1]):
        c = F.replace(c, F.lit(printed), F.lit(meant))
    return c


def flat_fold(c: Column) -> Column:
    """A whole text as one folded line."""
    slow = F.translate(F.upper(strip_accents(symbol_repair(c))), *LOOKALIKES)
    return collapse(_in_one_pass(c, slow, lookalikes=True, repaired=True))


def iso_from_dmy(c: Column) -> Column:
    """'30/03/2018 10:44:26' -> '2018-03-30T10:44:26'; shorter text is left as it is."""
    t = F.coalesce(c, F.lit(""))
    iso = F.concat(F.substring(t, 7, 4), F.lit("-"), F.substring(t, 4, 2), F.lit("-"), F.substring(t, 1, 2),
                   F.lit("T"), F.substring(t, 12, 8))
    return F.when(F.length(t) >= 19, iso).otherwise(t)


def issue_day(c: Column) -> Column:
    """'dd/MM/yyyy HH:mm:ss' -> date; null when unreadable (the caller quarantines)."""
    t = F.trim(F.coalesce(c, F.lit("")))
    shape = t.rlike(r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$")
    return F.when(shape, F.try_to_timestamp(F.substring(t, 1, 10), F.lit("dd/MM/yyyy")).cast("date"))


def civil_date(ms: Column, zone: str = "Europe/Athens") -> Column:
    """Epoch milliseconds -> the calendar date at ``zone``."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_millis(ms), zone))


def utc_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def record_type(ref: Column) -> Column:
    """'24SYMV0001' -> 'SYMV': the two-digit year and the trailing digits dropped."""
    return F.regexp_replace(F.substring(ref, 3, 1 << 20), r"[0-9]+$", "")


def safe_cell(c: Column) -> Column:
    """Third-party text as one table cell: one line, pipes and tags escaped."""
    return F.replace(F.replace(collapse(F.coalesce(c, F.lit(""))), F.lit("|"), F.lit("\\|")), F.lit("<"), F.lit("&lt;"))


def cited_keys(text: Column, own: Column, pattern: str) -> Column:
    """Distinct identifiers of shape ``pattern`` in the folded text, less the document's own."""
    found = F.regexp_extract_all(flat_fold(text), F.lit(f"({pattern})"), 1)
    return F.array_except(F.array_distinct(found), F.array(own))

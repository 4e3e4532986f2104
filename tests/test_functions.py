"""Scalar functions on literal inputs."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from obolus import fixed_values as fv
from obolus.functions import codes, money, text


def one(spark, col, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(col.alias("y")).first()["y"]


@pytest.mark.parametrize("words, cents", [
    ("είκοσι επτά χιλιάδων διακοσίων εξήντα τριών ευρώ & πέντε λεπτών", 2726305),
    ("τρία εκατομμύρια τετρακόσιες χιλιάδες ευρώ", 340000000),
    ("χίλια δώδεκα ΕΥΡΩ και 44 λεπτά", 101244),
    ("επτά χιλιάδες", None),
    ("για την ύδρευση του οικισμού", None),
])
def test_number_words(spark, words, cents):
    assert one(spark, money.words_to_cents(F.col("x")), words) == cents


def test_amounts_glued_to_text_and_numbers_that_are_no_amounts(spark):
    got = one(spark, money.amounts_in(F.col("x"), fv.AMOUNT_IN_STATEMENT), "άρθρα 230,242 με 0,50% και τους17.950,00 άρ.3.329.159,47")
    assert got == [1795000, 332915947]


def test_malformed_column_keeps_its_place(spark):
    got = one(spark, money.amounts_at(F.col("x")), "  1  Α  1.000,00   50.0000,00  - €  3,50")
    assert [r["cents"] for r in got] == [100000, None, 0, 350]
    assert got[0]["end"] == 16


def test_letter_shifted_words_are_restored(spark):
    assert one(spark, money.unshift_words(F.col("x")), "ΕΙΚΟΖΙ ΗΕΖΖΑΠΩΝ ΧΙΛΙΑΔΩΝ ΛΕΠΗΩΝ ΧΧΧ") == "ΕΙΚΟΣΙ ΤΕΣΣΑΡΩΝ ΧΙΛΙΑΔΩΝ ΛΕΠΤΩΝ ΧΧΧ"


@pytest.mark.parametrize("printed, cents", [("29.700", 2970000), ("8,5", 850), ("1.234,56", 123456)])
def test_any_number(spark, printed, cents):
    assert one(spark, money.number_cents(F.col("x")), printed) == cents


@pytest.mark.parametrize("printed, cents", [("8,000.00", 800000), ("-.54", -54)])
def test_english_numbers(spark, printed, cents):
    assert one(spark, money.cents_en(F.col("x")), printed) == cents


def test_fold_and_names(spark):
    assert one(spark, text.fold(F.col("x")), "  Άγιος  AΠOΔOΣH ß ") == "ΑΓΙΟΣ ΑΠΟΔΟΣΗ SS"
    assert one(spark, text.normalise_name(F.col("x")), "Αφοί Μυλωνά, Ο.Ε.") == "ΑΦΟΙ ΜΥΛΩΝΑ Ο Ε"


def test_word_boundaries_are_unicode(spark):
    assert one(spark, F.col("x").rlike(text.word("ΚΑΠ")), "ΣΚΑΠΑΝΗ") is False
    assert one(spark, F.col("x").rlike(text.word("ΚΑΠ")), "ΑΠΟ ΚΑΠ 2016") is True


@pytest.mark.parametrize("code, scheme, major", [("00.8231.0004", "old", "82"), ("8211", "bare", "82"), ("055.2120102001", "new", "21"), ("K99", "unknown", None), (" ", None, None)])
def test_codes(spark, code, scheme, major):
    assert one(spark, codes.code_scheme(F.col("x")), code) == scheme
    assert one(spark, codes.code_major(F.col("x")), code) == major


@pytest.mark.parametrize("stamp, day", [("04/11/2024 02:00:00", date(2024, 11, 4)), ("30/06/2016 03:00:00", date(2016, 6, 30)), ("2016-06-30", None), (None, None), ("31/02/2016 00:00:00", None)])
def test_issue_day(spark, stamp, day):
    assert one(spark, text.issue_day(F.col("x")), stamp) == day


def test_civil_date_of_both_midnights(spark):
    # 2020-07-01 at local midnight, and at UTC midnight
    assert one(spark, text.civil_date(F.col("x")), 1593550800000, "bigint") == date(2020, 7, 1)
    assert one(spark, text.civil_date(F.col("x")), 1593561600000, "bigint") == date(2020, 7, 1)


def test_budget_year_is_not_a_school_year(spark):
    got = [one(spark, codes.budget_year(F.col("x"), F.lit(2015)), s) for s in ("ΚΑΠ έτους 2016", "σχολικό έτος 2022-2023", "Απόδοση")]
    assert got == [2016, 2015, 2015]


@pytest.mark.parametrize("key, ok", [("Ω25Α-ΟΜΘ", True), ("../x-Α", False), ("ω25-ομθ", False), ("Ω2\n-Α", False), ("Ω25Α-ΟΜΘ\n", False), ("", False), (None, False)])
def test_key_shapes(spark, key, ok):
    assert one(spark, codes.valid_key(F.col("x"), "decision"), key) is ok


def test_table_cell(spark):
    assert one(spark, text.safe_cell(F.col("x")), "a|b\n <i> c") == "a\\|b &lt;i> c"


def test_euros(spark):
    assert one(spark, money.euros(F.col("x")), 123456, "bigint") == Decimal("1234.56")


def test_one_pass_folds_as_three(spark):
    """Every code point alone and inside a Greek word: the table of common characters gives what accents off, upper
    case and look-alikes give one after the other; a text with one other character is folded the long way."""
    from obolus.functions import text as tx
    col = F.col("t")
    rows = spark.range(1, 0x110000).filter((F.col("id") < 0xD800) | (F.col("id") > 0xDFFF)).select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("ch")) \
        .select(F.explode(F.array("ch", F.concat(F.lit("Έργο "), "ch", F.lit("ab")))).alias("t"))
    edges = spark.createDataFrame([("",), (None,), ("∆ήµος ΢ύρου Ω €",), ("Straße Δήμος",)], "t string")
    rows = rows.unionByName(edges)
    repaired = F.translate(F.translate(col, *tx.SYMBOLS), *tx.SHIFTED_SIGMA)
    upper = lambda x: F.upper(tx.strip_accents(x))
    folded = lambda x: tx.collapse(F.translate(upper(x), *tx.LOOKALIKES))
    pairs = [(tx.upper_plain(col), upper(col)), (tx.fold(col), folded(col)), (tx.flat_fold(col), folded(repaired)), (tx.symbol_repair(col), repaired),
             (tx.fold_in_place(col), F.translate(upper(col), *tx.LOOKALIKES))]
    off = [F.sum(F.when(a.eqNullSafe(b), 0).otherwise(1)).alias(f"off{i}") for i, (a, b) in enumerate(pairs)]
    assert list(rows.agg(*off).first()) == [0] * len(pairs)

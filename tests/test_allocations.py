"""Allocation tables: an amount counts only when the document's own totals confirm it."""

import pytest

from obolus.plans import allocations as al

CODE = "58000"
NET = """\
  1     50100   ΑΛΦΑΣ              ΝΟΜΟΣ Α     1.187.818,76             0,00          52.377,90     1.135.440,86
                ΚΑΙ ΑΛΛΩΝ
  2     50110   ΒΗΤΑΣ              ΝΟΜΟΣ Α      518.568,43              0,00          18.467,92       500.100,51
  3     58000   ΝΗΣΙΔΟΣ            ΝΟΜΟΣ Β     197.677,98             0,00           0,00           197.677,98
                              ΣΥΝΟΛΑ                1.904.065,17             0,00          70.845,82     1.833.219,35
"""
SUM = """\
  1  50100  ΑΛΦΑΣ   ΝΟΜΟΣ   100,00   50,00   150,00
  2  58000  ΝΗΣΙΔΟΣ ΝΟΜΟΣ   121.570,34   115.031,59   236.601,93
          ΣΥΝΟΛΟ                121.670,34   115.081,59   236.751,93
"""
BREAKDOWN = """\
  1  50100  ΑΛΦΑΣ    Α   1.000,00   10,00   0,00     990,00
  2  59400  ΒΗΤΑΣ    Β   2.000,00   20,00   5,00   1.980,00
  3  58000  ΝΗΣΙΔΟΣ  Γ     500,00    0,00   0,00     500,00
       ΣΥΝΟΛΟ              3.500,00   30,00   5,00   3.470,00
"""
BLANKS = """\
  1  50100  ΑΛΦΑΣ       Α   1.000,00         5,00        995,00
  2  50110  ΒΗΤΑΣ       Β   2.000,00                   2.000,00
                ΚΑΙ ΜΙΚΡΩΝ
  3  58200
                ΝΟΜΟΣ       Γ     300,00         0,00        300,00
  4  58000  ΝΗΣΙΔΟΣ     Δ     400,00         0,00        400,00
        ΣΥΝΟΛΟ              3.700,00         5,00      3.695,00
"""


ROUND = "  1  50100  Α  Β  33,33\n  2  58000  ΝΗΣΙΔΟΣ  Γ  66,66\n  ΣΥΝΟΛΟ  100,00\n"
STATED = "  1  50100  ∆ΕΛΤΑΣ  Β  1.000,00\n  2  58000  ΝΗΣΙΔΟΣ  Γ  87,60\n με το ποσό # 1.087,60 € #"
TEXTS = {
    "net": (None, NET), "unseen": (None, NET.replace("  2     50110   ΒΗΤΑΣ", "        ΒΗΤΑΣ")),
    "lone": (None, NET.replace("  2     50110   ΒΗΤΑΣ", "  2             ΒΗΤΑΣ")), "stray": (None, NET.replace("  2     50110   ΒΗΤΑΣ", "  7             ΒΗΤΑΣ")),
    "sum": (None, SUM), "breakdown": (None, BREAKDOWN), "blanks": (None, BLANKS), "round": (None, ROUND), "off": (None, ROUND.replace("100,00", "101,00")),
    "stated": (None, STATED), "misstated": (None, STATED.replace("# 1.087,60", "# 1.087,61")), "subject": ("συνολικού ποσού 1.087,60€", STATED.replace("#", "")),
    "restart": (None, "  1  50100  Α  Β  1,00\n  2  50110  Β  Γ  2,00\n  1  58000  ΝΗΣΙΔΟΣ  Γ  3,00\n  ΣΥΝΟΛΟ  3,00\n"),
    "absent": (None, "  1  50100  Α  Α  100,00\n  2  50200  Β  Β  50,00\n  ΣΥΝΟΛΟ  150,00\n"),
    "letter": (None, "ποσό των δύο χιλιάδων ευρώ (2.000,00 €). Διαχειριστής ο Δήμος Νησίδος"), "nothing": (None, "τίποτε"),
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, *v) for k, v in TEXTS.items()], "doc_id string, subject string, text string")


@pytest.fixture(scope="module")
def tables(docs):
    return al.read_tables(docs).orderBy("doc_id", "table").collect()


@pytest.fixture(scope="module")
def ours(docs):
    return al.target_lines(al.read_tables(docs), CODE).collect()


@pytest.fixture
def read(tables, ours):
    return lambda key: ([t for t in tables if t["doc_id"] == key], [x for x in ours if x["doc_id"] == key])


def test_gross_withholdings_net(read):
    tables, (line,) = read("net")
    assert (tables[0]["layout"], tables[0]["validation"]) == ("net", "column_totals")
    assert (line["amount"], line["net"], line["validation"], line["n_rows"]) == (19767798, 19767798, "column_totals", 3)


def test_a_row_that_cannot_be_seen_leaves_the_table_unvalidated(read):
    _, (line,) = read("unseen")
    assert line["validation"] is None


def test_a_numbered_row_without_code_counts_in_sequence_only(read):
    tables, (line,) = read("lone")
    assert [r["code"] for r in tables[0]["rows"]] == ["50100", "", "58000"] and line["validation"] == "column_totals"
    _, (line,) = read("stray")
    assert line["validation"] is None


def test_components_then_total(read):
    _, (line,) = read("sum")
    assert (line["layout"], line["amount"], line["validation"]) == ("sum", 23660193, "column_totals")


def test_a_breakdown_column_enters_no_net(read):
    tables, _ = read("breakdown")
    assert (tables[0]["layout"], list(tables[0]["signs"])) == ("net", [-1, 0])


def test_rounding_within_tolerance(read):
    tables, _ = read("round")
    assert tables[0]["validation"] == "column_totals"
    tables, _ = read("off")
    assert tables[0]["validation"] is None


def test_blank_cells_and_wrapped_rows(read):
    tables, _ = read("blanks")
    assert len(tables[0]["rows"]) == 4 and tables[0]["validation"] == "column_totals"
    assert tables[0]["rows"][1]["amounts"] == [200000, 0, 200000]


def test_one_column_against_a_stated_amount_and_symbols(read):
    tables, (line,) = read("stated")
    assert (tables[0]["validation"], line["amount"]) == ("stated_amount", 8760)
    assert read("misstated")[1][0]["validation"] is None
    assert read("subject")[1][0]["validation"] == "stated_amount"


def test_numbering_that_starts_again_is_another_table(read):
    tables, _ = read("restart")
    assert [(len(t["rows"]), t["validation"]) for t in sorted(tables, key=lambda t: t["table"])] == [(2, None), (1, "column_totals")]


def test_reading_order(docs):
    got = {r["doc_id"]: (r["status"], r["method"], r["amount"]) for r in al.read_decisions(docs, CODE, r"ΔΙΑΧΕΙΡΙΣΤ[^.]{0,80}ΝΗΣΙΔΟΣ").collect()}
    assert got["sum"] == ("read", "table", 23660193)
    assert got["absent"] == ("absent", None, None)
    assert got["letter"] == ("read", "letter", 200000)
    assert got["nothing"] == ("not_found", None, None)


def test_a_long_document_takes_time_with_its_length(spark):
    """Tables of a document of 50,000 lines: rows, numbered lines that go on counting, a second table."""
    import time
    rows = [f"  {i}  {50000 + i % 9000:05d}  ΔΗΜΟΣ {i}    1.000,00    {i}00,00" for i in range(1, 9_000)]
    lone = [f"  {i}  ΣΥΝΔΕΣΜΟΣ ΔΗΜΩΝ    1.000,00    500,00" for i in range(9_000, 9_999)]
    docs = lambda n: spark.createDataFrame([("d", None, "\n".join((rows + lone + ["  ΣΥΝΟΛΟ   9,00   9,00"]) * n))], "doc_id string, subject string, text string")
    took = []
    for n in (1, 5):
        t = time.perf_counter()
        got = al.allocation_tables(docs(n)).selectExpr("table", "size(rows) AS n", "totals").collect()
        took.append(time.perf_counter() - t)
        assert sorted((r["table"], r["n"], tuple(r["totals"])) for r in got) == [(k, 9_998, (900, 900)) for k in range(n)]
    assert took[1] < 5 * took[0] + 20


def test_lone_lines_between_rows(spark):
    text = ("  1  50001  ΑΛΦΑ   10,00\n  2  ΧΩΡΙΣ ΚΩΔΙΚΟ   20,00\n  7  ΑΛΛΟ ΠΡΑΓΜΑ   70,00\n  3  ΚΙ ΑΛΛΟΣ   30,00\n  4  50004  ΔΕΛΤΑ   40,00\n  ΣΥΝΟΛΟ 100,00\n  5  ΜΕΤΑ ΤΟ ΣΥΝΟΛΟ   5,00\n"
            "  1  50001  ΑΛΦΑ   1,00\n  2  50002  ΒΗΤΑ   2,00\n  1  50001  ΑΛΦΑ   3,00\n  ΣΥΝΟΛΟ 3,00\n  ΣΥΝΟΛΟ 9,00\n")
    docs = spark.createDataFrame([("d", None, text), ("none", None, "κείμενο\n  3  ΧΩΡΙΣ ΓΡΑΜΜΗ ΠΡΙΝ  1,00")], "doc_id string, subject string, text string")
    got = {(r["doc_id"], r["table"]): ([x["number"] for x in r["rows"]], r["totals"]) for r in al.allocation_tables(docs).collect()}
    assert got == {("d", 0): ([1, 2, 3, 4], [10000]), ("d", 1): ([1, 2], None), ("d", 2): ([1], [300])}

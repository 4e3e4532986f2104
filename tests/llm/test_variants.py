"""Operators 11 to 13 against plain versions of their contracts, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obolus.llm import decontaminate, spelling, whitening
from obolus.llm.common import UPPER, LOWER

LOWERED = str.maketrans(UPPER, LOWER)


# ---- 11: spelling variants

def plain_vocabulary(rows, loses=97):
    counts = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWERED)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if loses and h % loses == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_groups(words):
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    close = {w: [x for x in words if x != w and near(w, x)] for w in words}
    form = {}
    for w, xs in close.items():
        if xs and words[best := min(xs, key=lambda x: (-words[x], x))] >= 2 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), n, len(close[w]), words.get(form.get(w))) for w, n in words.items())


def variants(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def random_words(seed, count):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abÿà") for _ in range(rng.randint(5, 14))) for _ in range(count)]
    for w in list(base):
        i = rng.randrange(len(w))
        base += [w[:i] + w[i + 1:], w[:i] + rng.choice("abc") + w[i:], w[:i] + rng.choice("abcñ") + w[i + 1:]]
    return base


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_as_pairs_compared_one_by_one(docs, seed):
    rng = random.Random(seed)
    words = random_words(seed, 60)
    rows = [(i, " ".join(rng.choice(words).title() for _ in range(150)) + ", 1x") for i in range(12)]
    assert variants(spelling.group(spelling.vocabulary(docs(*rows)))) == plain_groups(plain_vocabulary(rows))


def test_variants_of_doubled_letters_count_once(docs):
    rows = [(1, "aaaaaa " * 10 + "aaaaa " * 4 + "baaaaa " * 3 + "aaaaaaa " * 25)]
    got = variants(spelling.group(spelling.vocabulary(docs(*rows), loses=None)))
    assert got == plain_groups(plain_vocabulary(rows, None))
    assert ("aaaaa", "aaaaaa", "aaaaaaa", 4, 2, 10) in got  # the root is two steps away


def test_long_words_take_room_with_their_length(docs):
    long = "".join(random.Random(5).choice("abcdefgh") for _ in range(20_000))
    rows = [(1, " ".join([long] * 7 + [long[:9_000] + long[9_001:]] * 3 + [long[:-1] + "z"] * 3))]
    got = {r["word"]: r for r in spelling.group(spelling.vocabulary(docs(*rows), loses=None)).collect()}
    assert len(got) == 3 and got[long]["n_near"] == 2 and got[long]["form"] is None
    assert {r["root"] for r in got.values()} == {long}


def test_variants_of_nothing(docs, spark):
    rows = [(None, None), (1, ""), (2, "12 ? 3"), (None, "words words words")]
    assert variants(spelling.group(spelling.vocabulary(docs(*rows), loses=None))) == [("words", None, "words", 3, 0, None)]
    assert variants(spelling.group(spelling.vocabulary(docs((1, "x")).limit(0)))) == []
    clash = docs(*[(1, "Words words")] * 2).withColumns({c: F.lit("x") for c in ("word", "n", "run", "h")})
    assert variants(spelling.group(spelling.vocabulary(clash, loses=None))) == [("words", None, "words", 4, 0, None)]


def test_ids_in_the_hash(docs):
    rows = [(i, "running " * 3) for i in (None, 2 ** 53 + 1, *range(300))]
    got = {r["word"]: r["n"] for r in spelling.vocabulary(docs(*rows)).collect()}
    assert got == plain_vocabulary(rows) and len(got) > 1


# ---- 12: decontamination

def plain_words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWERED))


def plain_judged(docs, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        ws = plain_words(text)
        for i in range(max(1, len(ws) - size + 1) if ws else 0):
            windows[tuple(ws[i:i + size])].add(item)
    out = []
    for doc_id, text in docs:
        ws, inside, found = plain_words(text), set(), set()
        for i in range(len(ws)):
            for n in {len(w) for w in windows}:
                if i + n <= len(ws) and tuple(ws[i:i + n]) in windows:
                    inside |= set(range(i, i + n))
                    found |= windows[tuple(ws[i:i + n])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(ws), len(inside), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(inside)))
    return sorted(out, key=str)


def bench(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def judged(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (10, "zero ONE two three, four five six seven eight nine ten"), (2, "just four words here"),
         (3, ""), (4, None), (5, "Übung macht"), (None, "an item without its own number but with many more words than ten"), (2, "a second text of item two")]
TEXTS = [(1, "x one two three four five six seven eight nine ten eleven y"), (2, "one two three four five six seven eight nine"), (3, None), (4, ""), (5, "JUST four. words\nhere just four words here"),
         (6, "übung macht den Meister"), (6, "Übung macht"), (7, "so an item without its own number but with many more words than ten it is"), (None, "a second text of item two"), (None, "clean"),
         (8, "one " * 30), (9, "five six seven " + ITEMS[0][1] + " " + ITEMS[0][1])]


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 3])
def test_hits_as_windows_compared_one_by_one(spark, docs, block):
    texts = [*TEXTS, TEXTS[0], TEXTS[0]]
    assert judged(decontaminate.judge(docs(*texts), bench(spark, *ITEMS), block=block)) == plain_judged(texts, ITEMS)


def test_hits_of_random_words(spark, docs):
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choice("ab") for _ in range(200))) for i in range(30)]
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(1, 14)))) for i in range(9)]
    items = [x for x in items if len(x[1]) > 9]
    assert judged(decontaminate.judge(docs(*texts), bench(spark, *items))) == plain_judged(texts, items)


def test_hits_of_nothing(spark, docs):
    assert [r[2:4] for r in judged(decontaminate.judge(docs(*TEXTS[:3]), bench(spark, (1, "x")).limit(0)))] == [(0, 0)] * 3
    assert judged(decontaminate.judge(docs((1, "x")).limit(0), bench(spark, *ITEMS))) == []


def test_removed(spark, docs):
    extra = {"key": F.lit("k"), "hits": F.lit(1), "_id": F.lit(2), "n": F.lit(3)}
    rows = docs((1, "«Say»: Just FOUR words, here! And more."), (2, "clean, too"), (3, None), (4, "just four words here"), (5, "a just four words here just four words here b")).withColumns(extra)
    items = bench(spark, ITEMS[2]).withColumns(extra)
    cut = decontaminate.remove(rows, items)
    assert cut.columns == rows.columns
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {1: "«Say»: And more.", 2: "clean, too", 3: None, 4: "", 5: "a b"}
    whole = decontaminate.remove(rows, items, spans=False)
    assert whole.columns == rows.columns and sorted(r["doc_id"] for r in whole.collect()) == [2, 3]


def test_long_text_is_scanned_whole(spark, docs):
    text = "w " * 200_000 + ITEMS[0][1]
    assert judged(decontaminate.judge(docs((1, text)), bench(spark, ITEMS[0])))[0][1:4] == (200_012, 12, 1)


def test_decontamination_is_native(spark, docs):
    plan = decontaminate.judge(docs(*TEXTS), bench(spark, *ITEMS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# ---- 13: whitening

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("x", T.StringType())])


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "x") for i, v in rows], VECTORS)


def check_whitened(got, rows, components=4):
    """Against the eigenvectors of the covariance matrix by numpy."""
    m = np.array([np.floor(np.asarray(v, np.float32).astype(float) * 256) for _, v in rows]).astype(np.int64)
    distinct = np.unique(m, axis=0)
    n, sums = len(distinct), distinct.sum(0)
    a = distinct - sums / n
    values, axes = np.linalg.eigh(a.T @ a / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-9 * values.sum()).sum()))
    assert got.groupby("vec_id").size().eq(k).all() and (got["n"] == n).all() and got["identity_error"].max() < 1e-9
    for c in range(k):
        own = got[got["component"] == c + 1].set_index("vec_id")
        assert np.allclose(own["explained"], values[c] / values.sum(), rtol=1e-10)
        mine = own.loc[[i for i, _ in rows], "whitened"].to_numpy()
        if k == 1 or np.diff(values[max(0, c - 1):c + 2]).max(initial=-np.inf) < -1e-6 * values[0]:  # no tie: a single axis, either way
            ref = (m - sums / n) @ axes[:, c] / np.sqrt(values[c])
            assert min(np.abs(mine - ref).max(), np.abs(mine + ref).max()) < 1e-8
        dev = [int(((n * r.astype(object) - sums.astype(object)) ** 2).sum()) for r in m]
        assert own.loc[[i for i, _ in rows], "deviation"].tolist() == dev


@pytest.mark.parametrize("d,n", [(6, 40), (20, 200), (3, 50), (12, 5), (1, 9)])
def test_whitened_as_by_eigenvectors(spark, d, n):
    rng = np.random.default_rng(d)
    rows = [(i, rng.normal(0.1, 1, d) * np.linspace(2, 0.5, d)) for i in range(n)]
    rows += [(n + i, v) for i, (_, v) in enumerate(rows[:n // 2])]  # copies, which fit once
    check_whitened(whitening.whitened(vectors(spark, rows)).toPandas(), rows)


def test_equal_deviations_are_all_found(spark):
    rows = [(2 * i + s, (1 if s else -1) * np.eye(6)[i] * (1, 1, 1, 1, 1, 0.25)[i]) for i in range(6) for s in (0, 1)]
    rows += [(100, np.zeros(6))]
    got = whitening.whitened(vectors(spark, rows)).toPandas()
    check_whitened(got, rows)
    assert len(set(got["explained"].round(9))) == 1


def test_rows_that_are_no_vectors(spark):
    rows = [(2 ** 53 + 1, [1, 2]), (None, [3, 5]), (7, [4, 1]), (7, [4, 1])]
    bad = [(1, None), (2, [1, None]), (3, [float("nan"), 1]), (4, [float("-inf"), 1]), (5, []), (6, [1, 2, 3])]
    got = whitening.whitened(vectors(spark, rows + bad)).collect()
    assert sorted((str(r["vec_id"]), r["component"]) for r in got) == sorted((i, c) for i in ("9007199254740993", "None", "7", "7") for c in (1, 2))
    assert {r["n"] for r in got} == {3}


def test_whitening_of_nothing(spark):
    some = vectors(spark, [(1, [1, 2]), (2, [1, 2])])
    assert whitening.whitened(some).count() == 0  # equal rows only: no direction
    assert whitening.whitened(some.limit(0)).count() == 0
    assert whitening.whitened(some).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_sums_beyond_a_long_fail():
    with pytest.raises(OverflowError):
        whitening.deviations(np.array([[2 ** 40]]), 2 ** 20, np.array([0]))
    assert whitening.deviations(np.array([[2 ** 31 - 1]]), 1, np.array([0]))[0] == (2 ** 31 - 1) ** 2

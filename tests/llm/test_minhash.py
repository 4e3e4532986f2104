"""Near-duplicates against all pairs."""

import random
from collections import defaultdict

import pytest

from obolus.llm import components, minhash, queries

FOLDER = "/root/testdata/sf0.001"


def sets_of(texts, size):
    out = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        k = min(size, len(w))
        out[i] = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if w else frozenset()
    return out


def by_hand(texts, size, percent):
    """The smallest id reachable over links between all pairs that share a shingle."""
    sets = sets_of(texts, size)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    for a, b in pairs:
        n = len(sets[a] & sets[b])
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited(rng, words, kind, n):
    w = list(words)
    for _ in range(n):
        at = rng.randrange(len(w))
        if kind == "replace":
            w[at] = f"v{rng.randrange(30)}"
        elif kind == "delete":
            del w[at]
        elif kind == "insert":
            w.insert(at, f"v{rng.randrange(30)}")
    return w[:len(w) - n] if kind == "cut" else w


def family(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(3):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice((60, 120, 200)))]
        for _ in range(60):
            w = base
            for kind in rng.sample(["replace", "delete", "insert", "cut"], rng.choice((1, 1, 2))):
                w = edited(rng, w, kind, rng.randrange(1, 9))
            texts.append(" ".join(w))
        texts += [" ".join(base)] * 5
        second = edited(rng, base, "replace", 12)  # a family of its own, near the first
        texts += [" ".join(edited(rng, second, "replace", rng.randrange(4))) for _ in range(20)]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("seed,size,percent", [(1, 3, 85), (2, 5, 80)])
def test_components_of_families(spark, docs, seed, size, percent):
    texts = family(seed)
    want = by_hand(texts, size, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.groups(docs(*texts), size, percent).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) > 5


def test_hot_pivot_in_chunks(spark, docs, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 7)
    texts = family(4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.groups(docs(*texts), 3, 85).collect()} == by_hand(texts, 3, 85)


def test_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = by_hand([(r.doc_id, r.text) for r in rows], 3, 85)
    got = queries.QUERIES["op5_near_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(spark, docs):
    long = " ".join(f"w{i}" for i in range(30000))
    df = docs((1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, long), (8, long + " x"), (8, long + " x"), (None, "one two"), (None, "alone here"))
    rows = minhash.groups(df.selectExpr("*", "1 as n", "2 as pivot", "3 as component_id"), 3, 85).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 29998, 7, True), (8, 29999, 7, False),
                          (8, 29999, 7, False), (None, 1, 6, False), (None, 1, None, True)], key=str)
    assert minhash.groups(docs(), 3, 85).count() == 0
    kept = minhash.keep_one(df.selectExpr("*", "1 as _dropped", "2 as _row"), 3, 85)
    assert kept.columns == [*df.columns, "_dropped", "_row"] and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "6", "7", "None", "None"]


def test_words_and_shingles():
    assert len(minhash.shingles("A b\tc\x0bd a B c", 3)) == 4  # abc bcd cda dab: abc comes twice
    assert (minhash.shingles("ÀB c", 5) == minhash.shingles("Àb  C", 5)).all()
    assert (minhash.shingles("a b", 5) != minhash.shingles("a b", 5)).all()


def test_connected(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)] + [(None, 1), (7, None), (5, 5)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for n in sorted(near):
        if n not in want:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = n
                    todo += near[x]
    assert got == {n: r for n, r in want.items() if n != r}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_id_on_two_texts(spark, docs):
    """Components are of texts: an id that stands on two of them does not make them one, nor lose the links of either."""
    rng = random.Random(9)
    a, b = (" ".join(f"{x}{rng.randrange(900)}" for _ in range(80)) for x in "ab")
    rows = [(1, a), (1, b), (2, a + " zz"), (3, b + " zz"), (4, a + " yy"), (5, b + " yy"), (6, "something else here")]
    got = sorted((r.doc_id, r.component_id) for r in minhash.groups(docs(*rows), 3, 85).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 6)]
    far = sorted((r.doc_id, r.component_id) for r in minhash.groups(docs(*[(i + 10, t) if i == 1 and t == b else (i, t) for i, t in rows]), 3, 85).collect())
    assert far == [(1, 1), (2, 1), (3, 3), (4, 1), (5, 3), (6, 6), (11, 3)]


def test_great_ids_beside_nulls(docs):
    big = 2 ** 53 + 1
    rows = [(big, "one two three four"), (big + 2, "five six seven eight"), (None, None)]
    assert {r.doc_id for r in minhash.signatures(docs(*rows), 3).collect()} == {big, big + 2, None}
    got = minhash.groups(docs(*rows), 3, 85).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(big, big), (big + 2, big + 2), (None, None)}
    assert {r.doc_id for r in minhash.keep_one(docs(*rows), 3, 85).collect()} == {big, big + 2, None}

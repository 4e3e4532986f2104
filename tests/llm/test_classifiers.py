"""Classifiers: held-out accuracy on the given tables, odd rows, tables without labels."""

import numpy as np
import pytest

from obolus.llm import common, language_id, quality_classifier, queries, toxicity

FOLDER = "/root/testdata/sf0.01"
ODD = [(1, None, None), (2, "", "en"), (3, "12 + 3", "de"), (4, "x" * 300000, None), (5, "the same words here", "en"), (5, "the same words here", "en"), (None, "words without an id", "en")]


def labelled(spark, name, label, folder=FOLDER):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return [r for r in queries.QUERIES[name](spark, folder).join(labels, "doc_id").collect()], label


def test_language(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op10_language_id"](spark, FOLDER).collect()
    out = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and 0.15 < len(out) / len(rows) < 0.35
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) < 0.01 * len(rows)


def test_quality(spark):
    rows, label = labelled(spark, "op7_quality_classifier", "quality")
    out = [r for r in rows if r.held_out]
    assert sum(r.predicted == r[label] for r in out) / len(out) > 0.95


def test_toxicity(spark):
    rows, label = labelled(spark, "op3_toxicity", "toxic", "/root/testdata/sf0.1")  # the smaller table has 33 toxic rows to learn from
    out = [r for r in rows if r.held_out]
    clean, toxic = [r.score for r in out if not r[label]], [r.score for r in out if r[label]]
    assert np.mean([t > c for t in toxic for c in clean]) > 0.95 and np.mean([c >= 0.7 for c in clean]) < 0.01 and np.mean([t >= 0.7 for t in toxic]) > 0.7


def test_pairs_of_terms_are_learned():
    """Toxic only where an insult and a group's name stand together: no weight per term can tell."""
    rng = np.random.default_rng(1)
    texts, y = [], []
    for _ in range(1500):
        words = [f"w{rng.integers(300)}" for _ in range(12)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join(words + ["zork"] * insult + ["flims"] * group))
        y.append(insult and group)
    y = np.array(y, float)
    m = toxicity.train([toxicity.terms_of(t) for t in texts], y, epochs=20)
    raw = {k: m.raw(toxicity.terms_of(k)) for k in ("zork", "flims", "zork flims", "")}
    assert raw["zork flims"] > 0 and max(raw["zork"], raw["flims"], raw[""]) < 0
    pair = raw["zork flims"] - raw["zork"] - raw["flims"] + raw[""]
    assert pair > 1


def test_a_pair_is_learned_of_which_one_term_tells_nothing():
    """The group's name is in 30 % of all rows, toxic or not; beside the insult it decides."""
    rng = np.random.default_rng(2)
    texts, y = [], []
    for i in range(4000):
        words = [f"w{rng.integers(300)}" for _ in range(12)]
        insult, slur = i % 40 == 0, i % 20 == 7
        group = i % 200 == 0 if insult else rng.random() < 0.3
        texts.append(" ".join(words + ["zork"] * insult + ["flims"] * group + ["blurgh"] * slur))
        y.append(slur or insult and group)
    y, rows = np.array(y, float), [toxicity.terms_of(t) for t in texts]
    assert not toxicity._tied(rows, y)[toxicity.zlib.crc32(b"flims") % toxicity.DIM]
    m = toxicity.train(rows, y)
    raw = {k: m.raw(toxicity.terms_of(k)) for k in ("zork", "flims", "zork flims", "")}
    assert raw["zork flims"] > 0 > max(raw["zork"], raw["flims"], raw[""]) and raw["zork flims"] - raw["zork"] - raw["flims"] + raw[""] > 1


def test_odd_rows(spark, docs):
    df = docs(*ODD).selectExpr("*", "1 as score", "2 as held_out", "3 as y")
    learn = docs(*[(i, f"the words of text number {i} and some more " * 3, "en") for i in range(40)], *[(100 + i, f"der die das und {i} oder ein text " * 3, "de") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(40)] + [(3, None, None)], "doc_id long, quality int, toxic int")
    model = language_id.fit(learn, ~language_id.held_out())
    got = [(r.doc_id, r.lang_pred, r.rejected) for r in language_id.identify(df, model).collect()]
    assert got[:3] == [(1, "und", True), (2, "und", True), (3, "und", True)] and len(got) == len(ODD) and got[4][1] == "en"
    assert language_id.keep_known(df, model).columns == df.columns
    for module, label in ((toxicity, "toxic"), (quality_classifier, "quality")):
        rows = module.score(df, module.fit(learn, labels)).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows) and rows[4].score == rows[5].score and rows[-1].held_out is False
        empty = module.score(df, module.fit(learn, labels.limit(0))).collect()
        assert len({r.score for r in empty}) == 1
        assert module.score(docs(), module.fit(docs(), labels)).count() == 0
    nothing = language_id.fit(docs(), ~language_id.held_out())
    assert {r.lang_pred for r in language_id.identify(df, nothing).collect()} == {"und"}


def test_trees_fit_what_a_line_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(quality_classifier.NAMES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality_classifier.train(x[:1500], y[:1500])
    assert ((trees.score(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.95
    by_hand = np.full(5, trees.start)
    for i in range(5):
        for r in trees.root:
            k = r
            while trees.left[k] != k:
                k = trees.left[k] if x[i, trees.feature[k]] <= trees.limit[k] else trees.right[k]
            by_hand[i] += trees.value[k]
    assert np.allclose(by_hand, trees.raw(x[:5]))


def test_samples_are_bounded(spark):
    from obolus.llm.common import bounded_sample
    labels = spark.range(1000).selectExpr("id as doc_id", "cast(id % 10 = 0 as int) as y")
    got = bounded_sample(labels, "y", 100).collect()
    assert len(got) == 100 and sum(r.y for r in got) == 50 and got == bounded_sample(labels.repartition(7), "y", 100).collect()


@pytest.mark.parametrize("text", ["a b a b", "Aa  bB\n\ncc", "é" * 10])
def test_counts_of_trigrams_do_not_depend_on_the_piece(monkeypatch, text):
    whole = language_id.counts_of(text * 50)
    monkeypatch.setattr(language_id, "PIECE", 7)
    assert (language_id.counts_of(text * 50) == whole).all()


BIG = 2 ** 53 + 1


def test_great_ids_beside_nulls(spark, docs):
    rows = docs((BIG, "some words"), (None, "other words"), (BIG + 2, None))
    some = spark.createDataFrame([(BIG, 1, 1), (BIG + 2, 0, 0)], "doc_id long, quality long, toxic long")
    for df in (toxicity.score(rows, toxicity.fit(rows, some)), quality_classifier.score(rows, quality_classifier.fit(rows, some)),
               language_id.identify(rows, language_id.fit(rows, ~language_id.held_out()))):
        assert {r.doc_id for r in df.collect()} == {BIG, BIG + 2, None}


def test_bounded_sample(spark):
    """The lowest hashes of each label, labels in turn, from a table of which only a share is ranked."""
    rows = spark.range(40_000).selectExpr("id as doc_id", "case when id % 100 = 0 then 'rare' when id % 3 = 0 then 'some' else 'most' end as y")
    got = common.bounded_sample(rows, "y", 300).collect()
    assert len(got) == 300
    hashes = {r.doc_id: r.h for r in rows.selectExpr("doc_id", "xxhash64(doc_id) as h").collect()}
    label = {r.doc_id: r.y for r in rows.collect()}
    for y in ("rare", "some", "most"):
        first = sorted((h, i) for i, h in hashes.items() if label[i] == y)[:100]
        assert {r.doc_id for r in got if r.y == y} == {i for _, i in first}
    assert common.bounded_sample(rows.limit(0), "y", 5).count() == 0
    plan = common.bounded_sample(rows, "y", 300)._jdf.queryExecution().toString()
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan


def test_an_id_on_most_rows_brings_one_text(spark, docs):
    rows = docs(*[(7, f"text {i % 50}") for i in range(500)], (8, "another"))
    picked = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, y int")
    got = common.sampled_texts(rows.select("doc_id", "text"), picked, "y").collect()
    assert sorted((r.doc_id, r.y) for r in got) == [(7, 1), (8, 0)]


def test_pairs_of_terms_that_tell_nothing_alone():
    """Nine in ten texts with both terms are toxic, none with one of them, and of the others so many that either
    term alone is as often in toxic texts as in others."""
    import random
    rng = random.Random(3)
    words = [f"word{i}" for i in range(500)]
    rows, labels, both, one = [], [], [], []
    for i in range(4000):
        a, b = i % 10 < 3, i // 10 % 10 < 3
        t = toxicity.terms_of(" ".join([*rng.sample(words, 25), *["insultword"] * a, *["groupname"] * b]))
        rows.append(t)
        labels.append(float(rng.random() < (0.9 if a and b else 0.0 if a or b else 0.9 * 0.3 / 0.7)))
        (both if a and b else one if a != b else []).append(t)
    labels = np.array(labels)
    at = [toxicity.terms_of(x)[0] for x in ("insultword", "groupname")]
    assert not toxicity._tied(rows, labels)[at].any()
    machine = toxicity.train(rows, labels)
    assert np.mean([machine.raw(t) > 0 for t in both]) > 0.95 and np.mean([machine.raw(t) > 0 for t in one]) < 0.05


def test_margin_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(5)
    place = np.full(toxicity.DIM, -1, np.int32)
    place[:6] = np.arange(6)
    m = toxicity.Machine(0.5, place, rng.normal(size=6), rng.normal(size=(6, toxicity.FACTORS)))
    terms = np.array([0, 2, 3, 5, 9])
    plain = 0.5 + sum(m.weight[i] for i in (0, 2, 3, 5)) + sum(m.factor[i] @ m.factor[j] for i in (0, 2, 3, 5) for j in (0, 2, 3, 5) if i < j)
    assert abs(m.raw(terms) - plain) < 1e-9


def test_languages_by_the_nearest_centroid(spark, docs):
    """Each text against all centroids, one by one."""
    rows = docs(*[(i, t, lang) for lang, ts in {"en": ["the cat sat on the mat and the dog", "this is the house that they built"], "de": ["der hund und die katze sind im haus", "das ist nicht der weg zum haus"]}.items()
                  for i, t in enumerate(ts * 10, 0 if lang == "en" else 100)])
    model = language_id.fit(rows, ~language_id.held_out())
    for text in ("the dog and the house", "die katze im haus", "mat", "zum weg", "qqq xxx"):
        at, v = language_id.vector_of(text, model.idf)
        dense = np.zeros(language_id.DIM)
        dense[at] = v
        cos = [float(dense @ c) for c in model.centroids]
        best = int(np.argmax(cos))
        lang, score, rejected = model.predict(text)
        assert lang == model.languages[best] and abs(score - min(1, max(0, cos[best]))) < 1e-5 and rejected == (cos[best] < model.floors[best])


def test_tree_gains_as_tried_one_by_one():
    """The first cut of the first tree is the best of all cuts at the histogram's edges."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3))
    y = (x[:, 1] + 0.1 * rng.normal(size=400) > 0.3).astype(float)
    trees = quality_classifier.train(np.pad(x, ((0, 0), (0, len(quality_classifier.NAMES) - 3))), y)
    share = y.mean()
    g, h = y - share, np.full(400, share * (1 - share))
    gain = lambda low: g[low].sum() ** 2 / (h[low].sum() + quality_classifier.L2) + g[~low].sum() ** 2 / (h[~low].sum() + quality_classifier.L2)
    f, limit = trees.feature[trees.root[0]], trees.limit[trees.root[0]]
    assert f == 1
    edges = np.unique(np.quantile(x[:, 1], np.linspace(0, 1, quality_classifier.BINS + 1)))
    assert gain(x[:, 1] <= limit) >= 0.98 * max(gain(x[:, 1] <= e) for e in edges[1:-1])

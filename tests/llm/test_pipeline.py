"""The pipeline: each stage against a plain version of it, on its own input."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from obolus.llm import language_id, minhash
from tests.llm.test_minhash import by_hand
from tests.llm.test_tokens import check_pieces

FOLDER = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that go into each stage and come out of the last."""
    at = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.unionByName(docs.limit(30)).selectExpr("*", "source as `_row`", "doc_id as kept")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], FOLDER).write.parquet(f"{at}/{k}")
        out.append(spark.read.parquet(f"{at}/{k}"))
    return out


def test_columns_and_order(stages):
    assert [s.columns for s in stages[:-1]] == [stages[0].columns] * (len(stages) - 1)
    n = [s.count() for s in stages[:-1]]
    assert n == sorted(n, reverse=True) and n[-1] > 100


def test_language(spark, stages):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language_id.fit(docs, ~language_id.held_out())
    assert stages[1].count() == sum(not model.predict(r.text)[2] for r in stages[0].collect()) > 0.98 * stages[0].count()


def test_quality(stages):
    texts = {r.doc_id: r.text for r in stages[1].collect()}
    for r in stages[2].collect():
        assert len(texts[r.doc_id].split()) >= 20 and set(r.text.split("\n")) <= set(texts[r.doc_id].split("\n")) and r.n_chars == len(r.text)
        assert 2 * len(r.text.split()) >= len(texts[r.doc_id].split())


def test_exact(stages):
    want = {}
    for r in stages[2].collect():
        want[r.text] = max(want.get(r.text, -1), r.doc_id)
    assert sorted((r.text, r.doc_id) for r in stages[3].collect()) == sorted(want.items())


def test_near(stages):
    want = by_hand([(r.doc_id, r.text) for r in stages[3].collect()], 5, 80)
    assert sorted(r.doc_id for r in stages[4].collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    assert minhash.keep_one(stages[4]).count() == stages[4].count()


def test_packing(stages):
    assert check_pieces(stages[5].collect(), {r.doc_id: r.text for r in stages[4].collect()}) < 0.02


def test_run_is_registered(spark, stages):
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_the_driver_gives_back_what_a_stage_held(spark, stages, monkeypatch):
    """The check's driver went past its limit in the stage after models were fitted and dropped."""
    given = []
    monkeypatch.setattr(corpus_pipeline, "give_back", lambda: given.append(1), raising=False)
    corpus_pipeline.run(spark, FOLDER)
    assert len(given) == len(corpus_pipeline.STAGES) - 1


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_without_the_subpackage(tmp_path):
    """The rest imports, and offers its own queries, where this subpackage and the pipeline are gone."""
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q); assert not any(x.startswith('op1_') or x == 'pipeline' for x in q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)

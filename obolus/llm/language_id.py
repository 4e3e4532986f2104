"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed byte trigrams, log term frequency times inverse document frequency,
normalised to length 1. Document frequencies are counted over all rows of the learning folds, in
the tasks. Centroids come from spherical k-means, language by language, over a sample of at most
``SAMPLE`` rows (languages in turn), which is what the driver holds: ``SAMPLE`` x ``DIM`` floats.
A text gets the language of the centroid with the largest cosine; the cosine is its score.

Rejection is by distance: a text whose cosine is below its centroid's floor (a third of the
first percentile of the language's sample) is marked ``rejected``, as is one without a letter.

Defined results: a null text, an empty one or one without a letter: `und`, score 0, rejected. Ties
between centroids go to the first language by name. With no row to learn from, every text is `und`.
Only doc_id (for the folds), text and lang are read, lang in the learning folds alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import PandasUDFType

from obolus.llm.common import bounded_sample, by_batch, frames, give_back, remainder, sampled_texts

DIM = 4096
#: The bound of the sample that the centroids are fitted on.
SAMPLE = 4000
CENTROIDS = 4
#: Share of the sample's first percentile below which a cosine means another language or no text.
FLOOR = 1 / 3
#: Rows for each centroid from which a language tells its own floor; with fewer the lowest of the others' holds.
FEW = 5
#: Bytes of text looked at at once, so that a very long text needs no more memory than a short one.
PIECE = 1 << 20

#: ASCII letters lower-cased, other ASCII to a space, bytes of other characters as they are.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if chr(b).isalpha() or b > 127 else 32 for b in range(128)) + bytes(range(128, 256))
_LETTER = re.compile(r"[^\W\d_]")


def counts_of(text: str) -> np.ndarray:
    """How often each bucket's trigrams stand in a text."""
    raw = np.frombuffer(b" " + b" ".join(text.encode("utf-8", "surrogatepass").translate(_FOLD).split()) + b" ", np.uint8)
    out = np.zeros(DIM, np.int64)
    for i in range(0, max(1, len(raw) - 2), PIECE):
        b = raw[i:i + PIECE + 2].astype(np.uint32)
        code = b[:-2] * np.uint32(65599) + b[1:-1] * np.uint32(257) + b[2:]
        out += np.bincount((code * np.uint32(2654435761)) >> np.uint32(20), minlength=DIM)
    return out


def vector_of(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places and values of a text's vector, of length 1."""
    h = counts_of(text)
    at = np.flatnonzero(h)
    v = (1 + np.log(h[at])) * idf[at]
    return at, (v / (np.linalg.norm(v) or 1.0)).astype(np.float32)


@dataclass
class Model:
    languages: list[str]      #: of each centroid
    centroids: np.ndarray     #: centroids x DIM
    floors: np.ndarray        #: of each centroid
    idf: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not _LETTER.search(text) or not self.languages:
            return "und", 0.0, True
        at, v = vector_of(text, self.idf)
        cos = self.centroids[:, at] @ v
        k = int(np.argmax(cos))
        return self.languages[k], float(min(1.0, max(0.0, cos[k]))), bool(cos[k] < self.floors[k])


def _clusters(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from the rows farthest from each other; as many centroids as differ."""
    seeds = [int(np.argmax(x @ x.mean(0)))]
    near = x @ x[seeds[0]]
    while len(seeds) < min(k, len(x)) and near.min() < 1 - 1e-6:
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def fit(docs: DataFrame, learn: Column, sample: int = SAMPLE, k: int = CENTROIDS) -> Model:
    """A model from the rows of ``docs`` where ``learn`` holds and lang and text are not null."""
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang")

    def frequencies(batches):
        df, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                df += counts_of(text) > 0
                n += 1
        yield pd.DataFrame({"bucket": np.arange(-1, DIM), "n": np.concatenate([[n], df])})

    found = {r["bucket"]: r["n"] for r in frames(rows.select("text"), frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    n = found.get(-1, 0)
    idf = np.log((1 + n) / (1 + np.array([found.get(i, 0) for i in range(DIM)]))) + 1

    picked = bounded_sample(rows.select("doc_id", "lang").distinct(), "lang", sample)
    vectors = by_batch(sampled_texts(rows, picked, "lang"), lambda b: pd.DataFrame(
        [(i, lang, at.astype(np.int32).tobytes(), v.tobytes()) for i, lang, (at, v) in zip(b["doc_id"], b["lang"], (vector_of(t, idf) for t in b["text"]))],
        columns=["doc_id", "lang", "at", "v"]), "doc_id long, lang string, at binary, v binary").collect()
    of: dict[str, list] = {}
    for r in sorted(vectors, key=lambda r: (r["lang"], r["doc_id"], r["at"])):
        of.setdefault(r["lang"], []).append(r)
    languages, centroids, floors = [], [], []
    for lang, rs in sorted(of.items()):
        x = np.zeros((len(rs), DIM), np.float32)
        for i, r in enumerate(rs):
            x[i, np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["v"], np.float32)
        c = _clusters(x, k)
        languages += [lang] * len(c)
        centroids.append(c)
        floors += [(FLOOR * float(np.quantile((x @ c.T).max(1), 0.01)), len(x))] * len(c)
    # where there are few rows, they are their own centroids and say nothing of how far others lie
    told = min((f for f, n in floors if n >= FEW * k), default=0.0)
    floors = [f if n >= FEW * k else min(f, told) for f, n in floors]
    return Model(languages, np.concatenate(centroids) if centroids else np.zeros((0, DIM), np.float32), np.array(floors), idf)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out (the fold no model learns from), lang_pred, score, rejected."""
    def run(b: pd.DataFrame) -> pd.DataFrame:
        got = [model.predict(t) for t in b["text"]]
        return pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "lang_pred": [g[0] for g in got], "score": [g[1] for g in got], "rejected": [g[2] for g in got]})
    return by_batch(docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text"), run,
                    "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def held_out() -> Column:
    return remainder(F.col("doc_id"), 4) == 2


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not rejected, with their columns."""
    @F.pandas_udf("boolean", PandasUDFType.SCALAR_ITER)
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in batches:
            yield pd.Series([not model.predict(t)[2] for t in text], dtype=bool)
        give_back()
    row = docs.select(F.struct("*").alias("_row"), known(F.col("text")).alias("_known"))
    return row.filter("_known").select("_row.*")

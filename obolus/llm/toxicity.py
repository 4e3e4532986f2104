"""Toxicity by a factorisation machine over hashed terms: beside a weight per term, the product of
two terms' vectors gives each pair a weight of its own (an insult next to a group's name), which
sums of term weights cannot express.

A text is the set of its hashed words and of their first ``STEM`` bytes, read to its end. The machine
is fitted on the driver with AdaGrad over at most ``SAMPLE`` labelled rows of the learning folds
(labels in turn); what the driver holds of a row is its buckets, at most ``DIM`` numbers. Every term in
a share ``FREQUENT`` of the sample's rows or more gets a weight and a vector, so that pairs of terms that
each tell nothing alone are learned; a rarer one only if the sample ties it to the label (chi-squared of
``TIED``, in ``MIN_ROWS`` rows or more), or ties it in the rows that hold such a term: the rare words of a
few toxic texts would else be learned with them. Terms that are not tied are held back by ``DECAY``.

Scores are set so that ``OPERATING`` lies where machines fitted on two thirds of the sample leave all but a
share ``SPARED`` of the other third's rows without the label below.

Defined results: null and empty texts have no terms; their score is the machine's bias. Labels that
are null teach nothing. With no labelled row, every score is 0. Repeated rows get equal scores.
Labels, lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obolus.llm.common import bounded_sample, by_batch, remainder, sampled_texts

DIM = 1 << 17
FACTORS = 4
#: The bound of the sample of labelled rows.
SAMPLE = 8000
MIN_ROWS = 4
STEM = 4
#: Chi-squared with one degree of freedom that chance exceeds in one term of a thousand.
TIED = 10.83
TIED_CHANCE = 0.001
#: Of the sample's rows: terms in so many get weights, tied or not; and how strongly those that are not are held back.
FREQUENT, DECAY = 0.05, 0.3
#: The score from which a text counts as toxic, and the share of others that may lie above it.
OPERATING, SPARED, PARTS = 0.7, 0.0005, 3
EPOCHS = 12
#: How much more a toxic row weighs than another: a missed one costs more than one too many.
HEAVY = 3.0
#: Distinct words whose buckets a task remembers.
KNOWN = 200_000

#: Bytes of words: ASCII letters lower-cased, digits, all other characters; the rest parts words.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))
_buckets: dict[bytes, tuple[int, int]] = {}


def terms_of(text: str | None) -> np.ndarray:
    """The distinct buckets of a text's words, ascending."""
    words = set((text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split())
    if len(_buckets) > KNOWN:
        _buckets.clear()
    out: set[int] = set()
    for w in words:
        b = _buckets.get(w)
        if b is None:
            b = _buckets[w] = (zlib.crc32(w) % DIM, zlib.crc32(b"^" + w[:STEM]) % DIM)
        out.update(b)
    return np.array(sorted(out), np.int32)


@dataclass
class Machine:
    bias: float
    place: np.ndarray     #: DIM: the row of a bucket in the arrays below, -1 for none
    weight: np.ndarray
    factor: np.ndarray    #: terms x FACTORS

    def raw(self, terms: np.ndarray) -> float:
        at = self.place[terms]
        at = at[at >= 0]
        v = self.factor[at]
        s = v.sum(0)
        return float(self.bias + self.weight[at].sum() + 0.5 * ((s * s).sum() - (v * v).sum()))

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(terms_of(text)), -30, 30))))


def _tied(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Which buckets the labels depend on, by the chi-squared test of each bucket's 2 x 2 table."""
    count = lambda some: np.bincount(np.concatenate([*some, np.zeros(0, np.int32)]), minlength=DIM).astype(float)
    seen, hit = count(rows), count([r for r, y in zip(rows, labels) if y])
    n, yes = len(rows), labels.sum()
    none_of = (n - yes) - (seen - hit)
    apart = (hit * none_of - (seen - hit) * (yes - hit)) ** 2 * n
    return (seen >= MIN_ROWS) & (apart > TIED * np.maximum(seen * (n - seen) * yes * (n - yes), 1e-9))


def _tied_beside(rows: list[np.ndarray], labels: np.ndarray, tied: np.ndarray) -> np.ndarray:
    """Which buckets the labels depend on in the rows that hold a tied one, by the G-test of the 2 x 2 table
    there, at a chance that all these tests share."""
    more = np.zeros(DIM, bool)
    beside: dict[int, list[int]] = {}
    for i, r in enumerate(rows):
        for b in r[tied[r]]:
            beside.setdefault(int(b), []).append(i)
    often = (np.bincount(np.concatenate(rows), minlength=DIM) >= MIN_ROWS).sum()
    bound = NormalDist().inv_cdf(1 - TIED_CHANCE / max(len(beside) * often, 1) / 2) ** 2
    log = lambda part, of: part * np.log(np.maximum(part, 1e-9) / np.maximum(of, 1e-9))
    for at in beside.values():
        n, yes = len(at), labels[at].sum()
        seen = np.bincount(np.concatenate([rows[i] for i in at]), minlength=DIM)
        some = np.flatnonzero((seen >= MIN_ROWS) & (n - seen >= MIN_ROWS) & ~more)
        hit = np.bincount(np.concatenate([*[rows[i] for i in at if labels[i]], np.zeros(0, np.int32)]), minlength=DIM)[some]
        held, rest = seen[some], n - seen[some]
        g = 2 * (log(hit, held) + log(held - hit, held) + log(yes - hit, rest) + log(rest - yes + hit, rest) - log(yes, n) - log(n - yes, n))
        more[some[g > bound]] = True
    return more


def train(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-3) -> Machine:
    """AdaGrad over single rows, in a fixed order. Rows are the buckets of a text each."""
    place = np.full(DIM, -1, np.int32)
    if not rows:
        return Machine(-30.0, place, np.zeros(0), np.zeros((0, FACTORS)))
    tied = _tied(rows, labels)
    tied |= _tied_beside(rows, labels, tied)
    often = np.bincount(np.concatenate(rows), minlength=DIM) >= max(MIN_ROWS, FREQUENT * len(rows))
    keep = np.flatnonzero(tied | often)
    held = np.where(tied[keep], decay, DECAY)
    place[keep] = np.arange(len(keep))
    rng = np.random.default_rng(7)
    w, v = np.zeros(len(keep)), rng.normal(0, 0.01, (len(keep), FACTORS))
    gw, gv = np.full(len(keep), 1e-2), np.full((len(keep), FACTORS), 1e-2)
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    bias, gb = float(np.log(share / (1 - share))), 1.0
    own = [(lambda a: a[a >= 0])(place[r]) for r in rows]
    for _ in range(epochs):
        for i in rng.permutation(len(own)):
            at = own[i]
            vi = v[at]
            s = vi.sum(0)
            z = bias + w[at].sum() + 0.5 * ((s * s).sum() - (vi * vi).sum())
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i]) * (HEAVY if labels[i] else 1.0)
            d = g + held[at] * w[at]
            gw[at] += d * d
            w[at] -= rate * d / np.sqrt(gw[at])
            d2 = g * (s - vi) + held[at, None] * vi
            gv[at] += d2 * d2
            v[at] -= 0.3 * rate * d2 / np.sqrt(gv[at])
            gb += g * g
            bias -= rate * g / np.sqrt(gb)
    return Machine(bias, place, w.astype(np.float32), v.astype(np.float32))


def calibrated(rows: list[np.ndarray], labels: np.ndarray) -> Machine:
    """A machine whose scores pass ``OPERATING`` where rows that it has not seen say so. With few rows of
    either label it is as trained."""
    machine = train(rows, labels)
    if min(labels.sum(), len(labels) - labels.sum()) < 10 * PARTS:
        return machine
    part = np.arange(len(rows)) % PARTS
    unseen = np.zeros(len(rows))
    for k in range(PARTS):
        other = train([r for r, p in zip(rows, part) if p != k], labels[part != k])
        unseen[part == k] = [other.raw(r) for r, p in zip(rows, part) if p == k]
    machine.bias += float(np.log(OPERATING / (1 - OPERATING)) - np.quantile(unseen[labels == 0], 1 - SPARED))
    return machine


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Machine:
    """A machine from the rows of the learning folds: those whose crc32 remainder is not 1."""
    told = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter((remainder(F.col("doc_id"), 3) != 1) & F.col("y").isin(0, 1)).distinct()
    picked = bounded_sample(told, "y", sample)
    got = by_batch(sampled_texts(docs.select("doc_id", "text"), picked, "y"), lambda b: pd.DataFrame(
        {"doc_id": b["doc_id"], "y": b["y"], "terms": [terms_of(t).tobytes() for t in b["text"]]}), "doc_id long, y int, terms binary").collect()
    got.sort(key=lambda r: (r["doc_id"], r["y"], r["terms"]))
    return calibrated([np.frombuffer(r["terms"], np.int32) for r in got], np.array([r["y"] for r in got], float))


def score(docs: DataFrame, machine: Machine, threshold: float = OPERATING) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    def run(b: pd.DataFrame) -> pd.DataFrame:
        s = np.array([machine.score(t) for t in b["text"]])
        return pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "score": s, "predicted": (s >= threshold).astype(np.int32)})
    return by_batch(docs.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "text"), run,
                    "doc_id long, held_out boolean, score double, predicted int")

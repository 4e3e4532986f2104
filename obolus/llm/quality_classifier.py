"""Quality classifier: histogram gradient-boosted trees over statistics of a document, flattened into
arrays that numpy walks for all rows of a batch at once.

Statistics are of the whole text. The trees are fitted on the driver over at most ``SAMPLE``
labelled rows of the learning folds (labels in turn); the driver holds as many rows of ``len(NAMES)``
numbers. Bins are quantiles of the sample.

Defined results: null and empty texts have all statistics 0 and get a score like any other. Null
labels teach nothing; with no labelled row every score is 0.5. Repeated rows get equal scores.
Labels, lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obolus.llm.common import bounded_sample, by_batch, remainder, sampled_texts

#: The bound of the sample of labelled rows.
SAMPLE = 8000
BINS, TREES, DEPTH, RATE, MIN_LEAF, L2 = 64, 60, 4, 0.2, 10, 1.0

NAMES = ("words", "chars_per_word", "distinct", "top_word", "longest_run", "symbols", "bars", "upper", "digits", "stops", "letters", "lines", "words_per_line",
         "same_lines", "bare_lines", "symbol_words", "exclaimed")


def statistics_of(text: str | None) -> list[float]:
    """The document's statistics, in the order of ``NAMES``."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    if not n:
        return [0.0] * len(NAMES)
    times = Counter(words)
    ids = np.fromiter(map(hash, words), np.int64, n)
    breaks = np.flatnonzero(ids[1:] != ids[:-1])
    run = int(np.diff(np.concatenate([[-1], breaks, [n - 1]])).max())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    many = lambda chars: float(kinds[list(chars)].sum())
    ends = sum(1 for w in words if w[-1] in b"#*$%&|<>")
    return [float(np.log1p(n)), size / n, len(times) / n, max(times.values()) / n, run / n, many(b"#*$%&|<>") / size, many(b"|") / n, float(kinds[65:91].sum()) / size, float(kinds[48:58].sum()) / size,
            many(b".,;:!?") / n, float(kinds[97:123].sum() + kinds[128:].sum()) / size, float(np.log1p(len(lines))), n / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
            sum(1 for x in lines if x.rstrip()[-1] not in b".!?:;\"')") / max(1, len(lines)), ends / n, many(b"!") / n]


@dataclass
class Trees:
    """All trees in one set of arrays; ``root`` has each tree's first node. A leaf leads to itself."""
    root: np.ndarray
    feature: np.ndarray
    limit: np.ndarray    #: rows whose feature is at most this go left
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for r in self.root:
            at = np.full(len(x), r, np.int32)
            for _ in range(DEPTH):
                at = np.where(x[rows, self.feature[at]] <= self.limit[at], self.left[at], self.right[at])
            out += self.value[at]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def train(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees on the logistic loss, level by level, from gradient histograms."""
    feature, limit, left, right, value, root = [], [], [], [], [], []
    if not len(x):
        none = np.zeros(0, np.int32)
        return Trees(none, none, np.zeros(0), none, none, np.zeros(0), 0.0)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(x.shape[1])], axis=1)
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    margin = np.full(len(x), start)

    def node() -> int:
        for a, b in ((feature, 0), (limit, 0.0), (left, len(left)), (right, len(right)), (value, 0.0)):
            a.append(b)
        return len(value) - 1

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        level = [(node(), np.arange(len(x)))]
        root.append(level[0][0])
        for depth in range(DEPTH + 1):
            following = []
            for k, rows in level:
                gs, hs = g[rows].sum(), h[rows].sum()
                best, cut = 1e-6, None
                for f in range(x.shape[1]) if depth < DEPTH and len(rows) >= 2 * MIN_LEAF else ():
                    b = bins[rows, f]
                    gl, hl, nl = (np.cumsum(np.bincount(b, weights=w, minlength=BINS))[:-1] for w in (g[rows], h[rows], None))
                    gain = gl ** 2 / (hl + L2) + (gs - gl) ** 2 / (hs - hl + L2) - gs ** 2 / (hs + L2)
                    gain[(nl < MIN_LEAF) | (len(rows) - nl < MIN_LEAF)] = 0
                    i = int(np.argmax(gain))
                    if gain[i] > best:
                        best, cut = gain[i], (f, i)
                if cut is None:
                    value[k] = RATE * gs / (hs + L2)
                    margin[rows] += value[k]
                    continue
                f, i = cut
                feature[k], limit[k] = f, edges[f][i]
                left[k], right[k] = node(), node()
                low = bins[rows, f] <= i
                following += [(left[k], rows[low]), (right[k], rows[~low])]
            level = following
    return Trees(np.array(root, np.int32), np.array(feature, np.int32), np.array(limit), np.array(left, np.int32), np.array(right, np.int32), np.array(value), start)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Trees:
    """Trees from the rows of the learning folds: those whose crc32 remainder is not 1."""
    told = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter((remainder(F.col("doc_id"), 3) != 1) & F.col("y").isin(0, 1)).distinct()
    picked = bounded_sample(told, "y", sample)
    got = by_batch(sampled_texts(docs.select("doc_id", "text"), picked, "y"), lambda b: pd.DataFrame(
        {"doc_id": b["doc_id"], "y": b["y"], "x": [statistics_of(t) for t in b["text"]]}), "doc_id long, y int, x array<double>").collect()
    got.sort(key=lambda r: (r["doc_id"], r["y"], r["x"]))
    return train(np.array([r["x"] for r in got]).reshape(len(got), len(NAMES)), np.array([r["y"] for r in got], float))


def score(docs: DataFrame, trees: Trees, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    def run(b: pd.DataFrame) -> pd.DataFrame:
        s = trees.score(np.array([statistics_of(t) for t in b["text"]]))
        return pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "score": s, "predicted": (s >= threshold).astype(np.int32)})
    return by_batch(docs.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "text"), run,
                    "doc_id long, held_out boolean, score double, predicted int")

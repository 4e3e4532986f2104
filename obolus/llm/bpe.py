"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Texts are cut into words by the tokenizer's pattern. The new distinct words of a slice of the corpus
are laid out as one linked list of tokens, bytes at first, with an inverted index from merge rank to
the places where a pair of that rank stands. Merges are replayed in rank order: each takes its places
from the index, joins the pairs there and looks up only the neighbours it touched. A task keeps what
it has learned of words (up to ``KNOWN`` of them) and reads its texts through that table.

The slice is what a task holds at a time (``SLICE`` characters), not the whole corpus: a table of all
distinct words would have to be joined to every word of every text, a shuffle several times the
input. Words do not influence each other, so the ids are those of a replay over everything.

Ids are those of taking, word by word, the lowest rank first and the leftmost of equals. A merge that
brings forth a pair of no higher rank would have to wait for it; words with such a pair are encoded
once more, alone. A word that is a token itself is that token.

Ids are packed as little-endian unsigned 32-bit integers in a binary column. Defined results: null
and empty texts have no ids and decode to no bytes; repeated rows get equal ids; bytes of ids that do
not exist raise. Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from obolus.llm.common import frames

#: Characters of text whose words are encoded together.
SLICE = 6_000_000
#: Distinct words that a task remembers between slices.
KNOWN = 250_000
NONE = 1 << 30


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Replay:
    """Encodes many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.token[r] = t
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = sorted((ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.keys, self.merged = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of joining the tokens a and b, place by place; NONE where there is no such merge."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    def alone(self, word: bytes) -> list[int]:
        """One word, lowest rank and leftmost place first."""
        tok, n = [self.ranks[word[i:i + 1]] for i in range(len(word))], len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = lambda p: self.ranks.get(self.token[tok[p]] + self.token[tok[after[p]]]) if after[p] < n else None
        heap = [(r, p) for p in range(n) if (r := get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            r, p = heapq.heappop(heap)
            if tok[p] < 0 or get(p) != r:
                continue
            q = after[p]
            tok[p], tok[q], after[p] = r, -1, after[q]
            if after[p] < n:
                before[after[p]] = p
            for x in (p, before[p]):
                if x >= 0 and (r2 := get(x)) is not None:
                    heapq.heappush(heap, (r2, x))
        return [t for t in tok if t >= 0]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each has."""
        known = [self.ranks.get(w) for w in words]
        rest = [i for i, r in enumerate(known) if r is None and words[i]]
        out = [np.array([] if r is None else [r], np.int64) for r in known]
        for i, ids in zip(rest, self._replay([words[i] for i in rest])):
            out[i] = ids
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        return (np.concatenate(out) if out else np.zeros(0, np.int64)), lengths

    def _replay(self, words: list[bytes]) -> list[np.ndarray]:
        if not words:
            return []
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        tok = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(sizes)
        after, before = np.arange(1, len(tok) + 1, dtype=np.int32), np.arange(-1, len(tok) - 1, dtype=np.int32)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        index: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []
        again: set[int] = set()

        def post(places: np.ndarray, rank: np.ndarray) -> None:
            """Adds places to the index, under their ranks."""
            some = rank < NONE
            places, rank = places[some], rank[some]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            places, rank = places[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(rank)]
            for r, i, j in zip(rank[[0, *cuts]].tolist(), bounds, bounds[1:]):
                if r in index:
                    index[r].append(places[i:j])
                else:
                    index[r] = [places[i:j]]
                    heapq.heappush(ranks, r)

        at = np.flatnonzero(after >= 0).astype(np.int32)
        post(at, self.rank(tok[at], tok[after[at]]))
        while ranks:
            r = heapq.heappop(ranks)
            found = index.pop(r)
            p = np.unique(np.concatenate(found))  # a place is posted by both of its neighbours
            p = p[(tok[p] >= 0) & (after[p] >= 0)]
            p = p[self.rank(tok[p], tok[after[p]]) == r]
            q = after[p]
            if len(p) > 1 and (q[:-1] == p[1:]).any():  # overlapping pairs: the left one of each two
                take, last = np.ones(len(p), bool), -1
                for i, (x, y) in enumerate(zip(p.tolist(), q.tolist())):
                    take[i] = x != last
                    last = y if take[i] else -1
                p, q = p[take], q[take]
            if not len(p):
                continue
            n = after[q]
            tok[p], tok[q], after[p] = r, -1, n
            has = n >= 0
            before[n[has]] = p[has]
            left = before[p]
            left = left[left >= 0]
            places = np.concatenate([left, p[has]])
            rank = self.rank(tok[places], tok[after[places]])
            early = rank <= r
            if early.any():
                again.update(word[places[early]].tolist())
            post(places, rank)
        alive = tok >= 0
        ids = np.split(tok[alive], np.cumsum(np.bincount(word[alive], minlength=len(words)))[:-1])
        for i in again:
            ids[i] = np.array(self.alone(words[i]), np.int64)
        return ids


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows together up to ``SLICE`` characters; a longer text comes alone."""
    for batch in batches:
        size = batch["text"].map(lambda t: len(t or "")).cumsum().to_numpy()
        for _, part in batch.groupby(size // SLICE, sort=True):
            yield part


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, and_decode: bool = False) -> DataFrame:
    """One row per document: doc_id and ids (packed); with ``and_decode`` also data, the bytes that the
    ids stand for, in the same pass over the tasks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        replay, split = Replay(ranks), regex.compile(pattern)
        back = _bytes_of(ranks)
        seen: defaultdict = defaultdict()
        seen.default_factory = seen.__len__
        flat, lengths = np.zeros(0, "<u4"), np.zeros(0, np.int64)
        for part in _slices(batches):
            if len(lengths) > KNOWN:
                seen.clear()
                flat, lengths = flat[:0], lengths[:0]
            texts = [np.fromiter(map(seen.__getitem__, split.findall(t or "")), np.int32) for t in part["text"]]
            if len(seen) > len(lengths):
                new = list(seen)[len(lengths):]
                more, n = replay.encode([w.encode("utf-8", "surrogatepass") for w in new])
                flat, lengths = np.concatenate([flat, more.astype("<u4")]), np.concatenate([lengths, n])
            starts = np.cumsum(lengths) - lengths
            out = []
            for w in texts:
                n = lengths[w]
                ends = np.cumsum(n)
                out.append(flat[np.repeat(starts[w] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)].tobytes())
            rows = pd.DataFrame({"doc_id": part["doc_id"], "ids": out})
            yield rows.assign(data=[back(x) for x in out]) if and_decode else rows
    return frames(docs.select("doc_id", "text"), run, "doc_id long, ids binary" + ", data binary" * and_decode, 10_000)


def _bytes_of(ranks: dict[bytes, int]):
    """A function from packed ids to the bytes that they stand for."""
    token = {r: t for t, r in ranks.items()}.__getitem__
    return lambda ids: b"".join(map(token, np.frombuffer(ids or b"", "<u4").tolist()))


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """One row per document: doc_id, ids and data (the bytes that the ids stand for)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        back = _bytes_of(ranks)
        for batch in batches:
            yield batch.assign(data=[back(x) for x in batch["ids"]])
    return frames(encoded.select("doc_id", "ids"), run, "doc_id long, ids binary, data binary")

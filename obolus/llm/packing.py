"""Order-preserving packing: documents in their order form one stream of tokens, and dynamic
programming chooses where windows end.

Windows may end at a document's end (free), at a sentence's end (``SENTENCE`` each), or where neither
is in reach, anywhere (``INSIDE``); a window of fewer than ``width`` tokens costs its padding, one
whose length is a power of two none. With f(j) the least cost up to place j,

    f(j) = penalty(j) + width - j + min over i in [j - width, j) of (f(i) + i),

so the inner minimum is that of a sliding window and a queue of rising values gives it in constant
time; the powers of two are looked up beside it.

Each task packs the rows of its partition as a stream of its own, a block of tokens at a time: what a
block settles is given out, its last windows go over to the next. So memory is that of a block and of
one document, and sequences depend on nothing outside the partition: a lost task is run again and
gives the same. Nothing is shuffled.

Ids are those of the vocabulary file in the format of the `tokenizers` library, special tokens'
strings being ordinary text, then the id that closes a document. Defined results: a null or empty text
is its closing id alone; repeated rows are packed as often as they come; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from obolus.llm.common import frames

WIDTH = 2048
#: In padded tokens: what a cut at a sentence's end costs, and one inside a sentence.
SENTENCE, INSIDE = 4, 48
#: Tokens that are packed together, and windows at a block's end that are packed anew with the next.
BLOCK, OPEN = 1 << 19, 8
#: Where there is no boundary for so many tokens, windows may end at every so many.
STEP = 128
#: Characters that are encoded at once; longer texts are parted at spaces between words.
PIECE = 1 << 20
#: Distinct parts of texts whose ids a task remembers.
KNOWN = 150_000
CLOSE = 1


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


class Encoder:
    """Ids of texts by the vocabulary of a `tokenizers` file of byte-level BPE.

    Words never reach over a space that stands alone between two other characters, so texts are parted
    there; the parts not seen before are encoded together and looked up from then on. The same
    vocabulary as ranks gives the ids of the `tokenizers` library several times as fast. Texts whose
    spaces do not stand alone are encoded whole, those with a stretch so long that the time would grow
    with its square by the library itself."""

    LONG = re.compile(r"\S{2000}|\s{2000}")
    ALONE = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, file: str, ranks: dict[bytes, int], pattern: str):
        import tiktoken
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.file, self.slow = file, None
        self.ends, self.bytes = np.zeros(max(ranks.values()) + 2, bool), np.zeros(max(ranks.values()) + 2, np.int64)
        for token, r in ranks.items():
            self.bytes[r] = len(token)
            self.ends[r] = token.rstrip(b" \"')").endswith((b".", b"!", b"?", b"\n", "…".encode(), "。".encode()))
        self._forget()

    def _forget(self) -> None:
        self.seen: defaultdict = defaultdict()
        self.seen.default_factory = self.seen.__len__
        self.flat, self.starts, self.lengths, self.plain = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def _learn(self) -> None:
        """Encodes the parts that came since, each with the space before it, in one text."""
        new = list(itertools.islice(self.seen, len(self.lengths), None))
        plain = np.array([bool(x) and len(x) < 2000 and not x[0].isspace() and not x[-1].isspace() for x in new], bool)
        parts = [x for x, ok in zip(new, plain) if ok]
        ids = np.array(self.fast.encode_ordinary(" " + " ".join(parts)) if parts else [], "<u4")
        ends = np.cumsum(self.bytes[ids])
        sizes = np.fromiter((len(x.encode("utf-8", "surrogatepass")) + 1 for x in parts), np.int64, len(parts))
        upto = np.searchsorted(ends, np.cumsum(sizes), side="left") + 1
        lengths = np.zeros(len(new), np.int64)
        lengths[plain] = np.diff(upto, prepend=0)
        self.flat = np.concatenate([self.flat, ids])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.plain = np.concatenate([self.plain, plain])

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.lengths) > KNOWN:
            self._forget()
        first, rest = [], []
        for t in texts:
            head, *parts = t.split(" ")
            first.append(head)
            rest.append(np.fromiter(map(self.seen.__getitem__, parts), np.int64, len(parts)))
        if len(self.seen) > len(self.lengths):
            self._learn()
        out = []
        for t, head, w in zip(texts, first, rest):
            if (w.size and (not head or head[-1].isspace() or len(head) >= 2000)) or not self.plain[w].all():
                out.append(self.whole(t))
                continue
            n = self.lengths[w]
            ends = np.cumsum(n)
            ids = self.flat[np.repeat(self.starts[w] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
            out.append(np.concatenate([self.whole(head), ids]))
        return out

    def whole(self, text: str) -> np.ndarray:
        if not self.LONG.search(text):
            return np.array(self.fast.encode_ordinary(text), "<u4")
        if self.slow is None:
            from tokenizers import Tokenizer
            self.slow = Tokenizer.from_str(self.file)
            self.slow.encode_special_tokens = True
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")

    def parts(self, text: str) -> Iterator[np.ndarray]:
        """A very long text's ids, a part at a time."""
        start = 0
        while len(text) - start > PIECE:
            cut = self.ALONE.search(text, start + PIECE - 1)
            if not cut:
                break
            yield self.whole(text[start:cut.start()])
            start = cut.start()
        yield self.whole(text[start:])


def ranks_of(file: str) -> dict[bytes, int]:
    """The tokens of a byte-level BPE file of the `tokenizers` library with their ids, without its special tokens."""
    told = json.loads(file)
    special = {t["content"] for t in told.get("added_tokens", [])}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # these bytes stand for themselves, the others for U+0100 and on
    letter = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    return {bytes(letter[c] for c in token): i for token, i in told["model"]["vocab"].items() if token not in special}


def cut(places: np.ndarray, penalty: np.ndarray, width: int = WIDTH) -> list[int]:
    """Ends of windows, as indices into ``places`` (ascending; the first is where the stream begins,
    the last where it ends). Neighbouring places are at most ``width`` apart."""
    n = len(places)
    p, cost = places.tolist(), penalty.tolist()
    powers = [1 << k for k in range(width.bit_length()) if 1 << k < width]
    exact: list[list[int]] = [[] for _ in range(n)]
    for k in powers:  # pairs of places exactly a power of two apart
        at = np.searchsorted(places, places + k)
        for i in np.flatnonzero((at < n) & (places[np.minimum(at, n - 1)] == places + k)).tolist():
            exact[at[i]].append(i)
    f, came = [0.0] * n, [0] * n
    queue = deque([(p[0], 0)])  # (f(i) + i, i), rising in both
    for j in range(1, n):
        pj = p[j]
        while p[queue[0][1]] < pj - width:
            queue.popleft()
        low, i = queue[0]
        best = low + width - pj
        for e in exact[j]:
            if f[e] < best:
                best, i = f[e], e
        f[j], came[j] = best + cost[j], i
        v = f[j] + pj
        while queue and queue[-1][0] >= v:
            queue.pop()
        queue.append((v, j))
    out, j = [], n - 1
    while j:
        out.append(j)
        j = came[j]
    return out[::-1]


def places_of(ids: np.ndarray, closes: np.ndarray, ends: np.ndarray, last: bool, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Where windows may end in a stretch of the stream, and what each place costs. ``closes``: ends of
    documents; ``last``: whether the stream ends here, whose last windows may then end anywhere."""
    n = len(ids)
    price = np.full(n + 1, -1.0)
    price[np.flatnonzero(ends[ids]) + 1] = SENTENCE
    known = np.unique(np.concatenate([[0], np.flatnonzero(price >= 0), closes, [n]]))
    step = min(STEP, width)
    for a, b in zip(known[:-1][np.diff(known) > step].tolist(), known[1:][np.diff(known) > step].tolist()):
        price[a + step:b:step] = INSIDE
    if last:
        tail = price[max(0, n - 2 * width):]
        tail[tail < 0] = INSIDE
    price[closes] = 0
    price[0] = price[n] = 0
    at = np.flatnonzero(price >= 0)
    return at, price[at]


class Stream:
    """A partition's stream: takes parts of documents, gives pieces."""

    def __init__(self, ends: np.ndarray, first: int, width: int = WIDTH):
        self.ends, self.next, self.width = ends, first, width
        self.held: list[list] = []  # [doc_id, start, ids, closes, tokens], tokens a list of one number, known at the document's end
        self.size = 0
        self.waiting: list[tuple] = []  # pieces of documents whose end has not come

    def take(self, doc_id, start: int, ids: np.ndarray, closes: bool, tokens: list) -> None:
        self.held.append([doc_id, start, ids, closes, tokens])
        self.size += len(ids)

    def give(self, last: bool) -> Iterator[tuple]:
        """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of settled windows."""
        if self.size and (last or self.size >= BLOCK):
            self._settle(last)
        ready = [w for w in self.waiting if w[4]]
        self.waiting = [w for w in self.waiting if not w[4]]
        for doc_id, start, length, crc, tokens, seq, offset in ready:
            yield doc_id, start, length, crc, tokens[0], seq, offset

    def _settle(self, last: bool) -> None:
        ids = np.concatenate([h[2] for h in self.held])
        begins = np.cumsum([0, *(len(h[2]) for h in self.held)])
        closes = np.array([e for h, e in zip(self.held, begins[1:]) if h[3]], np.int64)
        at, price = places_of(ids, closes, self.ends, last, self.width)
        windows = at[cut(at, price, self.width)].tolist()
        if not last:
            windows = windows[:-OPEN]
        h, begin = 0, 0
        for end in windows:
            a = begin
            while a < end:
                while begins[h + 1] <= a:
                    h += 1
                b = min(end, int(begins[h + 1]))
                doc_id, start, own, _, tokens = self.held[h]
                piece = own[a - begins[h]:b - begins[h]]
                old = self.waiting[-1] if self.waiting and a > begin else None
                if old is not None and old[4] is tokens and old[5] == self.next:  # parts of one document in one window are one piece
                    self.waiting[-1] = (doc_id, old[1], old[2] + len(piece), zlib.crc32(piece.tobytes(), old[3]), tokens, self.next, old[6])
                else:
                    self.waiting.append((doc_id, int(start + a - begins[h]), len(piece), zlib.crc32(piece.tobytes()), tokens, self.next, a - begin))
                a = b
            begin = end
            self.next += 1
        rest = []
        for x, b, e in zip(self.held, begins, begins[1:]):
            if e > begin:
                skip = max(0, begin - int(b))
                rest.append([x[0], x[1] + skip, x[2][skip:], x[3], x[4]])
        self.held, self.size = rest, len(ids) - begin


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
SCHEMA = ", ".join(f"{c} long" for c in COLUMNS)


def pack(docs: DataFrame, file: str, pattern: str, width: int = WIDTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Sequence
    ids are the partition's number in the upper bits and a count in the lower 33."""
    ranks = ranks_of(file)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(file, ranks, pattern)
        stream = Stream(encoder.ends, TaskContext.get().partitionId() << 33, width)
        close = np.array([CLOSE], "<u4")
        for ids, texts in slices(batches):
            short = iter(encoder.many([t for t in texts if len(t) <= PIECE]))
            for doc_id, text in zip(ids, texts):
                start, tokens, held = 0, [], None
                for part in [next(short)] if len(text) <= PIECE else encoder.parts(text):
                    if held is not None:
                        stream.take(doc_id, start - len(held), held, False, tokens)
                        if stream.size >= BLOCK and (rows := list(stream.give(False))):
                            yield _frame(rows)
                    held, start = part, start + len(part)
                held = np.concatenate([held, close])
                tokens.append(start + 1)
                stream.take(doc_id, start + 1 - len(held), held, True, tokens)
                if stream.size >= BLOCK and (rows := list(stream.give(False))):
                    yield _frame(rows)
        if rows := list(stream.give(True)):
            yield _frame(rows)
    return frames(docs.select("doc_id", "text"), run, SCHEMA)


def slices(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of rows together, up to twice ``PIECE`` characters; null texts are empty."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            if size + len(text or "") > 2 * PIECE and texts:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text or "")
            size += len(text or "")
    if texts:
        yield ids, texts


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=COLUMNS)
    return out.assign(doc_id=out["doc_id"].astype("Int64"))

"""Byte-level BPE and packing against the public libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from obolus.llm import bpe, packing, queries

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n", "a" * 5000 + " b", " " * 4000 + "x", "don't  stop\n now", "中文🎉 é x", "<|endoftext|> is text", "0123456789" * 300, "--------------------- ===", "x \x00 y"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_gives_the_ids_of_the_library(ranks, library):
    rng = random.Random(3)
    words = ["".join(rng.choice("aábñé中 🎉-=") for _ in range(rng.randint(1, 40))) for _ in range(3000)] + ["a" * n for n in range(1, 70)]
    words = [w for x in words for w in __import__("regex").findall(public_tokenizers.PATTERN, x)]
    ids, lengths = bpe.Replay(ranks).encode([w.encode() for w in words])
    for w, own in zip(words, np.split(ids, np.cumsum(lengths)[:-1])):
        assert list(own) == library.encode_ordinary(w), w


def test_encode_and_decode(spark, docs, ranks, library):
    df = docs(*enumerate(ODD), (3, ODD[3]))
    rows = bpe.decode(bpe.encode(df.withColumn("ids", df.n_chars), ranks, public_tokenizers.PATTERN), ranks).collect()
    assert len(rows) == len(ODD) + 1
    for r in rows:
        text = ODD[r.doc_id] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(text) and bytes(r["data"]) == text.encode()
    assert bpe.decode(bpe.encode(docs(), ranks, public_tokenizers.PATTERN), ranks).count() == 0


def test_query_bpe(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op8_byte_bpe"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def check_pieces(rows, texts, width=packing.WIDTH):
    """Every id in one piece, sequences gapless and not too long; returns padding as a share of the tokens."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0 and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= width
        total += at
        padding += 0 if at & (at - 1) == 0 else width - at
    return padding / max(1, total)


def test_query_packing(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert check_pieces(queries.QUERIES["op9_packing"](spark, FOLDER).collect(), texts) < 0.02


def test_packing_of_odd_texts(spark, docs, monkeypatch):
    file = packing.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(enumerate([*ODD, "One two three. " * 9000, "word " * 20000]))
    assert check_pieces(packing.pack(docs(*texts.items()).repartition(2), file, public_tokenizers.PATTERN).collect(), texts) < 0.05
    assert packing.pack(docs(), file, public_tokenizers.PATTERN).count() == 0
    twice = packing.pack(docs((1, "a b"), (1, "a b")).coalesce(1), file, public_tokenizers.PATTERN).collect()
    assert sum(r.length for r in twice) == 6 and {r.doc_tokens for r in twice} == {3} and [r.start for r in twice].count(0) == 2
    assert packing.pack(docs((None, "a b")), file, public_tokenizers.PATTERN).first().doc_id is None


def test_cuts_are_the_best():
    rng = random.Random(5)
    for _ in range(60):
        n, width = rng.randint(1, 30), 16
        places = sorted(rng.sample(range(1, 100), n))
        places = [0, *[p for p in places]]
        while any(b - a > width for a, b in zip(places, places[1:])):
            places = sorted({*places, *[a + width for a, b in zip(places, places[1:]) if b - a > width]})
        price = [rng.randint(0, 5) for _ in places]
        cost = lambda a, b: (0 if (b - a) & (b - a - 1) == 0 else width - (b - a))
        best = [0.0] + [1e9] * (len(places) - 1)
        for j in range(1, len(places)):
            best[j] = price[j] + min(best[i] + cost(places[i], places[j]) for i in range(j) if places[j] - places[i] <= width)
        ends = packing.cut(np.array(places), np.array(price, float), width)
        got = sum(cost(places[a], places[b]) + price[b] for a, b in zip([0, *ends], ends))
        assert got == best[-1]


def test_pieces_over_blocks(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 700)
    ends = np.zeros(50, bool)
    ends[3] = True
    rng = np.random.default_rng(0)
    stream, rows, docs = packing.Stream(ends, 5, 32), [], {}
    for i in range(200):
        docs[i] = rng.integers(2, 20, rng.integers(1, 90)).astype("<u4")
        stream.take(i, 0, docs[i][:7], len(docs[i]) <= 7, tokens := [len(docs[i])])
        if len(docs[i]) > 7:
            stream.take(i, 7, docs[i][7:], True, tokens)
        rows += stream.give(False)
    rows += stream.give(True)
    seen = {i: 0 for i in docs}
    fill = {}
    for i, start, length, crc, n, seq, offset in rows:
        assert n == len(docs[i]) and start == seen[i] and offset == fill.get(seq, 0) and crc == zlib.crc32(docs[i][start:start + length].tobytes())
        seen[i] += length
        fill[seq] = offset + length
    assert seen == {i: len(d) for i, d in docs.items()} and max(fill.values()) <= 32
    assert sorted(fill) == list(range(5, 5 + len(fill)))


def test_great_ids_beside_nulls(docs):
    big = 2 ** 53 + 1
    rows = docs((big, "some words"), (None, "other words"), (big + 2, None))
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    assert {r.doc_id for r in bpe.encode(rows, ranks, public_tokenizers.PATTERN).collect()} == {big, big + 2, None}
    assert {r.doc_id for r in bpe.decode(bpe.encode(rows, ranks, public_tokenizers.PATTERN), ranks).collect()} == {big, big + 2, None}
    file = packing.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.doc_id for r in packing.pack(rows, file, public_tokenizers.PATTERN).collect()} == {big, big + 2, None}

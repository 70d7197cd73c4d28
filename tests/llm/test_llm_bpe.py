"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken
from llm_fixtures import SF, documents, odd_rows

from claimloom.llm import bpe
from claimloom.llm.queries import PATTERN, RANK_FILE, op7_bpe


@pytest.fixture(scope="module")
def reference():
    with open(RANK_FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(texts, reference):
    coder = bpe.codec(RANK_FILE, PATTERN)
    ids = coder.encode(texts)
    for text, got in zip(texts, ids):
        assert got.tolist() == reference.encode_ordinary(text or ""), (text or "")[:50]
    assert coder.decode(ids) == [(t or "").encode() for t in texts]


def test_odd_texts(reference):
    rng = random.Random(2)
    same([t for _, t in odd_rows()], reference)
    same(["".join(rng.choices("ab c1é日\n'st!", k=rng.randrange(40))) for _ in range(2000)], reference)
    same(["".join(map(chr, rng.choices(range(1, 0xD7FF), k=50))) for _ in range(200)], reference)


def test_long_pieces(reference):
    rng = random.Random(4)
    long = ["a" * 3001, "ab" * 1500, "aab" * 900, "=-" * 700, "é" * 999, "x" * 256, "x" * 255, "\n" * 2000]
    same(long + ["".join(rng.choices("abcde", k=3000)), "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1500))], reference)


@pytest.mark.parametrize("size", [97, 98, 160, 161, 400, 700, 40_000])
def test_windows_join_exactly(reference, size):
    """Words that fall into windows: random, periodic, and runs that no two windows cut alike."""
    rng = random.Random(size)
    texts = ["".join(rng.choices(letters, k=size)) for letters in ("ab", "etaoin", "abcdefghijklmnopqrstuvwxyz", "éàüßñ", "日本語中")]
    texts += [run * (size // len(run)) for run in ("a", "=", "-=", "abc", "hello", " ", "\n", "é", "0", "the")]
    texts += ["a" * (size // 2) + "".join(rng.choices("ab", k=size // 2)) + "b" * 300 + "a" * size]
    same(texts + [f" {t}." for t in texts], reference)


def test_a_window_that_shares_no_token(reference, monkeypatch):
    """Wide windows take over, and grow."""
    monkeypatch.setattr(bpe, "WIDE", 300)
    monkeypatch.setattr(bpe, "_same_token", lambda *args: None)
    rng = random.Random(9)
    same(["a" * 2500, "".join(rng.choices("abcd", k=2500)), "=" * 1111 + "-" * 1500], reference)


@pytest.mark.parametrize("kind", ["equal", "spaces", "random"])
def test_a_word_of_a_million_letters(reference, kind):
    rng = random.Random(7)
    letters = {"equal": "a", "spaces": " ", "random": "abcdefghijklmnopqrstuvwxyz"}[kind]
    word = letters * 1_000_000 if len(letters) == 1 else "".join(rng.choices(letters, k=1_000_000))
    coder = bpe.codec(RANK_FILE, PATTERN)
    # The word is one piece; the library's own pattern engine overflows on a million spaces.
    got = coder.encode(["short", word])[1]
    assert got.tolist() == reference._core_bpe.encode_single_piece(word.encode())
    assert coder.decode([got]) == [word.encode()]


def test_small_memory_of_pieces(reference, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 10)
    monkeypatch.setattr(bpe, "QUERY_ROWS", 50)
    same([f"unheard{i} ofwords{i * i}" for i in range(100)], reference)


def test_pieces_that_come_again_are_not_contracted_again(monkeypatch):
    """After a million distinct pieces the first ones are still known."""
    coder = bpe.Codec(RANK_FILE, PATTERN)
    asked = []

    def contract(pieces):
        asked.append(len(pieces))
        return [np.zeros(1, np.int32)] * len(pieces)

    monkeypatch.setattr(coder, "_contract", contract)
    sets = [{f"{n}unheard{i}" for i in range(200_000)} for n in range(5)]
    for pieces in sets:
        coder.learn(pieces)
    assert sum(asked) == 1_000_000
    coder.learn(sets[0])
    assert sum(asked) == 1_000_000
    assert len(coder.known) + len(coder.older) <= bpe.KNOWN_PIECES + 2 * len(sets[0])


def test_memory_of_pieces_is_bounded_in_bytes(monkeypatch):
    """Short pieces of many ids count with their bytes, as long ones do."""
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 100_000)
    coder = bpe.Codec(RANK_FILE, PATTERN)
    monkeypatch.setattr(coder, "_contract", lambda pieces: [np.zeros(90, np.int32)] * len(pieces))
    for n in range(20):
        coder.learn({f"{n:040}unheard{i:040}" for i in range(100)})
    # 450 bytes a piece: 100 more than a half of the limit has, in each generation.
    assert len(coder.known) + len(coder.older) <= 2 * (100_000 // 2 // 447 + 100)


def test_portions_are_even(monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_CHARS", 100)
    for texts in (["x" * 10] * 21, ["x" * 10] * 10, ["x" * 10] * 14, [None, ""], ["x" * 1000, "y"], []):
        bounds = list(bpe._portions(texts))
        assert [at for start, end in bounds for at in range(start, end)] == list(range(len(texts)))
        assert all(end - start >= 7 for start, end in bounds[:-1] if texts[0] == "x" * 10)
    assert list(bpe._portions(["x" * 10] * 21)) == [(0, 11), (11, 21)]


def test_decode_keeps_order_around_every_run_of_eight():
    coder = bpe.codec(RANK_FILE, PATTERN)
    tokens = {rank: token for token, rank in coder.ranks.items()}
    rng = np.random.default_rng(3)
    docs = [rng.choice(sorted(tokens), n).astype("<i4") for n in (*range(26), 1000, 4096)]
    docs.append(coder.byte_ids[np.arange(256)].astype("<i4"))
    docs.append(np.full(100, coder.ranks[b"\0"], "<i4"))
    assert coder.decode(docs) == [b"".join(tokens[i] for i in ids.tolist()) for ids in docs]


def digests(text, reference):
    ids = reference.encode_ordinary(text or "")
    return (
        len(ids),
        hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256((text or "").encode()).hexdigest(),
    )


def test_operator_on_odd_rows(spark, reference):
    docs = documents(spark, odd_rows())
    rows = bpe.encode_texts(docs, RANK_FILE, PATTERN).collect()
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows]
    assert sorted(got, key=str) == sorted(((i, *digests(t, reference)) for i, t in odd_rows()), key=str)
    assert all(len(r.ids) == r.n_tokens for r in rows)
    assert bpe.encode_texts(docs.limit(0), RANK_FILE, PATTERN).count() == 0


def test_registered_query_equals_the_library(spark, reference):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = op7_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(texts[r.doc_id], reference)


def test_document_of_millions_of_tokens_decodes():
    coder = bpe.codec(RANK_FILE, PATTERN)
    tokens = {rank: token for token, rank in coder.ranks.items()}
    some = np.array(sorted(tokens)[:997], "<i4")
    long = np.resize(some, 4_500_000)
    short = some[:5]
    got = coder.decode([short, long, long[:0], short])
    whole = b"".join(tokens[i] for i in some.tolist())
    first = b"".join(tokens[i] for i in short.tolist())
    times, rest = divmod(len(long), len(some))
    assert got[1] == whole * times + b"".join(tokens[i] for i in some[:rest].tolist())
    assert (got[0], got[2], got[3]) == (first, b"", first)

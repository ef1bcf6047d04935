from __future__ import annotations

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.llm import bpe

PATH, PATTERN = bpe.default_vocabulary()
LINES = open(PATH, "rb").read()


@pytest.fixture(scope="module")
def both():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, LINES.splitlines())}
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.ByteBpe(LINES, PATTERN), want


def check(both, text):
    mine, want = both
    ids = want.encode_ordinary(text)
    assert mine.encode(text) == ids and mine.decode(ids) == text.encode()
    count, _, a, b = mine.encode_many([text], with_ids=False)[0]
    assert (count, a) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert b == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(both, text):
    check(both, text)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abe éß日\U0001f600 \n'", max_size=700))
def test_long_matches(both, text):
    check(both, text)


@pytest.mark.parametrize("n", [255, 256, 257, 5000])
def test_around_the_matrix_bound(both, n):
    check(both, "ab" * n)
    check(both, " " * n + "x")


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdeil éß日本", min_size=1, max_size=400), st.integers(1, 3), st.booleans())
def test_rows_of_their_own(both, text, bound, learnt):
    """Every match wider than the matrices' bound, and rank files that break the order of merges, give the same ids."""
    mine, _ = both
    pieces = [text.encode(), text.encode() * 3, b"a" * len(text)]
    want = mine.encode_pieces(pieces)
    old, was = bpe.MATRIX_BYTES, mine._learnt
    try:
        bpe.MATRIX_BYTES, mine._learnt = bound, learnt
        assert mine.encode_pieces(pieces) == want
    finally:
        bpe.MATRIX_BYTES, mine._learnt = old, was


def test_endless_match(both):
    check(both, "qzxjkvwpyg" * 600)


def test_runs_and_cache_bounds(both, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 50)
    monkeypatch.setattr(bpe, "RUN_MATCHES", 7)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 20)
    for text in ("one two three four five six seven eight nine ten eleven twelve " * 5, "", "a"):
        check(both, text)


def test_special_tokens_are_plain_text(both):
    check(both, "<|endoftext|> and more")


def test_odd_rows(spark, odd_docs, no_docs):
    digest = bpe.digester(spark, PATH, PATTERN)
    rows = odd_docs.select("doc_id", "text", digest("text").alias("d")).collect()
    assert all(r.d.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() for r in rows) and len(rows) == odd_docs.count()
    assert all(r.d.n_tokens == 0 for r in rows if not r.text)
    assert no_docs.select(digest("text")).count() == 0
    encoded = odd_docs.select("text", bpe.encoder(spark, PATH, PATTERN)("text").alias("e"))
    back = encoded.select("text", bpe.decoder(spark, PATH, PATTERN)("e.ids").alias("b")).collect()
    assert all(bytes(r.b) == (r.text or "").encode() for r in back)


def test_stage(spark, odd_docs):
    out = bpe.stage(spark, odd_docs, "")
    assert out.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"] and out.count() == odd_docs.count()

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from larkspur.llm import simhash
from larkspur.llm.components import connected_components


def naive(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(values, linked):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = sorted(values)
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if linked(a, b):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {v: find(v) for v in values}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "one two", "One TWO three", "É é A\x0bb c d e f", "a b c " * 40_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == naive(text)


def test_golay_words_in_two_bits_share_a_key():
    golay, rng = simhash.Golay(), np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 4000)
    for bits in (0, 1, 2):
        other = words.copy()
        for _ in range(bits):
            other ^= 1 << rng.integers(0, 23, len(words))
        for a, b in zip(golay.keys(words).tolist(), golay.keys(other).tolist(), strict=True):
            assert {x for x in a if x >= 0} & {x for x in b if x >= 0}
    assert len(np.unique(golay.index(np.arange(1 << 16) << 7))) <= 4096


@pytest.mark.parametrize("bucket", [1, 8, 10**6])
def test_links(spark, bucket):
    random.seed(bucket)
    prints = {random.getrandbits(64) for _ in range(60)}
    for base in list(prints)[:12]:
        for _ in range(25):
            x = base
            for _ in range(random.choice([1, 2, 3])):
                x ^= 1 << random.randrange(64)
            prints.add(x)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = {r.node: r.component for r in connected_components(simhash.link_fingerprints(frame, bucket)).collect()}
    want = components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    groups = lambda name: sorted(sorted(signed(p) for p in prints if name(p) == g) for g in {name(p) for p in prints})
    assert groups(lambda p: found.get(signed(p), signed(p))) == groups(want.get)


def test_odd_rows(odd_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    by_print = components({naive(t) for _, t in texts}, lambda a, b: (a ^ b).bit_count() <= 2)
    for r in rows:
        own = by_print[r.fp & ((1 << 64) - 1)]
        ids = [k for k, t in texts if by_print[naive(t)] == own and k is not None]
        assert r.component == min(ids)


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def test_stage(spark, odd_docs):
    out = simhash.stage(spark, odd_docs, "")
    assert out.columns == odd_docs.columns
    kept = [r.doc_id for r in out.collect()]
    assert 4 not in kept and 3 in kept and kept.count(None) == 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (None, 3), (2000, 2001), (2001, 2000)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in connected_components(frame).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1100)}, 2000: 2000, 2001: 2000}
    assert connected_components(frame.filter(F.lit(False))).count() == 0

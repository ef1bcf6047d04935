"""Best names by weighted ratio against the ratio of every pair."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.functions.similarity import partial_ratio, sequence_ratio, weighted_ratio
from larkspur.operators import blocking, fuzzy

ALPHABETS = ("ab", "abcdefgh", "eatoinsh", "äβ字😀x")


def names(rnd: random.Random, count: int) -> list[str]:
    letters = rnd.choice(ALPHABETS)
    words = ["".join(rnd.choice(letters) for _ in range(rnd.choice([1, 2, 3, 5, 9]))) for _ in range(rnd.choice([5, 30, 200]))]
    made = (" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 2, 3, 4, 4, 7, 9]))) for _ in range(count))
    return sorted({n if rnd.random() < 0.97 else rnd.choice([" ", "  " + n, n * 4]) for n in made})


@pytest.mark.parametrize("seed", range(6))
def test_best_names_are_those_of_all_pairs(seed, monkeypatch):
    """Blocks, rare letters, odd names, ties and names of many records; scores are the very same numbers."""
    rnd = random.Random(seed)
    monkeypatch.setattr(fuzzy, "BLOCK", rnd.choice([7, 50]))
    monkeypatch.setattr(fuzzy, "LETTERS", rnd.choice([2, 5, 64]))
    monkeypatch.setattr(fuzzy, "HOPEFUL", 3)
    monkeypatch.setattr(fuzzy, "PAIRS", 16)
    refs, targets, top_k, least = names(rnd, 10), names(rnd, 70), rnd.choice([1, 3, 20]), rnd.choice([20.0, 60.0, 85.5])
    first, many = np.random.default_rng(seed).permutation(len(targets)), np.array([rnd.choice([1, 1, 2, 30]) for _ in targets])
    held = fuzzy.Names(targets, first, np.minimum(many, top_k))
    for a, (at, scores) in zip(refs, held.best(refs, top_k, least), strict=True):
        all_ = np.array([weighted_ratio(a, b) for b in targets])
        good = np.flatnonzero(all_ * 100 >= least)
        good = good[np.lexsort((first[good], -all_[good]))]
        reached = np.flatnonzero(np.cumsum(many[good]) >= top_k)
        good = good[:top_k][all_[good[:top_k]] >= (all_[good[reached[0]]] if len(reached) else 0)]
        assert list(at) == list(good)
        assert list(scores) == list(all_[good])


def test_windows_are_those_of_the_partial_ratio():
    rnd = random.Random(3)
    for n in (9, 300):
        long = ["".join(rnd.choice("abc") for _ in range(rnd.randint(7, n))) for _ in range(40)]
        short = ["".join(rnd.choice("abc") for _ in range(6)) for _ in long]
        table = np.zeros((n, 40), dtype=np.uint8)
        for k, text in enumerate(long):
            table[: len(text), k] = [ord(c) for c in text]
        got = fuzzy.windows(np.array([[ord(c) for c in s] for s in short], dtype=np.uint8).T, table, np.array([len(t) for t in long]))
        assert list(got) == [partial_ratio(s, t) for s, t in zip(short, long, strict=True)]


@pytest.mark.parametrize("variant", ["installed", "fallback"])
def test_records_are_ranked_by_score_then_id(spark, monkeypatch, variant):
    """Repeated names and ids, empty names, several chunks; pairs leave a task only if they can be among the best."""
    monkeypatch.setattr(fuzzy, "LEAST_NAMES", 4)
    best_names = fuzzy.best_names
    monkeypatch.setattr(blocking, "best_names", lambda *args: best_names(*args, ref_names=16, target_names=16))
    rnd, kernel = random.Random(7), sequence_ratio if variant == "fallback" else weighted_ratio
    pool = [*names(rnd, 40), "", "the one", "the one and only of them"]
    refs = [(f"S1-{k // 2 if k < 6 else k}", rnd.choice(pool)) for k in range(25)]
    targets = [(f"S{s}-{rnd.randrange(60):02}", s, rnd.choice(pool)) for s in (2, 3) for _ in range(90)]
    frames = spark.createDataFrame(refs, "entity_id string, name_norm string"), spark.createDataFrame(targets, "entity_id string, source int, name_norm string")
    got = blocking.fuzzy_top_k(*frames, 5, 60.0, variant)
    want = []
    for ref in {i for i, _ in refs}:
        for source in (2, 3):
            found = [(-kernel(a, b), i) for own, a in refs if own == ref and a for i, s, b in targets if s == source and b and kernel(a, b) * 100 >= 60]
            want += [(ref, i, source, -score) for score, i in sorted(found)[:5]]
    rows = got.select("s1_id", "candidate_id", "candidate_source", F.col("block_score")).collect()
    assert sorted(map(tuple, rows)) == sorted(want)
    assert want

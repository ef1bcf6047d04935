"""Rule scores within a product against the plain features, and the queries that use them instead of all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from larkspur.operators import bounds, pairs, products
from larkspur.operators import blocking as B
from larkspur.plans.catalogue import ORACLES, QUERIES
from larkspur.sources import records
from tests.conftest import SMALL, assert_same

BLOCKERS = ["exact_name", "token_name", "postal"]
ALONE = [
    "stream_static_er",
    "missed_pairs",
    "blocking_metrics",
    "pair_metrics",
    "matching_results",
    "error_table",
    "nb_entity_f05",
    "entity_f05",
    "validate_er",
]


@pytest.mark.parametrize("name", ALONE)
def test_pairs_are_not_all_made(spark, duck, name, monkeypatch):
    def never(*_):
        raise AssertionError("all candidate pairs are made and moved")

    monkeypatch.setattr(products, "shared_counts", never)
    monkeypatch.setattr(B, "shared_counts", never)
    made = QUERIES[name](spark, SMALL).toPandas()
    if name in ORACLES:
        assert_same(made, duck.sql(ORACLES[name]).df())


def odd_records(spark):
    """Equal, near, empty, long and non-Latin names and addresses, postal codes, and an id that repeats."""
    draw = random.Random(7)
    words = ["acme", "acne", "bolt", "日本", "straße", "x" * 70, "of", "the", "tools", "12345", "54321", "a"]
    rows = []
    for k in range(90):
        name = " ".join(draw.choices(words, k=draw.choice([0, 1, 2, 4, 20])))
        place = " ".join(draw.choices(words, k=draw.choice([0, 2, 5, 30])))
        rows.append((f"S{1 + k % 3}-{k:03d}", name, place, draw.choice(["IN", "DE", ""])))
    rows += [("S1-000", "acme tools", "12345", "IN"), ("S2-001", "acme tools", "bolt 12345", "IN")]
    return records.normalised(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in records.RAW)))


@pytest.mark.parametrize("floor", [0.0, 0.3, 0.6])
def test_scores_are_those_of_the_features(spark, floor):
    rec = odd_records(spark).cache()
    ref, tgt = rec.filter("source = 1"), rec.filter("source > 1")
    score = F.round("score", 9).alias("score")
    found = B.generate(ref, tgt, BLOCKERS).frame.select("s1_id", "candidate_id", "blockers")
    want = pairs.rule_score(pairs.pair_features(found, rec)).filter(F.col("score") >= floor).select("s1_id", "candidate_id", score)
    got = B.strong(ref, tgt, BLOCKERS, pairs.rule_floor(floor)).filter(F.col("score") >= floor).select("s1_id", "candidate_id", score)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert B.total(ref, tgt, BLOCKERS).first()[0] == found.count()
    every = ref.selectExpr("entity_id AS s1_id").distinct().join(tgt.selectExpr("entity_id AS candidate_id").distinct(), F.lit(True))
    held = B.among(every, ref, tgt, BLOCKERS)
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, found.select("s1_id", "candidate_id").collect()))


def test_lists_are_the_kept_pairs(spark):
    rec = odd_records(spark).cache()
    ref, tgt = rec.filter("source = 1"), rec.filter("source > 1")
    ids = ref.selectExpr("entity_id AS s1_id")
    want = pairs.matches_of(pairs.resolve(B.strong(ref, tgt, BLOCKERS, pairs.rule_floor(0.4)), 0.4, 0.7), ids)
    lists = B.strong_lists(ref, tgt, BLOCKERS, pairs.rule_floor(0.4), 0.7)
    got = pairs.lists_of(lists, ids, 0.4, 0.7)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert any(r.predicted for r in got.collect())


def test_distances_of_long_and_odd_strings():
    import numpy as np
    import pyarrow as pa

    draw = random.Random(3)
    texts = ["", "a", "é" * 5, "日本語", *["".join(draw.choices("abc é", k=n)) for n in (5, 63, 64, 65, 100, 128, 129, 300)]]
    one = bounds.Strings(pa.array(texts), 4)
    rows, at = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))

    def plain(a: str, b: str) -> int:
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            last = row
        return last[-1]

    assert bounds.distances(one, rows, one, at).tolist() == [plain(texts[r], texts[t]) for r, t in zip(rows, at, strict=True)]

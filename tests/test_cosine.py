"""The product of sparse vectors: only the best pairs of a chunk leave it, ties by id."""

from __future__ import annotations

import pytest

from larkspur.functions import vectors


@pytest.mark.parametrize("rows", [3, 1000])
def test_best_of_each_part_in_chunks(spark, monkeypatch, rows):
    monkeypatch.setattr(vectors, "TARGET_ROWS", rows)
    monkeypatch.setattr(vectors, "LEAST_ROWS", rows)
    texts = ["a b c", "a b c", "a b", "b c", "c d", "", "a a b", "a b c", "d e f"]
    targets = spark.createDataFrame([(f"t{k:02d}", 2 + k % 2, t.split()) for k, t in enumerate(texts * 2)], "id string, part int, terms array<string>")
    queries = spark.createDataFrame([(f"q{k}", t.split()) for k, t in enumerate([*texts, "z"])], "query string, terms array<string>")
    frame = vectors.cosine_top_k(queries, targets, 2, 0.3, 4)
    got = sorted((r.query, r.part, r.id, round(r.score, 9)) for r in frame.collect())
    assert "mapInArrow" in frame._jdf.queryExecution().toString().replace("MapInArrow", "mapInArrow")
    counts = vectors.term_counts(targets, ["id", "part"])
    idf = vectors.fit_idf(counts, targets.groupBy("part").count().withColumnRenamed("count", "rows"), ["part"], 4)
    sides = {}
    for frame, keys in ((counts, ["id", "part"]), (vectors.term_counts(queries, ["query"]), ["query"])):
        for r in vectors.weigh(frame, idf, keys, ["part"]).collect():
            sides.setdefault((r[keys[0]], r.part), {})[r.term] = r.weight
    want = []
    for (q, part), mine in sides.items():
        if q.startswith("q"):
            dots = [(-round(sum(w * v.get(t, 0) for t, w in mine.items()), 12), k) for (k, p), v in sides.items() if k.startswith("t") and p == part and set(v) & set(mine)]
            want += [(q, part, k, round(-s, 9)) for s, k in sorted(dots)[:2] if -s >= 0.3]
    assert got == sorted(want) and len(got) > 10

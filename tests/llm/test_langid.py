from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import langid
from larkspur.llm.sampling import sample_of
from tests.conftest import SMALL


def test_counts_are_those_of_plain_windows():
    for text in (None, "", "12 !?", "a", "Ab, cd é", "x" * 50, "日本 \U00010400a"):
        points = langid.letters_of(text)
        at, counts = langid.term_counts(text)
        want = sum(max(0, len(points) - n + 1) for n in (1, 2, 3)) if len(points) >= 3 else 0
        assert counts.sum() == want
    assert "".join(map(chr, langid.letters_of("Ab,  cd1É"))) == " ab cd é "


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = "some words of a text " * 300
    whole = langid.term_counts(text)
    monkeypatch.setattr(langid, "STEP", 64)
    assert all((a == b).all() for a, b in zip(whole, langid.term_counts(text), strict=True))


def test_temperature():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 3, 4000)
    logits = np.eye(3)[labels] + rng.normal(0, 1, (4000, 3)) * 0.7
    heat = langid.temperature(logits, labels)

    def loss(t):
        return -np.log(langid.softmax(logits / t)[np.arange(4000), labels]).mean()

    assert loss(heat) <= min(loss(heat * 1.05), loss(heat / 1.05)) + 1e-9
    assert langid.temperature(np.zeros((0, 3)), np.zeros(0, dtype=int)) == 1.0


def test_ftrl_learns_and_stays_sparse():
    rng = np.random.default_rng(0)
    model = langid.FtrlSoftmax(500, 2)
    rows = []
    for _ in range(400):
        label = int(rng.integers(2))
        rows.append((np.array([label, 2 + int(rng.integers(400))]), np.array([0.7, 0.7]), label))
    for k in range(0, 400, 16):
        part = rows[k : k + 16]
        model.learn([(np.sort(a), v) for a, v, _ in part], np.array([y for _, _, y in part]))
    w = model.weights()
    assert w[0, 0] > w[0, 1] and w[1, 1] > w[1, 0] and (w[450:] == 0).all()


def test_tables(spark):
    out = langid.query(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    joined = out.join(docs, "doc_id")
    held = joined.filter("held_out")
    assert held.filter("lang_pred = lang").count() >= 0.9 * held.count() > 0
    assert out.filter("score < 0 OR score > 1").count() == 0 and out.count() == docs.count()


@pytest.mark.parametrize("empty", [True, False])
def test_odd_rows(spark, odd_docs, no_docs, empty):
    train = (no_docs if empty else odd_docs).select(F.col("doc_id").alias("id"), "text", "lang")
    predict = langid.predictor(spark, langid.fit(train))
    rows = odd_docs.select("text", predict("text").alias("p")).collect()
    for r in rows:
        if not any(map(str.isalpha, r.text or "")) or empty:
            assert (r.p.lang_pred, r.p.score) == ("und", 0.0)
        else:
            assert r.p.lang_pred == "en" and 0 <= r.p.score <= 1


def test_sample_is_bounded_and_whole(spark):
    rows = spark.createDataFrame([(k % 400, "t", f"x{k}") for k in range(4000)] + [(None, "n", "y"), (None, "n", "z")], "id long, lang string, text string")
    picked = sample_of(rows, 1000).collect()
    assert 60 <= len(picked) <= 140 and len({r.id for r in picked}) == len(picked)
    assert len(sample_of(rows, 5000).collect()) == 401
    assert sample_of(rows.limit(0), 20).count() == 0

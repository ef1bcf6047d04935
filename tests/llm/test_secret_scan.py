from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.llm import secret_scan as S

KINDS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
]


def brute(text):
    return sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(KINDS) for m in p.finditer(text) if ok(m))


PIECES = st.sampled_from(["token", "API_KEY", "password", "=", ": ", '"', " ", "AKIA", "ABCDEFGHIJ1234", "0123456789abcdef", "xyzxyzxyzxyz", "é", "\n", "short", "ſecret", "toKen"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=12))
def test_base_spans(parts):
    text = "".join(parts)
    assert S.base_spans(text) == brute(text)


def test_gradients():
    """Against differences of the loss."""
    rng = np.random.default_rng(1)
    codes, labels, weights = rng.integers(0, len(S.LOOKUP) + 2, (5, 20)), np.array([0, 1, 1, 0, 1.0]), np.array([1, 2, 1, 1, 3.0])
    net = S.CharCnn(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}

    def loss():
        z = net.logits(codes)
        return (weights * (np.log1p(np.exp(z)) - labels * z)).sum() / weights.sum()

    want = {}
    for name, at in (("w", (7, 3)), ("b", (2,)), ("o", (5,)), ("o", (40,)), ("c", (0,)), ("e", (int(codes[1, 9]), 4))):
        if name == "e" and at[0] == 0:
            continue
        held = net.p[name][at]
        net.p[name][at] = held + 1e-5
        up = loss()
        net.p[name][at] = held - 1e-5
        want[name, at] = (up - loss()) / 2e-5
        net.p[name][at] = held
    net._m = {k: np.zeros_like(v) for k, v in net.p.items()}
    net._v = {k: np.zeros_like(v) for k, v in net.p.items()}
    net.learn(codes, labels, weights)
    for (name, at), slope in want.items():
        assert 10 * net._m[name][at] == pytest.approx(slope, rel=1e-2, abs=1e-5)


@pytest.fixture(scope="module")
def model(spark):
    rng = np.random.default_rng(0)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    rows = []
    for k in range(1200):
        text = " ".join("".join(rng.choice(letters, int(rng.integers(3, 16)))) for _ in range(30))
        if k % 4 == 0:
            text += ' token = "' + "".join(rng.choice(list("0123456789abcdef"), 40)) + '" and more'
        rows.append((k, text))
    docs = spark.createDataFrame(rows, "id long, text string")
    return docs, S.fit(docs)


def test_added_spans(model):
    docs, made = model
    rng = np.random.default_rng(9)
    letters = list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz23456789")
    secrets = ["".join(rng.choice(letters, 32)) for _ in range(60)]
    spans = made.scan([f"the pwd: {x} and internationalization is long" for x in secrets])
    assert sum(s == [(9, 3, 41)] for s in spans) >= 45 and all(s in ([], [(9, 3, 41)]) for s in spans)
    texts = [r.text for r in docs.collect()]
    for text, spans in zip(texts, made.scan(texts), strict=True):
        assert [s for s in spans if s[1] < 3] == brute(text)
    assert sum(s[1] == 3 for spans in made.scan(texts) for s in spans) == 0


def test_odd_rows(spark, odd_docs, no_docs, model):
    for fitted in (model[1], S.fit(odd_docs.selectExpr("doc_id AS id", "text")), S.fit(no_docs.selectExpr("doc_id AS id", "text"))):
        rows = odd_docs.select("text", S.scanner(spark, fitted)("text").alias("s")).collect()
        assert len(rows) == odd_docs.count()
        for r in rows:
            base = ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in brute(r.text or ""))
            assert r.s.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert no_docs.select(S.scanner(spark, model[1])("text")).count() == 0


def test_long_candidates(model):
    text = "aB3" * 1000
    assert all(e <= 3000 for spans in model[1].scan([text, None, ""]) for _, _, e in spans)


def test_threshold():
    up, down = np.linspace(0.6, 1, 50), np.linspace(0, 0.4, 50)
    assert 0.5 <= S.threshold_of(up, down) <= 0.6 and S.threshold_of(up[:0], down) == 1.0
    t = S.threshold_of(np.linspace(0.7, 1, 100), np.array([0.1, 0.9]))
    assert t <= np.sort(np.linspace(0.7, 1, 100))[2]


def test_threshold_keeps_recall_of_low_scores():
    positive, negative = np.linspace(0.1, 0.4, 100), np.linspace(0.0, 0.09, 1000)
    threshold = S.threshold_of(positive, negative)
    assert 0.09 < threshold < 0.5 and (positive >= threshold).mean() >= S.RECALL

from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import toxicity
from larkspur.llm.langid import held_out


@pytest.fixture(scope="module")
def model(spark):
    words = ["idiot", "moron", "worthless", "hello", "stupid", "today", "scum", "clown", "disgusting", "pathetic"]
    docs = spark.createDataFrame([(k, f"{w} " * 30) for k, w in enumerate(words)], "doc_id long, text string")
    return toxicity.CharModel(toxicity.corpus_counts(docs))


@pytest.mark.parametrize(
    "token,want",
    [("1d10t", "idiot"), ("m0r0n", "moron"), ("w0rthle55", "worthless"), ("i.d.i.o.t", "idiot"), ("stuuuupid", "stupid"), ("$cum", "scum"),
     ("cl0wn!!", "clown"), ("hello,", "hello"), ("123", ""), ("---", ""), ("d!sgust!ng", "disgusting"), ("the$$$", "the"), ("", "")],
)
def test_restore(model, token, want):
    assert model.restore(token) == want


def test_spaced(model):
    assert model.spaced(list("idiot")) == "idiot" and model.spaced(list("1d10t")) == "idiot"


def test_decoding_is_the_cheapest_reading(model):
    """Against all readings of short tokens, one by one."""
    for token in ("1d10t", "m0r0n", "s7up1d"):
        options = [[(c, 0.0)] if c.isalpha() else [(x, toxicity.LEET_COST) for x in toxicity.LEET[c]] + [("", toxicity.DROP_SYMBOL_COST)] for c in token]
        best = min(itertools.product(*options), key=lambda p: sum(x[1] for x in p) + model.word_cost("".join(x[0] for x in p)))
        assert model.decode(token) == "".join(x[0] for x in best)


def test_long_tokens(model):
    assert len(model.restore("1d10t" * 400)) > 1000


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(0)
    plain = ["sun", "moon", "tree", "house", "river", "stone", "cloud", "light", "paper", "glass"]
    rows = []
    for k in range(900):
        text = [str(w) for w in rng.choice(plain, 40)]
        if k % 6 == 0:
            text[int(rng.integers(40))] = str(rng.choice(["idiot", "moron", "scum"]))
        rows.append((k, " ".join(text), int(k % 6 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()


def test_held_out_accuracy(spark, corpus):
    made = toxicity.fit(corpus.select("doc_id", "text"), corpus.select("doc_id", "toxic"))
    out = corpus.withColumn("score", toxicity.scorer(spark, made)("text")).filter(held_out(F.col("doc_id")))
    assert out.filter((F.col("score") >= toxicity.THRESHOLD) != (F.col("toxic") == 1)).count() == 0
    assert made.score("you are a m0r0n under the sun") >= toxicity.THRESHOLD
    assert 0 <= made.score(None) == made.score("") < toxicity.THRESHOLD


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1), (99, 1), (4, 0), (6, 0)], "doc_id long, toxic int")
    for docs in (odd_docs, no_docs):
        for known in (labels, labels.limit(0)):
            made = toxicity.fit(docs.select("doc_id", "text"), known)
            scores = [r.s for r in docs.select(toxicity.scorer(spark, made)("text").alias("s")).collect()]
            assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)


def test_repeated_ids_teach_once(spark, corpus):
    one, labels = corpus.select("doc_id", "text"), corpus.select("doc_id", "toxic")
    copies = one.filter("doc_id = 1").crossJoin(spark.range(400)).select("doc_id", "text")
    hot = toxicity.fit(one.union(copies), labels).parts
    want = toxicity.fit(one, labels).parts
    assert (hot[0] != want[0]).any()  # all texts are counted
    assert abs(toxicity.ToxicityModel(*hot).score("scum") - toxicity.ToxicityModel(*want).score("scum")) < 0.05
    picked = toxicity.sampled_texts(one.union(copies), labels.withColumnRenamed("doc_id", "id"))
    assert picked.count() == corpus.count()


def test_stage(spark, corpus, tmp_path):
    corpus.select("doc_id", "toxic").write.parquet(f"file://{tmp_path}/labels.parquet")
    docs = corpus.select("doc_id", "text").withColumn("score", F.lit("clash"))
    out = toxicity.stage(spark, docs, f"file://{tmp_path}")
    assert out.columns == docs.columns and out.count() == corpus.filter("toxic = 0").count()

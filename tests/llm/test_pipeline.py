from __future__ import annotations

import hashlib

import corpus_pipeline
from larkspur.llm import bpe, decontam, toxicity
from larkspur.llm.simhash import fingerprint
from tests.conftest import SMALL
from tests.llm.test_line_dedup import brute as line_brute
from tests.llm.test_simhash import components


def test_against_brute_force(spark):
    """Model scores and alignments come from the operators; everything else is done once more by hand."""
    source = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = {r.doc_id: r.text for r in source.collect()}
    kept = toxicity.stage(spark, source, SMALL)
    assert kept.columns == source.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert 0 < len(rows) < len(docs)
    rows = line_brute(rows)
    groups = components({fingerprint(t) for _, t in rows}, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for k, t in rows:
        g = groups[fingerprint(t)]
        least[g] = min(least.get(g, k), k)
    rows = [(k, t) for k, t in rows if least[groups[fingerprint(t)]] == k]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    leaked = {r.doc_id for r in decontam.matches(frame, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert leaked
    want = {k: t for k, t in rows if k not in leaked}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(got) == set(want)
    coder = bpe.ByteBpe(open(bpe.default_vocabulary()[0], "rb").read(), bpe.default_vocabulary()[1])
    for k, t in want.items():
        assert got[k].ids == coder.encode(t) and got[k].n_tokens == len(got[k].ids)
        assert got[k].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontaminate", "tokenize"]

from __future__ import annotations

import corpus_pipeline
from larkspur.llm import decontam, toxicity
from tests.conftest import SMALL
from tests.llm.test_jaccard import brute
from tests.llm.test_line_dedup import brute as line_brute


def test_pipeline_keeps_one_of_each_group_of_similar_texts(spark):
    """Groups by all pairs of 5-word shingle sets at 0.8; model scores and alignments come from the operators."""
    source = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted(line_brute([(r.doc_id, r.text) for r in toxicity.stage(spark, source, SMALL).collect()]))
    least = brute([t for _, t in rows])
    kept = [row for k, row in enumerate(rows) if least[k] == k]
    assert 0 < len(kept) < len(rows)
    frame = spark.createDataFrame(kept, "doc_id long, text string")
    leaked = {r.doc_id for r in decontam.matches(frame, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert leaked
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()) == [k for k, _ in kept if k not in leaked]

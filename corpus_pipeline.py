"""A training-data pipeline: five operators over whole documents, one table after another.

Every stage gets what its predecessor kept, as Parquet that is read again, so a lost executor costs
one stage at most and no plan spans two stages.  All but the last stage return the columns of
documents.

1. toxicity: documents scored 0.3 or more go.
2. line_dedup: lines of 20 characters or more found in three documents stay in the last one only.
3. near_dedup: of documents linked by 5-word Jaccard similarity of 0.8 or more the one of smallest id stays.
4. decontaminate: documents that hold a benchmark passage go.
5. tokenize: byte-level BPE ids, their digest, and the digest of the decoded bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import bpe, decontam, line_dedup, simhash, toxicity
from larkspur.llm.storage import materialize, remove, scratch

STAGES = [
    ("toxicity", toxicity.stage),
    ("line_dedup", line_dedup.stage),
    ("near_dedup", simhash.stage),
    ("decontaminate", decontam.stage),
    ("tokenize", bpe.stage),
]

#: SQL can express neither the toxicity model nor the fingerprints: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        docs = materialize(stage(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
        before = path
    return docs

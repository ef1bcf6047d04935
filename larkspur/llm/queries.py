"""The registered queries of this subpackage and the SQL that says the same."""

from __future__ import annotations

from larkspur.llm import bpe, decontam, embed_dedup, langid, line_dedup, secret_scan, sharding, simhash, toxicity, warc

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_simhash_near_dedup": simhash.query,
    "op3_decontamination": decontam.query,
    "op4_embedding_near_dedup": embed_dedup.query,
    "op5_toxicity": toxicity.query,
    "op6_byte_bpe": bpe.query,
    "op7_warc": warc.query,
    "op8_secret_scan": secret_scan.query,
    "op9_sharding": sharding.query,
    "op10_language_id": langid.query,
}

ORACLES = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op4_embedding_near_dedup": embed_dedup.ORACLE,
    "op7_warc": warc.ORACLE,
}

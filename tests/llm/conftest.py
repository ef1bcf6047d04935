from __future__ import annotations

import pytest

CLASH = "id string, pos string, fp string, text_hash string, line_dedup string, score string, h1 string, shard string, batch string, block string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    line = "The quick brown fox jumps over it"
    texts = [
        (0, line), (1, line + "\nother words here for a change"), (2, "  " + line.upper() + " \n" + line), (3, None), (4, ""), (5, " \t "),
        (6, "word " * 60_000), (7, "x" * 300_000), (8, "\n" * 50_000), (None, line), (None, None), (2, "  " + line.upper() + " \n" + line),
        (9, "1234567890 !!! ???"), (10, "日本語 テキスト \U0001f600 é"), (11, "i d i o t you 1d10t"),
    ]
    rows = [(k, t, "en" if k and k % 2 else None, None, None, *["clash"] * 10) for k, t in texts]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}").repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

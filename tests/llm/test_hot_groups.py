"""A third of all rows in one group: results stay whole and nothing is paired within the group."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from larkspur.llm import decontam, embed_dedup, line_dedup, simhash, warc
from larkspur.llm.storage import scratch

ROWS = 3000
LINE = "one very common line that many documents hold"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    words = ["w%d" % k for k in range(400)]
    base = [rng.choice(words) for _ in range(400)]
    rows = []
    for k in range(ROWS):
        if k % 3 == 0:
            text = " ".join(base)  # exact copies
        elif k % 3 == 1:
            near = list(base)
            near[rng.randrange(400)] = rng.choice(words)
            text = " ".join(near)
        else:
            text = LINE + "\n" + " ".join(rng.choice(words) for _ in range(40))
        rows.append((k, text))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(8).cache()


def test_line_dedup(docs):
    out = line_dedup.dedup_lines(docs).select("doc_id", "line_dedup.*")
    kept = out.filter(F.col("kept_text").contains(LINE)).collect()
    assert [r.doc_id for r in kept] == [ROWS - 1]
    assert out.filter("doc_id % 3 = 0 AND n_dropped = 1").count() == ROWS // 3 - 1


def test_simhash(docs):
    rows = simhash.near_duplicates(docs).collect()
    copies = {r.component for r in rows if r.id % 3 == 0}
    assert copies == {0} and len(rows) == ROWS
    prints = {r.id: r.fp & ((1 << 64) - 1) for r in rows}
    near = [r for r in rows if r.id % 3 == 1 and (prints[r.id] ^ prints[0]).bit_count() <= 2]
    assert near and all(r.component == 0 for r in near)


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, LINE)], "item_id long, text string")
    assert decontam.matches(docs, items).count() == ROWS // 3


def test_embeddings(spark):
    rng = random.Random(5)
    hot = [rng.gauss(0, 1) for _ in range(16)]
    rows = [(k, hot if k % 3 == 0 else [rng.gauss(0, 1) for _ in range(16)]) for k in range(ROWS)]
    found = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    row = found.filter("id % 3 = 0").agg(F.min("n_links"), F.max("n_links"), F.max("component")).first()
    assert row[0] == row[1] >= ROWS // 3 - 1 and row[2] == 0


def test_warc(spark, docs):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.col("text").alias("html"))
    found = warc.read_archives(warc.write_archives(pages, scratch(spark, "warc-hot")))
    text = docs.filter("doc_id = 0").first().text
    copies = docs.filter(F.col("text") == text).count()  # a changed word may be the old one
    assert found.filter("record_type = 'revisit' AND refers_to = '0'").count() == copies - 1 >= ROWS // 3 - 1

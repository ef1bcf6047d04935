from __future__ import annotations

from larkspur.llm import decontam
from tests.conftest import SMALL

ITEM = "The farmer has 12 apples and sells 5 of them to Alice for 3 dollars each. How many are left?"


def run(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): (r.covered, r.slots_changed) for r in decontam.matches(d, b).collect()}


def test_new_numbers_and_names_are_found(spark):
    docs = [
        "Well now. " + ITEM, ITEM.replace("12", "40").replace("5", "7").replace("Alice", "Bob"),
        "farmer has 12 apples and sells 12 of them to Alice for 12 dollars each. How many are left?", "something else altogether, with 12 words and 5 more",
        ITEM.lower().replace("alice", "Alice"),
    ]
    found = run(spark, docs, [ITEM, "short one", None, ""])
    assert found[0, 0] == (20, 0) and found[1, 0][1] == 3
    assert (2, 0) not in found and (3, 0) not in found and (4, 0) in found


def test_short_items(spark):
    assert run(spark, ["x one two three four five six y", "one two three"], ["one two three four five six", "one two"]) == {(0, 0): (6, 0)}


def test_tables_against_plain_windows(spark):
    """On the test tables the passages are verbatim: the same documents as any eight equal words."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    runs = {tuple(w[k : k + 8]) for w in (i.text.lower().split() for i in items) for k in range(len(w) - 7)}
    want = {d.doc_id for d in docs if any(tuple(w[k : k + 8]) in runs for w in [d.text.lower().split()] for k in range(len(w) - 7))}
    got = {r.doc_id for r in decontam.query(spark, SMALL).collect()}
    assert got == want and got


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over it"), (None, "word word word word word word word word word"), (2, None)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.matches(odd_docs, items).collect()}
    assert {(0, 1), (1, 1), (2, 1), (None, 1), (6, None)} <= found and all(d != 7 for d, _ in found)
    assert decontam.matches(no_docs, items).count() == 0
    assert decontam.matches(odd_docs, items.limit(0)).count() == 0


def test_stage(spark, odd_docs, tmp_path):
    spark.createDataFrame([(1, "the quick brown fox jumps over it")], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    out = decontam.stage(spark, odd_docs, f"file://{tmp_path}")
    assert out.columns == odd_docs.columns
    assert {r.doc_id for r in out.collect()} == {3, 4, 5, 6, 7, 8, 9, 10, 11, None}  # a null id cannot be matched away

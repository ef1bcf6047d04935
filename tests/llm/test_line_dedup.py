from __future__ import annotations

import hashlib
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from larkspur.llm import line_dedup

BLANK = " \t\n\x0b\x0c\r"


def brute(docs, min_chars=20, min_docs=3):
    """rows (id, text) -> kept text of each row."""
    key = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s.strip(BLANK))
    holders = defaultdict(list)
    for k, text in docs:
        for one in {key(x) for x in (text or "").split("\n")}:
            holders[one].append(k)
    out = []
    for k, text in docs:
        kept = []
        for line in (text or "").split("\n"):
            held = holders[key(line)]
            known = [h for h in held if h is not None]
            gone = len(key(line)) >= min_chars and len(held) >= min_docs and known and (k is None or k < max(known))
            if not gone:
                kept.append(line)
        out.append((k, "\n".join(kept)))
    return out


def run(frame, **more):
    rows = line_dedup.dedup_lines(frame, **more).select("doc_id", "line_dedup.*").collect()
    return [(r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in rows]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert order([(a, b) for a, b, _, _ in run(odd_docs)]) == order(brute(rows))


def test_counts(odd_docs):
    found = {(a, c): d for a, b, c, d in run(odd_docs) if a is not None}
    assert found[2, 2] == 0 and found[0, 1] == 1 and found[1, 2] == 1 and found[3, 1] == 0 and found[8, 50_001] == 0


def test_empty(no_docs):
    assert run(no_docs) == []


def test_stage_keeps_columns(spark, odd_docs):
    out = line_dedup.stage(spark, odd_docs, "")
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()


def test_stage_keeps_a_column_named_like_its_own(spark, odd_docs):
    out = line_dedup.stage(spark, odd_docs, "")
    assert out.schema["line_dedup"].dataType == odd_docs.schema["line_dedup"].dataType
    assert {r.line_dedup for r in out.collect()} == {"clash"}


LINE = st.sampled_from(["a line of twenty chars", "A LINE of twenty chars ", "another long line here", "short", "", "third line that is long"])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(LINE, max_size=5), min_size=1, max_size=12), st.sampled_from([1, 2, 5]))
def test_random(spark, docs, batches):
    rows = [(k, "\n".join(lines)) for k, lines in enumerate(docs)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert order([(a, b) for a, b, _, _ in run(frame, batches=batches)]) == order(brute(rows))


def test_runs_compact(spark):
    runs = line_dedup.LineRuns(spark, 2)
    for owner in (9, 5, 3, 1):
        runs.add(spark.createDataFrame([(1, 1, 1, owner), (owner, 0, 1, owner)], "h1 long, h2 long, n_docs long, owner long"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    found = {r.h1: (r.n_docs, r.owner) for r in runs.all().collect() if r.h2}
    assert found == {1: (2, 9)}  # settled after two batches, never stored again

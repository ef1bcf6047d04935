from __future__ import annotations

import random

import pytest

from larkspur.llm import jaccard, simhash
from tests.conftest import SMALL
from tests.llm.test_simhash import components


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def brute(texts):
    """Smallest id of each id's component."""
    sets = [shingles(t) for t in texts]
    found = components(range(len(texts)), lambda a, b: similar(sets[a], sets[b]))
    return [found[k] for k in range(len(texts))]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    words = ["w%d" % k for k in range(300)]
    out = []
    for length in (4, 12, 40, 90, 90, 200):
        base = [rng.choice(words) for _ in range(length)]
        for _ in range(45):
            near = list(base)
            for _ in range(rng.randrange(5)):
                near[rng.randrange(len(near))] = rng.choice(words)
            out.append(" ".join(near[: len(near) - rng.randrange(1 + length // 8)]))
    out += [" ".join(rng.choice(words) for _ in range(60)) for _ in range(60)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("bucket", [1, 6, 10**6])
def test_against_all_pairs(spark, texts, bucket):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.id: r.component for r in jaccard.near_duplicates(docs, pair_bucket=bucket).collect()}
    want = brute(texts)
    assert 20 < len(set(want)) < len(texts) - 100
    assert [found[k] for k in range(len(texts))] == want


def test_stage_finds_copies_beyond_two_bits(spark):
    rng = random.Random(3)
    base = ["w%d" % rng.randrange(10**6) for _ in range(200)]
    near = list(base)
    for at in (40, 110, 160):
        near[at] = "other"
    a, b = " ".join(base), " ".join(near)
    assert (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count() > 2
    docs = spark.createDataFrame([(1, a), (2, b), (3, "something else altogether in here")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.stage(spark, docs, "").collect()) == [1, 3]


def test_odd_rows(odd_docs, no_docs):
    rows = jaccard.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count() and jaccard.near_duplicates(no_docs).count() == 0
    assert {r.component for r in rows if r.id in (3, 4, 5)} == {3}


def test_stage_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want = {rows[k][0] for k, least in enumerate(brute([t for _, t in rows])) if least == k}
    assert {r.doc_id for r in simhash.stage(spark, docs, SMALL).collect()} == want


def test_long_texts_whose_sketches_differ_in_size(spark):
    words = ["w%d" % k for k in range(1300)]
    one, near, far = (" ".join(words[:n]) for n in (1000, 1200, 1300))
    sizes = [len(jaccard.sketch_of(jaccard.shingle_set(t))) for t in (one, near)]
    assert sizes == [32, 64]
    docs = [(1, one), (2, near), (3, "else " + " ".join(reversed(words))), (4, " ".join(words[:999]) + " other")]
    docs.append((5, far))
    found = {r.id: r.component for r in jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [found[k] for k in range(1, 6)] == [k + 1 for k in brute([t for _, t in docs])] == [1, 1, 3, 1, 1]
    alone = spark.createDataFrame([(1, one), (2, far)], "doc_id long, text string")
    assert sorted(r.component for r in jaccard.near_duplicates(alone).collect()) == [1, 2]


def test_stage_links_by_fingerprints_too(spark):
    """The method's own links: two bits apart or less, though the sets of 5-word shingles differ."""
    base = "every part of this line comes again and again in both " * 60
    a, b = (base + " ".join(f"{w}{k}" for k in range(30)) for w in ("one", "two"))
    assert (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count() <= 2
    assert not similar(shingles(a), shingles(b))
    docs = spark.createDataFrame([(1, a), (2, b), (3, "something else altogether in here")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.stage(spark, docs, "").collect()) == [1, 3]


def test_common_shingles_of_large_tables(spark):
    """Passages that 48 texts hold are known as common however many other texts there are, or buckets would grow with the table."""
    spread = "CASE WHEN id % 1333 < 40 THEN concat_ws(' ', 'p' || (id % 1333), 'of', 'one', 'known', 'passage') ELSE concat('a', id, ' b', id, ' c') END"
    docs = spark.range(64_000).selectExpr("id", f"{spread} || ' u' || id AS text")
    common = set(jaccard.common_shingles(docs).tolist())
    found = sum(jaccard.shingle_set(f"p{k} of one known passage").tolist()[0] in common for k in range(40))
    assert found > 24

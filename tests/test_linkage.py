"""The seven-record fixture from blocking to F0.5, sinks, checks and the stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from larkspur.operators import blocking, pairs, production, submission
from larkspur.operators.blocking import CandidateSet, generate
from larkspur.plans import data
from larkspur.sources import records
from larkspur.streaming.linkage import link, link_stream, read_stream
from tests.conftest import SMALL

RAW = [
    ("S1-001", "Apollo Pharmacy", "123 Mahatma Gandhi Road, Chennai 600001", "India"),
    ("S1-002", "Tata Motors Ltd", "Pune 411001", "IN"),
    ("S1-003", "ABC Textiles", "", "IND"),
    ("S2-101", "Apollo Pharmacy Pvt Ltd", "123 MG Rd Chennai 600001", "India"),
    ("S2-102", "Tata Motors", "Pune", "India"),
    ("S2-103", "XYZ Industries", "Mumbai 400001", "India"),
    ("S2-104", "ABC Textile Corp", "Delhi", "India"),
]
BLOCKERS = ["exact_name", "token_name", "postal"]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(RAW, ", ".join(f"{c} string" for c in records.RAW)).cache()


@pytest.fixture(scope="module")
def rec(raw):
    return records.normalised(raw).cache()


@pytest.fixture(scope="module")
def truth(spark):
    return spark.createDataFrame([("S1-001", ["S2-101"]), ("S1-002", ["S2-102"]), ("S1-003", [])], "s1_id string, truth array<string>")


@pytest.fixture(scope="module")
def scored(rec):
    found = generate(rec.filter("source = 1"), rec.filter("source > 1"), BLOCKERS)
    return pairs.rule_score(pairs.pair_features(found.frame, rec)).cache()


def test_golden_pairs(scored):
    rows = {(r.s1_id, r.candidate_id): r for r in scored.collect()}
    assert set(rows) == {("S1-001", "S2-101"), ("S1-002", "S2-102"), ("S1-003", "S2-104")}
    apollo = rows["S1-001", "S2-101"]
    assert apollo.score == pytest.approx(0.68403, abs=1e-5)
    assert (apollo.addr_edit_sim, apollo.addr_postal_match, apollo.evidence_strength, apollo.block_count) == (1, 1, 1, 2)
    assert rows["S1-002", "S2-102"].score == pytest.approx(0.56391, abs=1e-5)
    assert rows["S1-003", "S2-104"].score == pytest.approx(0.36670, abs=1e-5)
    assert len(scored.columns) == 2 + 58 + 1


@pytest.mark.parametrize("threshold,want", [(0.3, 2 / 3), (0.5, 1.0)])
def test_golden_f05(scored, truth, rec, threshold, want):
    s1 = rec.filter("source = 1").select(F.col("entity_id").alias("s1_id"))
    predicted = pairs.matches_of(pairs.resolve(scored, threshold), s1)
    assert pairs.entity_f05(truth, predicted).first().macro_f05 == pytest.approx(want)


def test_blocking_metrics(scored, truth):
    row = pairs.blocking_metrics(truth, scored, 4).first()
    assert (row.recall, row.possible_pairs, row.reduction_ratio) == (1.0, 12, 0.75)


def test_optimize_threshold(scored, truth):
    threshold, score = pairs.optimize_threshold(scored, truth)
    assert score == 1.0 and threshold == pytest.approx(0.37)


@pytest.mark.parametrize(
    "t,p,want", [(["a", "b"], ["a"], 0.8333), (["a"], ["a", "x"], 0.5556), ([], [], 1.0), ([], ["x"], 0.0), (["a"], [], 0.0)]
)
def test_f05_values(spark, t, p, want):
    schema = "s1_id string, {} array<string>"
    row = pairs.entity_f05(spark.createDataFrame([("q", t)], schema.format("truth")), spark.createDataFrame([("q", p)], schema.format("predicted")))
    assert row.first().macro_f05 == pytest.approx(want, abs=1e-4)


def test_f05_of_nothing(spark):
    empty = spark.createDataFrame([], "s1_id string, truth array<string>")
    row = pairs.entity_f05(empty, spark.createDataFrame([("q", ["x"])], "s1_id string, predicted array<string>")).first()
    assert (row.macro_f05, row.entities, row.tp) == (0.0, 0, 0)


def test_resolver(spark):
    rows = spark.createDataFrame([("q", "b", 0.9), ("q", "a", 0.9), ("q", "c", 0.95), ("r", "a", 0.2)], "s1_id string, candidate_id string, score double")
    kept = [(r.s1_id, r.candidate_id) for r in pairs.resolve(rows, 0.5, 0.5).orderBy("rank").collect()]
    assert kept == [("q", "c"), ("q", "a"), ("q", "b")]
    assert pairs.resolve(rows, 0.5, 0.92).count() == 1
    assert pairs.resolve(rows, 0.5, 0.5, max_matches=2).count() == 2


def test_token_bags_and_rare_tokens(spark):
    rows = [("S1-1", "foo foo bar", "", ""), ("S2-1", "foo foo", "", ""), ("S3-1", "foo", "", "")]
    rec = records.normalised(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in records.RAW)))
    a, b = rec.filter("source = 1"), rec.filter("source > 1")
    from larkspur.operators.blocking import rare_token, token_name

    assert {r.candidate_id: r.block_score for r in token_name(a, b).collect()} == pytest.approx({"S2-1": 4 / 3, "S3-1": 2 / 3})
    assert {r.candidate_id: r.block_score for r in rare_token(a, b).collect()} == {"S2-1": 0.5, "S3-1": 1.0}


def test_candidate_set(rec):
    a, b = rec.filter("source = 1"), rec.filter("source > 1")
    found = generate(a, b, ["token_name"]).merge(generate(a, b, ["postal"]))
    assert isinstance(found, CandidateSet)
    assert found.contains("S1-001", "S2-101") and not found.contains("S1-001", "S2-103")
    row = found.table().filter("s1_id = 'S1-001'").first()
    assert (row.block_count, row.blockers) == (2, "postal,token_name")
    assert found.candidates_for("S1-002").count() == 1
    assert {r.s1_id: r.candidates for r in found.candidate_map().collect()}["S1-003"] == ["S2-104"]


def test_record_store(rec, spark):
    store = records.RecordStore.from_sources(rec.filter("source = 1"), rec.filter("source = 2"))
    assert store.get_field("S1-002", "name_norm") == "tata motors limited"
    assert store.get_field("S9", "name_norm") is None
    assert store.source_ids(2).count() == 4 and store.all_ids().count() == 7
    with pytest.raises(ValueError, match="repeated"):
        records.RecordStore.from_sources(rec, rec)


def test_tsv_round_trip(spark, tmp_path, scored, rec, truth):
    path = tmp_path / "s1.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"a ""b"""\t\tIN\n S1-2 \tx\ty\t\n')
    loaded = {r.entity_id: r for r in records.load_source_tsv(spark, str(path), 1).collect()}
    assert loaded["S1-1"].name_raw == 'a "b"' and loaded["S1-1"].address_raw == "" and loaded["S1-2"].country_norm == ""
    with pytest.raises(Exception, match="another source"):
        records.load_source_tsv(spark, str(path), 2).collect()
    gt = tmp_path / "gt.tsv"
    gt.write_text("my_s1\tthe_matches\nS1-1\tS2-1, S3-2,S2-1\nS1-2\tnan\nS1-3\t\n")
    assert {r.s1_id: r.truth for r in records.load_ground_truth(spark, str(gt)).collect()} == {"S1-1": ["S2-1", "S3-2"], "S1-2": [], "S1-3": []}
    s1 = rec.filter("source = 1").select(F.col("entity_id").alias("s1_id"))
    kept = pairs.resolve(scored, 0.5)
    report = submission.write_package(spark, kept, scored, s1, rec.filter("source > 1"), str(tmp_path / "out"))
    assert report == {"records": 3, "matched": 2}
    back = records.load_ground_truth(spark, str(tmp_path / "out/matching_results.tsv"))
    assert {r.s1_id: r.truth for r in back.collect()} == {"S1-001": ["S2-101"], "S1-002": ["S2-102"], "S1-003": []}
    problems = {r.problem: r.n for r in submission.validate_tsv(spark, str(tmp_path / "out/matching_results.tsv")).collect()}
    assert not any(problems.values())
    assert submission.aligned(back.orderBy("s1_id"), back.orderBy("s1_id")) == 0
    with pytest.raises(ValueError, match="match_not_candidate"):
        submission.write_package(spark, kept, scored.filter("s1_id = 'none'"), s1, rec.filter("source > 1"), str(tmp_path / "bad"))


def test_production_engine(raw, truth):
    rec = records.production_records(raw)
    q, t = rec.filter("source = 1"), rec.filter("source > 1")
    found = production.candidates(q, t)
    assert {(r.s1_id, r.target_id) for r in found.filter("rank = 1").collect()} >= {("S1-001", "S2-101"), ("S1-002", "S2-102")}
    made = production.pair_features(found, q, t)
    assert len(made.columns) == 3 + 46
    gone = production.missing_positives(found.filter("s1_id <> 'S1-001'"), truth, t).collect()
    assert [(r.s1_id, r.target_id, r.label) for r in gone] == [("S1-001", "S2-101", 1)]
    scored = made.select("s1_id", "target_id", "target_source", F.col("name_ratio").alias("score"))
    policy, score = production.search_policy(scored, truth)
    assert score == pytest.approx(2 / 3) and len(policy) == 4  # the singleton has a like name


def test_evidence_cap(spark):
    limits = production.Limits(max_evidence=2)
    rows = [("S1-1", "aaa bbb", "road 75001", "fr")] + [(f"S2-{k}", "aaa bbb" if k < 2 else "other", "lane 75001", "fr") for k in range(6)]
    rec = records.production_records(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in records.RAW)))
    found = production.evidence(rec.filter("source = 1"), rec.filter("source > 1"), limits)
    assert sorted(r.target_id for r in found.collect()) == ["S2-0", "S2-1"]


def test_scan_stops_at_the_first_failure(spark):
    rows = [("q", "a", 2, 0.9), ("q", "b", 3, 0.8), ("q", "c", 2, 0.79), ("r", "a", 2, 0.4)]
    scored = spark.createDataFrame(rows, "s1_id string, target_id string, target_source int, score double")
    assert [r.target_id for r in production.resolve(scored, 0.5, 0.85, 0.0, 0.5).collect()] == ["a"]
    assert production.resolve(scored, 0.5, 0.5, 0.0, 0.5).count() == 3


def test_stream(spark, raw, rec, tmp_path):
    targets = rec.filter("source > 1")
    raw.filter("entity_id LIKE 'S1%'").repartition(3, "entity_id").write.parquet(f"file://{tmp_path}/in")
    stream = read_stream(spark, f"file://{tmp_path}/in", raw.schema)
    link_stream(stream, targets, f"file://{tmp_path}/out", f"file://{tmp_path}/state", BLOCKERS, 0.5).awaitTermination()
    found = spark.read.parquet(f"file://{tmp_path}/out")
    batch = link(rec.filter("source = 1"), targets, BLOCKERS, 0.5)
    assert sorted((r.s1_id, r.candidate_id) for r in found.collect()) == sorted((r.s1_id, r.candidate_id) for r in batch.collect())


def test_products_against_a_join(spark):
    """Bags, repeats, empty and absent tokens, repeated ids, over several chunks of either side."""
    import random

    from larkspur.operators.products import Bag, shared_counts

    rng = random.Random(5)
    side = lambda p, n: [(f"{p}-{k % (n - 3)}", 2, [rng.choice("abcdefgh") for _ in range(rng.randrange(5))] or None) for k in range(n)]
    one, two = side("S1", 40), side("S2", 60)
    want = {}
    for x, _, s in one:
        for y, _, t in two:
            want[x, y] = want.get((x, y), 0) + sum(a == b for a in s or () for b in t or ())
    schema = "entity_id string, source int, w array<string>"
    bag = Bag(F.col("w"), F.col("w"), 2)
    made = shared_counts(spark.createDataFrame(one, schema), spark.createDataFrame(two, schema), [bag], 7, 16)
    rows = made.collect()
    assert {(r.s1_id, r.candidate_id): r.shared_0 for r in rows} == {k: n for k, n in want.items() if n >= 2}
    assert len(rows) == len({(r.s1_id, r.candidate_id) for r in rows})


def test_candidates_are_not_moved(spark):
    """Pairs outnumber records by far: a plan that groups or joins them writes them all to disk."""
    rec = data.records(spark, SMALL)
    found = generate(rec.filter("source = 1"), rec.filter("source > 1"), ["exact_name", "token_name", "postal"])
    plan = found.table()._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "Join" not in above and "Aggregate" not in above


def test_a_key_of_many_records_is_dealt_over_tasks(spark):
    """One country holds nearly all records: its pairs come from several tasks, each pair of records once."""
    rows = [(f"S{1 + k % 3}-{k:04d}", 1 + k % 3, {7: "fr", 8: "", 9: None}.get(k, "en")) for k in range(300)] + [("S1-0000", 1, "en"), ("S2-0001", 2, "en")]
    rec = spark.createDataFrame(rows, "entity_id string, source int, country_norm string")
    ref, tgt = rec.filter("source = 1"), rec.filter("source > 1")
    made = blocking.dealt_key(ref, tgt, "country", F.col("country_norm"), 20, 30)
    want = blocking.equal_key(ref, tgt, "country", [F.col("country_norm")], [F.col("country_norm")])
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, want.collect())) == sorted(map(tuple, blocking.country(ref, tgt).collect()))
    tasks = made.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 10 and max(r["count"] for r in tasks) < made.count() / 4

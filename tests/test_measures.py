"""Features and scores that are made within a product, against the plain features of joined pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larkspur.functions.similarity import jaro_winkler
from larkspur.operators import bounds, measures, pairs, products, submission
from larkspur.operators import blocking as B
from larkspur.plans import data
from larkspur.plans.catalogue import ORACLES, QUERIES
from tests.conftest import SMALL, assert_same
from tests.test_bounds import BLOCKERS, odd_records


@pytest.mark.parametrize("name", ["pair_features", "rule_score"])
def test_pairs_are_not_moved(spark, name, monkeypatch):
    def never(*_, **__):
        raise AssertionError("pairs are joined to records")

    monkeypatch.setattr(pairs, "pair_features", never)
    assert QUERIES[name](spark, SMALL).count() > 0


@pytest.mark.parametrize("names", [pairs.FEATURES, ("block_count", "name_token_jaccard", "name_edit_sim", "addr_token_jaccard")])
def test_features_are_those_of_joined_pairs(spark, names):
    rec = odd_records(spark).cache()
    ref, tgt = rec.filter("source = 1"), rec.filter("source > 1")
    found = B.generate(ref, tgt, BLOCKERS).frame.select("s1_id", "candidate_id", "blockers")
    want = pairs.pair_features(found, rec).select("s1_id", "candidate_id", *names)
    assert pairs.FEATURES == tuple(pairs.pair_features(found, rec).columns[2:])
    got = B.featured(ref, tgt, BLOCKERS, pairs.PROVENANCE, names, names == pairs.FEATURES)
    assert got.count() > 500
    assert_same(got.toPandas(), want.toPandas())
    chunks = products.pair_features(ref, tgt, B._bags(BLOCKERS), tuple(BLOCKERS[:1]) + ("postal", "token_name"), pairs.PROVENANCE, names, names == pairs.FEATURES, None, 7, 9)
    assert_same(chunks.toPandas(), want.toPandas())


def test_rounding_is_that_of_spark(spark):
    draw = random.Random(1)
    values = [0.0, 1.0, 0.0000005, 0.1234565, 0.9999995, *[draw.randrange(100) / draw.randrange(1, 3200) for _ in range(500)]]
    values += [k / 128 for k in range(128)]
    want = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(F.round("v", 6)).collect()]
    assert measures.rounded(np.array(values), 6).tolist() == want


def test_jaro_winkler_of_lanes():
    draw = random.Random(5)
    texts = ["", "a", "日本語", "ab", *["".join(draw.choices(letters, k=n)) for letters in ("ab", "abcde é", "abcdefghijkl ") for n in (2, 3, 5, 17, 24, 40, 63, 64, 65, 90)]]
    one = bounds.Strings(pa.array(texts), 4)
    rows, at = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    got = bounds.jaro_winklers(one, rows, one, at, rows == at)
    assert got.tolist() == [jaro_winkler(texts[r], texts[t]) for r, t in zip(rows, at, strict=True)]


def test_letters_beyond_the_held_ones_are_common():
    one = bounds.Strings(pa.array(["a" * 130 + "zzz"]), 4)
    two = bounds.Strings(pa.array(["zzz"]), 4)
    assert one.common(np.array([0]), two, np.array([0])).tolist() == [3]


def test_gbt_scorer_counts_all_pairs(spark, monkeypatch):
    def never(*_, **__):
        raise AssertionError("pairs are joined to records")

    monkeypatch.setattr(pairs, "pair_features", never)
    made = QUERIES["gbt_scorer"](spark, SMALL)
    monkeypatch.undo()
    rows = pairs.label_pairs(made, data.truth(spark, SMALL)).toPandas()
    assert len(rows) == QUERIES["rule_score"](spark, SMALL).count()
    true, other = rows[rows.label == 1].score, rows[rows.label == 0].score
    assert len(true) and true.min() > 0.5 and (other < 0.5).mean() > 0.95


def test_counts_are_those_of_labelled_pairs(spark):
    rec = odd_records(spark).cache()
    ref, tgt = rec.filter("source = 1"), rec.filter("source > 1")
    highest = {"name_edit_sim": 1.0, "addr_token_jaccard": 1.0, "block_count": 3.0}
    every = ref.selectExpr("entity_id AS s1_id").distinct().join(tgt.selectExpr("entity_id AS candidate_id").distinct(), F.lit(True))
    truth = every.filter("hash(s1_id, candidate_id) % 7 = 0").groupBy("s1_id").agg(F.collect_set("candidate_id").alias("truth"))
    rows = pairs.label_pairs(B.featured(ref, tgt, BLOCKERS, pairs.PROVENANCE, tuple(highest)), truth).toPandas()
    codes = products.cells({n: rows[n].to_numpy() for n in highest}, highest)
    want = {}
    for code, label in zip(codes.tolist(), rows.label.tolist(), strict=True):
        want[code, label] = want.get((code, label), 0) + 1
    got = products.pair_cells(ref, tgt, B._bags(BLOCKERS), tuple(sorted(BLOCKERS)), highest, truth, 8, 11).collect()
    assert {(r.code, r.label): r.n for r in got} == want and any(y for _, y in want)


@pytest.mark.parametrize("name", ["threshold_grid", "candidate_pairs"])
def test_decisions_do_not_make_pairs(spark, duck, name, monkeypatch):
    def never(*_, **__):
        raise AssertionError("all candidate pairs are made and moved")

    monkeypatch.setattr(products, "shared_counts", never)
    monkeypatch.setattr(products, "pair_features", never)
    monkeypatch.setattr(products, "pair_scores", never)
    for module in (B,):
        for f in ("shared_counts", "pair_features", "pair_scores"):
            monkeypatch.setattr(module, f, never)
    assert_same(QUERIES[name](spark, SMALL).toPandas(), duck.sql(ORACLES[name]).df())


def test_grid_is_that_of_all_scores(spark):
    rec = odd_records(spark).cache()
    ref, tgt = rec.filter("source = 1"), rec.filter("source > 1")
    scored = B.strong(ref, tgt, BLOCKERS, pairs.rule_floor(0.0)).withColumn("score", F.round("score", 6)).cache()
    every = ref.selectExpr("entity_id AS s1_id").distinct()
    truth = scored.filter("hash(candidate_id) % 5 = 0").groupBy("s1_id").agg(F.collect_set("candidate_id").alias("truth"))
    truth = every.join(truth, "s1_id", "left").withColumn("truth", F.coalesce("truth", F.array().cast("array<string>")))
    want = pairs.threshold_grid(scored, truth)
    steps = pairs.threshold_steps()
    over = tuple(t for t in steps if t >= 0.5)
    tallies = products.pair_tallies(ref, tgt, B._bags(BLOCKERS), pairs.rule_floor(0.5), over, 6, 8, 11).withColumn("step", F.col("step") + len(steps) - len(over))
    rest = ref.join(tallies.selectExpr("s1_id AS entity_id").distinct(), "entity_id", "left_anti")
    best = products.pair_best(rest, tgt, B._bags(BLOCKERS), pairs.rule_floor(0.1), 6, 8, 11)
    best = best.groupBy("s1_id").agg(F.min(F.struct((-F.col("score")).alias("o"), "candidate_id", "score")).alias("b")).select("s1_id", "b.candidate_id", "b.score")
    assert best.count() > 0 and tallies.count() > 0
    hits = scored.join(truth.select("s1_id", F.explode("truth").alias("candidate_id")), ["s1_id", "candidate_id"])
    assert_same(pairs.threshold_sums(steps, tallies, best, hits, truth).toPandas(), want.toPandas())


@pytest.mark.parametrize("blocks", [(5, 3), (40, 65_536)])
def test_lists_hold_all_candidates(spark, blocks):
    rec = odd_records(spark).cache()
    ref, tgt = rec.filter("source = 1"), rec.filter("source > 1")
    want = submission.candidate_pairs(B.generate(ref, tgt, BLOCKERS).frame, ref.selectExpr("entity_id AS s1_id"))
    got = products.id_lists(ref, tgt, B._bags(BLOCKERS), *blocks)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    alone = products.id_lists(ref, tgt.filter("false"), B._bags(BLOCKERS), *blocks)
    assert {r.ids for r in alone.collect()} == {""} and alone.count() == got.count()


def test_hard_negatives_are_those_of_all_pairs(spark, monkeypatch):
    rec = odd_records(spark).dropDuplicates(["entity_id"]).cache()
    ref, tgt = rec.filter("source = 1"), rec.filter("source > 1")
    found = B.generate(ref, tgt, BLOCKERS).frame.select("s1_id", "candidate_id").cache()
    truth = found.filter("hash(s1_id, candidate_id) % 9 = 0").groupBy("s1_id").agg(F.collect_set("candidate_id").alias("truth"))
    truth = ref.selectExpr("entity_id AS s1_id").join(truth, "s1_id", "left").withColumn("truth", F.coalesce("truth", F.array().cast("array<string>"))).cache()
    names = ("name_edit_sim",)
    want = pairs.hard_negatives(pairs.pair_features(found, rec, names), truth)
    true = truth.select("s1_id", F.explode("truth").alias("candidate_id"))
    some = products.pair_negatives(ref, tgt, B._bags(BLOCKERS), tuple(sorted(BLOCKERS)), truth, 42, 8, 30).distinct()
    assert some.count() < found.count() and some.join(true, ["s1_id", "candidate_id"]).isEmpty()
    got = pairs.hard_negatives(pairs.pair_features(some.unionByName(true), rec, names), truth)
    assert_same(got.toPandas(), want.toPandas())


def test_hard_negatives_do_not_make_all_pairs(spark, duck, monkeypatch):
    def never(*_, **__):
        raise AssertionError("all candidate pairs are made and moved")

    for module in (products, B):
        for f in ("shared_counts", "pair_features"):
            monkeypatch.setattr(module, f, never)
    assert_same(QUERIES["hard_negatives"](spark, SMALL).toPandas(), duck.sql(ORACLES["hard_negatives"]).df())


def compared(monkeypatch, module) -> list:
    """The pairs whose edit distances are asked for from now on."""
    seen, plain = [], bounds.distances

    def counted(a, rows, b, at):
        seen.extend((a.text[r], b.text[t]) for r, t in zip(rows, at, strict=True))
        return plain(a, rows, b, at)

    monkeypatch.setattr(module, "distances", counted)
    return seen


def repeated(spark, columns) -> tuple[pa.Table, pa.Table]:
    rec = odd_records(spark)
    rec = rec.unionByName(rec).select(*[c.alias(n) for n, c in columns.items()], "source").sort("name", "address").cache()
    return rec.filter("source = 1").toArrow(), rec.filter("source > 1").toArrow()


@pytest.mark.parametrize("table", [bounds.TABLE if hasattr(bounds, "TABLE") else 0, 0])
def test_scores_compare_distinct_texts_once(spark, monkeypatch, table):
    monkeypatch.setattr(bounds, "TABLE", table, raising=False)
    seen = compared(monkeypatch, bounds)
    ref, tgt = repeated(spark, bounds.sketch())
    targets = bounds.Records(tgt)
    rows, at = (x.ravel() for x in np.meshgrid(np.arange(len(ref)), np.arange(len(tgt)), indexing="ij"))
    records = bounds.Records(ref, targets)
    left, scores = pairs.rule_floor(0.0).scores(records, rows, targets, at)
    assert len(left) == len(rows) and len(seen) == len(set(seen))
    one = [pairs.rule_floor(0.0).scores(records, rows[k : k + 1], targets, at[k : k + 1])[1][0] for k in range(0, len(rows), 17)]
    assert scores[::17].tolist() == one


def test_rounded_scores_are_those_of_spark(spark):
    rec = odd_records(spark).cache()
    ref, tgt = rec.filter("source = 1"), rec.filter("source > 1")
    plain = B.strong(ref, tgt, BLOCKERS, pairs.rule_floor(0.0)).select("s1_id", "candidate_id", F.round("score", 6).alias("score"))
    got = B.strong(ref, tgt, BLOCKERS, pairs.rule_floor(0.0), 6)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_features_compare_distinct_texts_once(spark, monkeypatch):
    seen = compared(monkeypatch, measures if hasattr(measures, "distances") else bounds)
    ref, tgt = repeated(spark, measures.columns())
    targets = measures.Wide(tgt)
    records = measures.Wide(ref, targets)
    rows, at = (x.ravel() for x in np.meshgrid(np.arange(len(ref)), np.arange(len(tgt)), indexing="ij"))
    flags = {"token_name": (rows + at) % 2 == 0}

    def made(k: slice, digits: int | None) -> dict:
        return measures.measures(records, rows[k], targets, at[k], {n: v[k] for n, v in flags.items()}, pairs.PROVENANCE, None, digits)

    every, near = made(slice(None), None), made(slice(None), 6)
    assert set(every) == set(pairs.FEATURES) and len(seen) == 2 * len(set(seen))
    for name, values in every.items():
        assert measures.rounded(values, 6).tolist() == near[name].tolist()
    for k in range(0, len(rows), 37):
        assert {n: v[k] for n, v in every.items()} == {n: v[0] for n, v in made(slice(k, k + 1), None).items()}


def test_cells_of_a_task_are_added_up(spark, monkeypatch):
    """Counts leave a task once for each code and label, whatever the number of batches of pairs."""
    rec = odd_records(spark).cache()
    ref, tgt = rec.filter("source = 1"), rec.filter("source > 1")
    truth = ref.select(F.col("entity_id").alias("s1_id"), F.array(F.lit("S2-001"), F.lit("S3-002")).alias("truth")).distinct()
    plain, asked = products._product, []
    monkeypatch.setattr(products, "_product", lambda *args: asked.append(args) or plain(*args))
    want = products.pair_cells(ref, tgt, B._bags(BLOCKERS), tuple(sorted(BLOCKERS)), {"name_edit_sim": 1.0, "block_count": 3.0}, truth)
    a, b, bags, more, run = asked[0][:5]
    refs = products._side(a, {"id": "entity_id"}, [x.ref for x in bags], more).toArrow().combine_chunks().to_batches()[0]
    targets = products._side(b, {"id": "entity_id", "source": "source"}, [x.tgt for x in bags], more).toArrow()
    monkeypatch.setattr(products, "OUT_ROWS", 5)
    left = [(r["code"], r["label"], r["n"]) for x in run(refs, products._Targets(targets, len(bags))) for r in x.to_pylist()]
    assert sorted(left) == sorted(map(tuple, want.collect())) and len({x[1] for x in left}) == 2


def test_counts_are_summed():
    parts = [(np.array([3, 5]), np.array([1, 2])), (np.array([1, 5]), np.array([4, 8]))]
    keys, n = products._summed(parts)
    assert keys.tolist() == [1, 3, 5] and n.tolist() == [4, 1, 10]
    assert products._among(np.array([0, 2, 9]), np.array([2, 4])).tolist() == [False, True, False]
    assert products._among(np.array([1]), np.array([], dtype=np.int64)).tolist() == [False]

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from larkspur import tracking
from larkspur.config import ConfigError, load_config
from larkspur.operators import engine, pairs
from larkspur.operators.features import FeatureConfig, FeaturePipeline, TfidfBuilder, bad_values
from larkspur.operators.tabular import LeakageGuardError
from larkspur.sources import records
from tests.test_linkage import RAW


@pytest.fixture(scope="module")
def sides(spark):
    rec = records.normalised(spark.createDataFrame(RAW, ", ".join(f"{c} string" for c in records.RAW)))
    truth = spark.createDataFrame([("S1-001", ["S2-101"]), ("S1-002", ["S2-102"]), ("S1-003", [])], "s1_id string, truth array<string>")
    return rec.filter("source = 1"), rec.filter("source > 1"), truth


def test_engine(sides, tmp_path):
    s1, targets, truth = sides
    result, report = engine.LinkageEngine().run_and_write(s1, targets, f"file://{tmp_path}/out", truth)
    assert result.evaluation.first().macro_f05 == 1.0 and result.blocking.first().recall == 1.0 and report["matched"] == 2
    coverage = engine.country_coverage(result.predicted, s1).collect()
    assert all(r.records == r.predicted for r in coverage)
    with pytest.raises(ValueError):
        engine.EngineConfig().changed(nope=1)


def test_custom_blocker_and_baseline(sides):
    s1, targets, _ = sides

    class Everything(engine.Blocker):
        name = "everything"

        def generate(self, reference, targets):
            a, b = reference.select(F.col("entity_id").alias("s1_id")), targets.select(F.col("entity_id").alias("candidate_id"), F.col("source").alias("candidate_source"))
            return a.join(b, F.lit(True)).select("s1_id", "candidate_id", "candidate_source", F.lit(self.name).alias("blocker"), F.lit(1.0).alias("block_score"))

    Everything().register()
    result = engine.LinkageEngine(engine.EngineConfig(blockers=("everything",))).run(s1, targets)
    assert result.scored.count() == 12
    made = pairs.pair_features(result.candidates.frame, s1.unionByName(targets))
    assert engine.exact_baseline(made).count() == 0


def test_entity_cross_validation(spark):
    rows = [(f"S1-{k}", f"S2-{j}", float(k == j), float(k == j), k * 0.01) for k in range(24) for j in range(k - 2, k + 3)]
    features = spark.createDataFrame(rows, "s1_id string, candidate_id string, name_edit_sim double, f double, g double")
    truth = spark.createDataFrame([(f"S1-{k}", [f"S2-{k}"]) for k in range(24)], "s1_id string, truth array<string>")
    scores = engine.entity_cross_validation(features, truth, ["f", "g"], 2)
    assert len(scores) == 2 and all(s == pytest.approx(1.0) for _, s in scores)


def test_feature_pipeline(spark):
    rows = spark.createDataFrame([(1, "red box", "a", 2.0, 1.0), (2, "blue box", "b", None, 0.0)], "id int, s string, c string, x double, y double")
    pipeline = FeaturePipeline(FeatureConfig(["s"], ["x"], [("x", "y")], [], ["c"], ["id"]))
    with pytest.raises(LeakageGuardError):
        pipeline.transform(rows)
    made = pipeline.fit_transform(rows)
    assert {"id", "num_log1p_x", "cat_c_freq", "txt_s__word_count"} <= set(made.columns) and len(made.columns) == 1 + 2 + 2 + 16
    assert {r.feature: r.nulls for r in bad_values(made, ["num_log1p_x", "cat_c_freq"]).collect()} == {"num_log1p_x": 1, "cat_c_freq": 0}
    vectors = TfidfBuilder(["s"], "id").fit(rows).transform(rows)
    norms = vectors.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(r.n == pytest.approx(1) for r in norms) and vectors.count() == 6


def test_ledgers(spark, tmp_path):
    ledger = tracking.Ledger(spark, f"file://{tmp_path}/log", tracking.EXPERIMENT_FIELDS)
    for k, score in (("E1", 0.42), ("E2", 0.39), ("E3", None)):
        ledger.log(experiment_id=k, cv_mean=score, notes='a "quoted", note', timestamp="2024-01-02T03:04:05")
    assert ledger.best("cv_mean", False)["experiment_id"] == "E2" and ledger.best("cv_mean", True)["experiment_id"] == "E1"
    assert [r.experiment_id for r in ledger.table("cv_mean", True).collect()] == ["E1", "E2", "E3"]
    assert ledger.read().first().notes == 'a "quoted", note'
    assert tracking.can_submit(ledger, "2024-01-02") and not tracking.can_submit(ledger, "2024-01-02", 3)
    with pytest.raises(ValueError):
        ledger.log(nope=1)
    assert "| experiment_id |" in tracking.markdown(ledger.read()) and len(tracking.LINKAGE_FIELDS) == 19 and len(tracking.SUBMISSION_FIELDS) == 14


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"task": {"metric": "smape"}, "split": {"folds": 3}}))
    config = load_config(str(path), {"task.direction": "minimize"})
    assert config.task.direction_safe == "minimize" and config.split.folds == 3
    with pytest.raises(ConfigError):
        load_config().task.direction_safe
    with pytest.raises(ConfigError):
        load_config(None, {"task.nope": 1})

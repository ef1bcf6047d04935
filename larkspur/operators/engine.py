"""The linkage engine end to end: block, featurise, score, decide, evaluate, write."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators import pairs, submission
from larkspur.operators.blocking import CandidateSet, generate
from larkspur.operators.models import entity_fold, pair_scorer

DEFAULT_BLOCKERS = ("exact_name", "exact_compact_name", "token_name", "rare_token", "postal", "name_country", "address_token")


@dataclass(frozen=True)
class EngineConfig:
    blockers: tuple[str, ...] = DEFAULT_BLOCKERS
    match_threshold: float = 0.5
    multi_match_threshold: float | None = None
    max_matches: int | None = None
    options: dict = field(default_factory=dict)

    def changed(self, **values) -> EngineConfig:
        unknown = set(values) - set(self.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return replace(self, **values)


@dataclass
class EngineResult:
    candidates: CandidateSet
    scored: DataFrame
    matches: DataFrame
    predicted: DataFrame
    blocking: DataFrame | None = None
    evaluation: DataFrame | None = None


class LinkageEngine:
    """One lazy plan from records to matches; metrics are further actions on it."""

    def __init__(self, config: EngineConfig = EngineConfig(), scorer=None, features: list[str] | None = None):
        self.config, self.scorer, self.features = config, scorer, features

    def run(self, s1: DataFrame, targets: DataFrame, truth: DataFrame | None = None) -> EngineResult:
        """s1 and targets are normalised records, truth (s1_id, truth array)."""
        c = self.config
        found = generate(s1, targets, list(c.blockers))
        made = pairs.pair_features(found.frame.select("s1_id", "candidate_id", "blockers"), s1.unionByName(targets))
        scored = pairs.rule_score(made) if self.scorer is None else self.scorer.predict(made, "score")
        scored = scored.select("s1_id", "candidate_id", "score")
        kept = pairs.resolve(scored, c.match_threshold, c.multi_match_threshold, c.max_matches)
        ids = s1.select(F.col("entity_id").alias("s1_id"))
        result = EngineResult(found, scored, kept, pairs.matches_of(kept, ids))
        if truth is not None:
            result.blocking = pairs.blocking_metrics(truth, found.frame, targets.count())
            result.evaluation = pairs.entity_f05(truth, result.predicted)
        return result

    def run_and_write(self, s1: DataFrame, targets: DataFrame, folder: str, truth: DataFrame | None = None) -> tuple[EngineResult, dict]:
        result = self.run(s1, targets, truth)
        ids = s1.select(F.col("entity_id").alias("s1_id"))
        report = submission.write_package(s1.sparkSession, result.matches, result.candidates.frame, ids, targets, folder)
        return result, report


def exact_baseline(features: DataFrame) -> DataFrame:
    """Pairs with equal names and countries."""
    return features.filter((F.col("name_exact") == 1) & (F.col("country_exact") == 1)).select("s1_id", "candidate_id")


def country_coverage(predicted: DataFrame, s1: DataFrame) -> DataFrame:
    """(country_norm, records, predicted): whether every country's records have a row."""
    rows = s1.select(F.col("entity_id").alias("s1_id"), "country_norm").join(predicted.select("s1_id", F.lit(1).alias("one")).distinct(), "s1_id", "left")
    return rows.groupBy("country_norm").agg(F.count("*").alias("records"), F.count("one").alias("predicted"))


def entity_cross_validation(features: DataFrame, truth: DataFrame, names: list[str], folds: int = 5, seed: int = 42) -> list[tuple[float, float]]:
    """(best threshold, best macro F0.5) of each fold: whole entities are held out, negatives are mined per fold."""
    known = truth.join(features.select("s1_id").distinct(), "s1_id", "left_semi")
    folds = min(folds, max(2, known.count()))
    placed, sides = features.withColumn("fold", entity_fold("s1_id", folds, seed)), known.withColumn("fold", entity_fold("s1_id", folds, seed))
    out = []
    for fold in range(folds):
        inside, outside = F.col("fold") == fold, F.col("fold") != fold
        train = pairs.hard_negatives(placed.filter(outside), sides.filter(outside).drop("fold"), seed + fold)
        if train.agg(F.count_distinct("label")).first()[0] < 2:
            continue
        model = pair_scorer(train, names, seed=seed)
        scored = model.predict(placed.filter(inside), "score").select("s1_id", "candidate_id", "score")
        out.append(pairs.optimize_threshold(scored, sides.filter(inside).drop("fold")))
    return out


class Blocker:
    """Extension point: generate(reference, targets) returns blocker hits; register() makes it known by name."""

    name = "custom"

    def generate(self, reference: DataFrame, targets: DataFrame) -> DataFrame:
        raise NotImplementedError

    def register(self) -> None:
        from larkspur.operators.blocking import BLOCKERS

        BLOCKERS[self.name] = self.generate


def blend_scores(first: Column, second: Column) -> Column:
    """The production ensemble of two scorers: half and half."""
    return (first + second) / 2

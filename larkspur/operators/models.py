"""Models, cross validation and prediction over fold columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from statistics import fmean, median, pstdev

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from larkspur.operators.metrics import get_metric


class ConstantModel:
    """Predicts the mean, median or mode (smallest of the commonest) of the training target."""

    def __init__(self, strategy: str = "mean"):
        if strategy not in ("mean", "median", "mode"):
            raise ValueError(f"unknown strategy {strategy!r}")
        self.strategy, self.value = strategy, None

    def fit(self, train: DataFrame, target: str, features: list[str] | None = None) -> ConstantModel:
        self.value = train.agg(self.statistic(target)).first()[0]
        return self

    def statistic(self, target: str) -> Column:
        return {"mean": F.avg(target), "median": F.percentile(target, F.lit(0.5)), "mode": F.mode(target, True)}[self.strategy]

    def predict(self, rows: DataFrame, name: str = "prediction") -> DataFrame:
        return rows.withColumn(name, F.lit(self.value).cast("double"))


class SparkModel:
    """A Spark ML estimator over numeric feature columns."""

    def __init__(self, estimator, probability: bool = False):
        self.estimator, self.probability, self.fitted, self.features = estimator, probability, None, None

    def fit(self, train: DataFrame, target: str, features: list[str]) -> SparkModel:
        self.features = features
        assembler = VectorAssembler(inputCols=features, outputCol="__x", handleInvalid="keep")
        ready = assembler.transform(train.withColumn("__y", F.col(target).cast("double")))
        estimator = self.estimator.copy({self.estimator.featuresCol: "__x", self.estimator.labelCol: "__y"})
        self.fitted = PipelineModel([assembler, estimator.fit(ready)])
        return self

    def predict(self, rows: DataFrame, name: str = "prediction") -> DataFrame:
        out = self.fitted.transform(rows)
        value = vector_to_array("probability")[1] if self.probability else F.col("prediction")
        return out.select(*[F.col(c) for c in rows.columns if c != name], value.alias(name))

    def importance(self) -> list[tuple[str, float]]:
        last = self.fitted.stages[-1]
        if not hasattr(last, "featureImportances"):
            raise ValueError("this model has no importances")
        pairs = zip(self.features, last.featureImportances.toArray().tolist(), strict=True)
        return sorted(pairs, key=lambda x: (-x[1], x[0]))

    def save(self, path: str) -> None:
        self.fitted.write().overwrite().save(path)

    def load(self, path: str) -> SparkModel:
        self.fitted = PipelineModel.load(path)
        return self


def build_model(name: str, task: str = "regression", seed: int = 42):
    """gbt, linear, or dummy_mean / dummy_median / dummy_mode.  Gradient boosting is Spark's own."""
    if name.startswith("dummy"):
        return ConstantModel(name.partition("_")[2] or "mean")
    made = {
        ("gbt", "regression"): lambda: SparkModel(GBTRegressor(maxIter=20, maxDepth=4, seed=seed)),
        ("gbt", "classification"): lambda: SparkModel(GBTClassifier(maxIter=20, maxDepth=4, seed=seed), True),
        ("linear", "regression"): lambda: SparkModel(LinearRegression(elasticNetParam=0.0)),
        ("linear", "classification"): lambda: SparkModel(LogisticRegression(), True),
    }
    if (name, task) not in made:
        raise ValueError(f"unknown model {name!r} for {task}")
    return made[name, task]()


def pair_scorer(train: DataFrame, features: list[str], label: str = "label", seed: int = 42, count: str | None = None):
    """A boosted classifier of pairs; positives weigh up to eight times as much, as rare as they are.  count: how many pairs a row is."""
    times = F.lit(1) if count is None else F.col(count)
    row = train.agg(*[F.coalesce(F.sum(F.when(F.col(label) == y, times)), F.lit(0)).alias(n) for n, y in (("p", 1), ("n", 0))]).first()
    weight = min(8.0, row.n / max(row.p, 1))
    weighted = train.withColumn("__w", F.when(F.col(label) == 1, weight).otherwise(1.0) * times)
    return SparkModel(GBTClassifier(maxIter=20, maxDepth=5, seed=seed, weightCol="__w"), True).fit(weighted, label, features)


def counted_scorer(counts: DataFrame, features: list[str], bits: int, label: str = "label", seed: int = 42):
    """``pair_scorer`` of all pairs, given as counts of equal ones: (code, label, n), a code holding each feature's cell in so many bits.

    A tree looks at no more than maxBins values of a feature: cells are joined into as many bins of like weight, and trees are
    fitted on the bins, each with its weight of pairs.  Returns the bins of cells, the sorted codes of bins, and their scores.
    """
    most, size = GBTClassifier().getMaxBins(), 1 << bits
    counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
    cell = [F.shiftright("code", bits * k).bitwiseAND(size - 1).cast("int") for k in range(len(features))]
    sums = counts.select(F.posexplode(F.array(*cell)).alias("k", "cell"), "n").groupBy("k", "cell").agg(F.sum("n").alias("n")).collect()
    bins = np.zeros((len(features), size), dtype=np.int64)
    for k in range(len(features)):
        n = np.zeros(size, dtype=np.int64)
        for r in sums:
            n[r.cell if r.k == k else 0] += r.n if r.k == k else 0
        filled = n > 0
        if filled.sum() <= most:
            own = np.cumsum(filled) - 1
        else:
            middle = (np.cumsum(n) - n / 2) / max(1, n.sum())
            own = np.floor(middle * most)
        bins[k] = np.clip(own, 0, most - 1)
    binned = [F.element_at(F.array(*[F.lit(int(b)) for b in bins[k]]), cell[k] + 1).cast("double").alias(f) for k, f in enumerate(features)]
    rows = counts.select(*binned, label, "n").groupBy(*features, label).agg(F.sum("n").alias("n"))
    rows = rows.sortWithinPartitions(*features, label).persist(StorageLevel.MEMORY_AND_DISK)  # splits are placed by a sample, which goes by the rows' order
    model = pair_scorer(rows, features, label, seed, "n")
    key = F.lit(0).cast("long")
    for k, f in enumerate(features):
        key = key + F.shiftleft(F.col(f).cast("long"), bits * k)
    out = model.predict(rows.select(*features).distinct(), "score").select(key.alias("code"), "score").orderBy("code").toArrow()
    rows.unpersist()
    counts.unpersist()
    return bins, out["code"].to_numpy(), out["score"].to_numpy()


@dataclass
class CvResult:
    oof: DataFrame
    fold_scores: list[float]
    suggested_trees: int | None = None
    models: list = field(default_factory=list)

    @property
    def cv_mean(self) -> float:
        return fmean(self.fold_scores)

    @property
    def cv_std(self) -> float:
        return pstdev(self.fold_scores)


def cross_validate(
    rows: DataFrame, target: str, features: list[str], make_model: Callable[[], object], metric: str, row_id: str,
    feature_builder: Callable[[DataFrame, DataFrame], DataFrame] | None = None, expanding: bool = False,
) -> CvResult:
    """Fit on the other folds (earlier ones if expanding), predict each; every row is predicted exactly once.

    feature_builder(rows, train) may add columns from the training part only.
    """
    folds = sorted(r.fold for r in rows.select("fold").distinct().collect())
    spec, parts, scores, models = get_metric(metric), None, [], []
    for fold in folds[1:] if expanding else folds:
        train = rows.filter(F.col("fold") < fold if expanding else F.col("fold") != fold)
        valid = rows.filter(F.col("fold") == fold)
        if feature_builder:
            train, valid = feature_builder(train, train), feature_builder(valid, train)
        model = make_model().fit(train, target, features)
        out = model.predict(valid, "oof").select(row_id, "fold", target, "oof")
        scores.append(float(spec.run(out, target, "oof").first()[0]))
        models.append(model)
        parts = out if parts is None else parts.unionByName(out)
    if not expanding:
        counts = parts.agg(F.count("*").alias("n"), F.count_distinct(row_id).alias("d")).first()
        if counts.n != rows.count() or counts.d != counts.n:
            raise ValueError("not every row was predicted exactly once")
    return CvResult(parts, scores, models=models)


def suggested_trees(best_iterations: list[int]) -> int:
    return round(median(best_iterations) * 1.05)


def entity_fold(s1_id: str, folds: int, seed: int = 42) -> Column:
    """Folds of whole entities, by hash."""
    return F.pmod(F.xxhash64(F.lit(seed), s1_id), F.lit(folds)).cast("int")


def ensemble_predictions(models: list, rows: DataFrame, how: str = "mean", post: Callable[[Column], Column] | None = None) -> DataFrame:
    """Mean or median over fold models, post-processed one by one before."""
    if not models:
        raise ValueError("no models")
    names = [f"__p{k}" for k in range(len(models))]
    for name, model in zip(names, models, strict=True):
        rows = model.predict(rows, name)
        if post:
            rows = rows.withColumn(name, post(F.col(name)))
    values = F.array_sort(F.array(*names))
    n = len(names)
    value = (values[(n - 1) // 2] + values[n // 2]) / 2 if how == "median" else F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / n
    return rows.withColumn("prediction", value).drop(*names)

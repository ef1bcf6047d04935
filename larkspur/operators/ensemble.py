"""Blending of predictions that stand side by side as columns."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larkspur.operators.metrics import REGISTRY, ROWWISE


def oof_correlation(rows: DataFrame, models: list[str]) -> DataFrame:
    """(a, b, correlation) for every pair of prediction columns, in one pass."""
    pairs = list(itertools.combinations(models, 2))
    one = rows.agg(*[F.corr(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)])
    table = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{k}").alias("correlation")) for k, (a, b) in enumerate(pairs)]
    return one.select(F.explode(F.array(*table)).alias("r")).select("r.*")


def weighted_average(models: list[str], weights: list[float]) -> Column:
    total = sum(weights)
    if len(weights) != len(models) or not total:
        raise ValueError("one weight for each model, not all zero")
    out = F.lit(0.0)
    for name, weight in zip(models, weights, strict=True):
        out = out + F.col(name) * (weight / total)
    return out


def simple_average(models: list[str]) -> Column:
    return weighted_average(models, [1.0] * len(models))


def median_of(models: list[str]) -> Column:
    """Row-wise median of prediction columns."""
    s, n = F.array_sort(F.array(*models)), len(models)
    return (s[(n - 1) // 2] + s[n // 2]) / 2


def rank_average(rows: DataFrame, models: list[str], row_id: str, rescale: bool = False) -> DataFrame:
    """Mean over models of the average-tie rank divided by the row count.

    Ranks come from range-partitioned sorts of the distinct values, so no task sorts all rows.
    """
    total = rows.count()
    ends = rows.agg(*[F.min(m).alias(f"__lo_{m}") for m in models], *[F.max(m).alias(f"__hi_{m}") for m in models])
    out = rows
    for m in models:
        counts = rows.groupBy(F.col(m).alias("__v")).agg(F.count("*").alias("__n"))
        below = _running_total(counts)
        rank = below.select("__v", ((F.col("__below") + (F.col("__n") + 1) / 2) / total).alias(f"__r_{m}"))
        out = out.join(rank, F.col(m) == F.col("__v")).drop("__v")
    mean = sum((F.col(f"__r_{m}") for m in models[1:]), F.col(f"__r_{models[0]}")) / len(models)
    out = out.withColumn("rank_avg", mean)
    if rescale:
        low = sum((F.col(f"__lo_{m}") for m in models[1:]), F.col(f"__lo_{models[0]}")) / len(models)
        high = sum((F.col(f"__hi_{m}") for m in models[1:]), F.col(f"__hi_{models[0]}")) / len(models)
        out = out.join(F.broadcast(ends), F.lit(True)).withColumn("rank_avg", low + F.col("rank_avg") * (high - low))
    return out.select(row_id, "rank_avg")


def _running_total(counts: DataFrame) -> DataFrame:
    """(__v, __n) plus __below, the total of smaller values, summed by ranges of values."""
    spread = counts.repartitionByRange("__v").withColumn("__part", F.spark_partition_id())
    sums = spread.groupBy("__part").agg(F.sum("__n").alias("__t"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = F.broadcast(sums.select("__part", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__start")))
    run = W.partitionBy("__part").orderBy("__v").rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("__n").over(run), F.lit(0))
    return spread.withColumn("__inside", inside).join(starts, "__part").select("__v", "__n", (F.col("__start") + F.col("__inside")).alias("__below"))


def select_models(rows: DataFrame, target: str, models: list[str], metric: str, max_correlation: float = 0.98) -> list[str]:
    """Best first; a model joins if it is not too like a chosen one and the equal blend improves."""
    spec = REGISTRY[metric]

    def value(column: Column) -> float:
        return float(spec.run(rows.select(F.col(target).alias("t"), column.alias("p")), "t", "p").first()[0])

    scores = {m: value(F.col(m)) for m in models}
    like = {frozenset((r.a, r.b)): abs(r.correlation or 0) for r in oof_correlation(rows, models).collect()} if len(models) > 1 else {}
    ordered = sorted(models, key=lambda m: (-scores[m] if spec.greater_is_better else scores[m], m))
    chosen, best = [ordered[0]], scores[ordered[0]]
    for m in ordered[1:]:
        if max(like[frozenset((m, c))] for c in chosen) > max_correlation:
            continue
        blended = value(simple_average([*chosen, m]))
        if spec.is_better(blended, best):
            chosen, best = [*chosen, m], blended
    return chosen


def optimise_weights(rows: DataFrame, target: str, models: list[str], metric: str, tries: int = 200, seed: int = 42) -> tuple[list[float], float]:
    """The best of many weightings drawn from the simplex, all scored in one pass where the metric is row-wise."""
    rng = np.random.default_rng(seed)
    draws = [[1 / len(models)] * len(models), *np.eye(len(models)).tolist(), *rng.dirichlet(np.ones(len(models)), tries).tolist()]
    spec = REGISTRY[metric]
    t = F.col(target).cast("double")
    if metric in ROWWISE:
        row = rows.agg(*[ROWWISE[metric](t, weighted_average(models, w)).alias(f"w{k}") for k, w in enumerate(draws)]).first()
        values = list(row)
    else:
        values = [spec.run(rows.withColumn("__b", weighted_average(models, w)), target, "__b").first()[0] for w in draws]
    best = (max if spec.greater_is_better else min)(range(len(draws)), key=lambda k: values[k])
    return draws[best], float(values[best])


def stack(rows: DataFrame, target: str, models: list[str]):
    """A linear meta model on the prediction columns."""
    made = VectorAssembler(inputCols=models, outputCol="__x").transform(rows)
    return LinearRegression(featuresCol="__x", labelCol=target, predictionCol="stacked").fit(made)


def predict_stack(model, rows: DataFrame, models: list[str]) -> DataFrame:
    return model.transform(VectorAssembler(inputCols=models, outputCol="__x").transform(rows)).drop("__x")

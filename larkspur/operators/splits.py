"""Validation splits as a fold column.  Draws are by hash of row id and seed: the same on any cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.tabular import draw, ranked_rows

KINDS = ("kfold", "stratified", "group", "stratified_group", "timeseries", "holdout")


def kfold(rows: DataFrame, row_id: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Folds of sizes that differ by one at most: the place in hash order modulo folds."""
    placed = ranked_rows(rows.withColumn("__h", draw(seed, row_id)), F.col("__h"), F.col(row_id))
    return placed.withColumn("fold", (F.col("place") % folds).cast("int")).drop("__h", "place")


def stratum(rows: DataFrame, target: str, bins: int = 10) -> DataFrame:
    """rows plus stratum: equal-width bins of a float target, the value of any other; nulls are their own."""
    if rows.schema[target].dataType.typeName() not in ("double", "float"):
        return rows.withColumn("stratum", F.coalesce(F.col(target).cast("string"), F.lit("nan")))
    ends = rows.agg(F.min(target).alias("__lo"), F.max(target).alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    place = F.when(width > 0, F.ceil((F.col(target) - F.col("__lo")) / F.when(width > 0, width)) - 1).otherwise(0)
    bin_no = F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1)).cast("int").cast("string")
    return rows.join(F.broadcast(ends), F.lit(True)).withColumn("stratum", F.coalesce(bin_no, F.lit("nan"))).drop("__lo", "__hi")


def stratified(rows: DataFrame, row_id: str, target: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Each stratum is dealt evenly: sort by stratum and hash, then deal places in turn."""
    named = stratum(rows, target).withColumn("__h", draw(seed, row_id))
    placed = ranked_rows(named, F.col("stratum"), F.col("__h"), F.col(row_id))
    return placed.withColumn("fold", (F.col("place") % folds).cast("int")).drop("__h", "place", "stratum")


def group(rows: DataFrame, group_col: str | None, folds: int = 5, seed: int = 42) -> DataFrame:
    """Whole groups, largest first, dealt back and forth over the folds so that sizes even out."""
    if not group_col:
        raise ValueError("a group split needs a group column")
    sizes = rows.groupBy(group_col).agg(F.count("*").alias("__n"))
    placed = ranked_rows(sizes, F.desc("__n"), draw(seed, group_col), F.col(group_col))
    turn = F.col("place") % (2 * folds)
    table = placed.select(F.col(group_col).alias("__g"), F.least(turn, 2 * folds - 1 - turn).cast("int").alias("fold"))
    return rows.join(table, F.col(group_col).eqNullSafe(F.col("__g"))).drop("__g")


def stratified_group(rows: DataFrame, group_col: str, target: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Whole groups, dealt by their commonest stratum."""
    named = stratum(rows, target)
    per = named.groupBy(group_col).agg(F.mode("stratum", True).alias("__s"), F.count("*").alias("__n"))
    placed = ranked_rows(per, F.col("__s"), F.desc("__n"), draw(seed, group_col), F.col(group_col))
    table = placed.select(F.col(group_col).alias("__g"), (F.col("place") % folds).cast("int").alias("fold"))
    return rows.join(table, F.col(group_col).eqNullSafe(F.col("__g"))).drop("__g")


def timeseries(rows: DataFrame, time_col: str, row_id: str, folds: int = 5) -> DataFrame:
    """Expanding windows: fold 0 only trains; fold k is validated after training on all earlier rows."""
    placed = ranked_rows(rows, F.col(time_col), F.col(row_id))
    total = placed.agg(F.count("*").alias("__n"))
    size = F.floor(F.col("__n") / (folds + 1))
    first = F.col("__n") - size * folds
    fold = F.when(F.col("place") < first, 0).otherwise(1 + F.floor((F.col("place") - first) / F.greatest(size, F.lit(1))))
    return placed.join(F.broadcast(total), F.lit(True)).withColumn("fold", fold.cast("int")).drop("__n", "place")


def holdout(rows: DataFrame, row_id: str, fraction: float = 0.2, seed: int = 42, group_col: str | None = None) -> DataFrame:
    """fold 1 holds max(1, int(n * fraction)) rows, or groups if a group column is given."""
    key = group_col or row_id
    units = rows.select(key).distinct() if group_col else rows.select(key)
    placed = ranked_rows(units.withColumn("__h", draw(seed, key)), F.col("__h"), F.col(key))
    total = placed.agg(F.greatest(F.lit(1), F.floor(F.count("*") * fraction)).alias("__k"))
    table = placed.join(F.broadcast(total), F.lit(True)).select(F.col(key).alias("__u"), (F.col("place") < F.col("__k")).cast("int").alias("fold"))
    return rows.join(table, F.col(key).eqNullSafe(F.col("__u"))).drop("__u")


def make_splits(rows: DataFrame, kind: str, row_id: str, folds: int = 5, seed: int = 42, target: str | None = None, group_col: str | None = None, time_col: str | None = None, fraction: float = 0.2) -> DataFrame:
    """rows plus fold, by any of KINDS; what a kind needs must be given."""
    needs = {"stratified": (target,), "group": (group_col,), "stratified_group": (group_col, target), "timeseries": (time_col,)}
    if kind not in KINDS:
        raise ValueError(f"unknown split {kind!r}; known: {', '.join(KINDS)}")
    if not all(needs.get(kind, (True,))):
        raise ValueError(f"a {kind} split needs more columns")
    if kind == "kfold":
        return kfold(rows, row_id, folds, seed)
    if kind == "stratified":
        return stratified(rows, row_id, target, folds, seed)
    if kind == "group":
        return group(rows, group_col, folds, seed)
    if kind == "stratified_group":
        return stratified_group(rows, group_col, target, folds, seed)
    if kind == "timeseries":
        return timeseries(rows, time_col, row_id, folds)
    return holdout(rows, row_id, fraction, seed, group_col)


def save_splits(rows: DataFrame, row_id: str, path: str) -> None:
    rows.select(row_id, "fold").write.mode("overwrite").parquet(path)


def load_splits(rows: DataFrame, row_id: str, path: str) -> DataFrame:
    return rows.join(rows.sparkSession.read.parquet(path), row_id)


def fold_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("fold").agg(F.count("*").alias("n"))

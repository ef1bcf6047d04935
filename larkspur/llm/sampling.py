"""Bounded, deterministic samples for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_of(rows: DataFrame, size: int, seed: int = 17) -> DataFrame:
    """About size rows (all if there are no more): those whose id hashes into the lowest share of the range.

    The share is size over the count of rows, so no row is ranked and nothing but the sample moves.
    Of rows that share an id the one of least hash is taken: repeated ids make the sample smaller,
    never larger.
    """
    rest = [c for c in rows.columns if c != "id"]
    total = rows.count()
    if total > size:
        limit = -(1 << 63) + int(size / total * (1 << 64))
        rows = rows.filter(F.xxhash64(F.lit(seed), F.col("id").cast("string")) < F.lit(limit))
    if not rest:
        return rows.distinct()
    return rows.groupBy("id").agg(F.min_by(F.struct(*rest), F.xxhash64(*rest)).alias("r")).select("id", "r.*")

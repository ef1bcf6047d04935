"""Connected components over an edge table, by alternating star contraction.

Every round is two aggregations with map-side combine and two joins that adaptive
execution may split, so a node with a third of all edges is no bottleneck.  Rounds
are cut by Parquet tables in the shared folder; only counters reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.storage import materialize, remove, scratch


def _star(directed: DataFrame, large: bool) -> DataFrame:
    """One star step: link each node's (larger, or smaller and equal) neighbours to its least one.

    directed: (u, v).  Large star looks at all neighbours, small star at the smaller ones.
    """
    if not large:
        directed = directed.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = directed.join(low, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node reachable.

    Self loops, repeated edges and either direction are fine; an empty table gives an empty one.
    Null ends are dropped.  Raises if max_rounds is not enough (it grows with the logarithm
    squared of the longest path).
    """
    spark = edges.sparkSession
    path = scratch(spark, "cc")
    now = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), path
    )
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, True)
        new_path = scratch(spark, "cc")
        new = materialize(_star(large, False), new_path)
        stable = _signature(now) == _signature(new)
        remove(spark, path)
        now, path = new, new_path
        if stable:
            roots = now.select(F.col("v").alias("u"), "v").distinct()
            return now.union(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
    raise RuntimeError("components did not settle")


def _signature(edges: DataFrame) -> tuple:
    """Count and order-free digest of an edge table."""
    digest = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.sum(digest.cast("decimal(38,0)")), F.bit_xor(digest)).first()
    return tuple(row)

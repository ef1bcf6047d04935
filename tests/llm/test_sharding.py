from __future__ import annotations

import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from larkspur.llm import sharding as S
from larkspur.llm.storage import scratch
from tests.conftest import SMALL


def test_flow_is_cheapest():
    """Against all ways to send small amounts."""
    random.seed(2)
    for _ in range(20):
        old = {k: random.randrange(5) for k in range(3)}
        new = S.capacities(sum(old.values()), 3)
        found = S.flows(old, new)
        assert all(sum(n for (i, _), n in found.items() if i == k) == old[k] for k in old)
        assert all(sum(n for (_, j), n in found.items() if j == k) == new[k] for k in range(3))
        moved = sum(n for (i, j), n in found.items() if i != j)
        assert moved == sum(max(0, old[k] - new[k]) for k in range(3))


def test_flow_with_costs():
    random.seed(3)
    for _ in range(30):
        supply, demand = [random.randrange(1, 4) for _ in range(2)], []
        total = sum(supply)
        demand = [total // 2, total - total // 2]
        cost = [[random.randrange(6) for _ in range(2)] for _ in range(2)]
        net = S.Flow(6)
        for i in range(2):
            net.add(0, 2 + i, supply[i], 0)
            net.add(4 + i, 1, demand[i], 0)
            for j in range(2):
                net.add(2 + i, 4 + j, supply[i], cost[i][j])
        best = min(
            a * cost[0][0] + (supply[0] - a) * cost[0][1] + b * cost[1][0] + (supply[1] - b) * cost[1][1]
            for a, b in itertools.product(range(supply[0] + 1), range(supply[1] + 1))
            if a + b == demand[0]
        )
        assert net.run(0, 1) == best


@pytest.mark.parametrize("old,new", [(4, 4), (4, 6), (6, 4), (1, 3)])
def test_plan(old, new):
    random.seed(old * 10 + new)
    blocks = [(random.randrange(old), random.randrange(4), k, random.randrange(1, 400)) for k in range(400)]
    target = S.plan(blocks, new)
    load = [0] * new
    for shard, _, block, size in blocks:
        load[target[shard, block]] += size
    assert len(target) == 400 and max(load) - min(load) <= 20
    assert S.plan([], new) == {}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = S.with_slots(S.reshard(odd_docs, scratch(spark, "shards-test")).withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))).collect()
    plain = lambda k: -1 if k is None else k
    want = sorted((plain(r.doc_id), len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in odd_docs.collect())
    assert sorted((plain(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert S.reshard(no_docs, scratch(spark, "shards-none")).count() == 0


def test_sizes_are_near_equal(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.expr("repeat('é', int(1 + pmod(hash(id), 300)))").alias("text"))
    rows = S.reshard(docs, scratch(spark, "shards-even"))
    assert rows.count() == 6000
    sizes = [r.b for r in rows.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 40 and max(sizes) - min(sizes) < 0.02 * sum(sizes) / 40
    kept = rows.join(docs.withColumnRenamed("text", "t"), "doc_id").filter("text = t").count()
    assert kept == 6000


def test_query_reshards(spark, monkeypatch):
    """The flow of the query has a fifth of all bytes to move, and little more is moved."""
    seen, plan = [], S.plan
    monkeypatch.setattr(S, "plan", lambda blocks, shards: seen.append((blocks, plan(blocks, shards))) or seen[-1][1])
    rows = S.query(spark, SMALL).collect()
    (blocks, target), total, held = seen[0], 0, {}
    for shard, _, _, size in blocks:
        held[shard], total = held.get(shard, 0) + size, total + size
    moved = sum(size for shard, _, block, size in blocks if target[shard, block] != shard)
    least = sum(n for (i, j), n in S.flows(held, S.capacities(total, 40)).items() if i != j)
    assert sum(r["size"] for r in rows) == total and {r.shard for r in rows} == set(range(40))
    assert 0.15 * total < least and moved < 1.5 * least

"""Resharding by minimum-cost flow: move the fewest bytes from old shards to new capacities.

Law ``bytes``: shard sizes come out near equal.  Rows hash to blocks: those larger than
1/``FINE`` of a new shard are blocks of their own (there are at most new * FINE of them), the
others share ``BLOCKS`` hash blocks for each old shard.  Only block sizes reach the driver, at most
old * BLOCKS + new * FINE rows whatever the corpus.  A minimum-cost flow from old sizes to new
capacities (a byte costs nothing where it is and one unit elsewhere) says how much goes where;
whole blocks realise the flows, blocks of the same file first so that few files are touched, and
a last repair trades single blocks between the fullest and the emptiest shard.

``reshard`` then rewrites the files (``FILES`` for each shard) that lose or gain a block and leaves
the others as they are.  Slots number the rows of a shard without gaps: the running total of its
blocks' rows plus the place within the block, so no task ever holds a whole shard.

A row's size is its text's UTF-8 bytes plus 16 (null: 16).  Rows with a null id or repeated ids are
hashed by their text too.  An empty table gives empty shards.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larkspur.llm.storage import materialize, scratch

OLD_SHARDS, NEW_SHARDS = 32, 40
BLOCKS, FINE, FILES = 128, 200, 4
#: A file of a shard is written in parts of about so many bytes, so that tasks stay small at any size.
PART_BYTES = 64 << 20
ROW_BYTES = 16


@dataclass
class Flow:
    """Successive shortest paths with potentials on a small dense network."""

    nodes: int
    graph: list[list[list]] = field(init=False)

    def __post_init__(self) -> None:
        self.graph = [[] for _ in range(self.nodes)]

    def add(self, a: int, b: int, capacity: int, cost: int) -> list:
        there, back = [b, capacity, cost, None], [a, 0, -cost, None]
        there[3], back[3] = back, there
        self.graph[a].append(there)
        self.graph[b].append(back)
        return back  # its capacity is the flow

    def run(self, source: int, sink: int) -> int:
        """Send all that fits at least cost; returns the cost.  Costs start out non-negative."""
        potential, total = [0] * self.nodes, 0
        while True:
            far = [float("inf")] * self.nodes
            via: list[tuple[int, list] | None] = [None] * self.nodes
            far[source], queue = 0, [(0, source)]
            while queue:
                d, a = heapq.heappop(queue)
                if d > far[a]:
                    continue
                for edge in self.graph[a]:
                    b, capacity, cost, _ = edge
                    new = d + cost + potential[a] - potential[b]
                    if capacity and new < far[b]:
                        far[b], via[b] = new, (a, edge)
                        heapq.heappush(queue, (new, b))
            if via[sink] is None:
                return total
            potential = [p + d if d < float("inf") else p for p, d in zip(potential, far, strict=True)]
            path, at = [], sink
            while at != source:
                at, edge = via[at]
                path.append(edge)
            amount = min(e[1] for e in path)
            for e in path:
                e[1] -= amount
                e[3][1] += amount
                total += amount * e[2]


def capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def flows(old: dict[int, int], new: list[int]) -> dict[tuple[int, int], int]:
    """Bytes from each old shard to each new one; a byte that stays costs nothing."""
    names = sorted(old)
    net = Flow(2 + len(names) + len(new))
    arcs = {}
    for i, name in enumerate(names):
        net.add(0, 2 + i, old[name], 0)
        for j in range(len(new)):
            arcs[name, j] = net.add(2 + i, 2 + len(names) + j, old[name], int(name != j))
    for j, capacity in enumerate(new):
        net.add(2 + len(names) + j, 1, capacity, 0)
    net.run(0, 1)
    return {k: back[1] for k, back in arcs.items() if back[1]}


def plan(blocks: list[tuple[int, int, int, int]], shards: int) -> dict[tuple[int, int], int]:
    """(old shard, block) -> new shard for blocks (old shard, file, block, bytes)."""
    total = sum(b[3] for b in blocks)
    capacity = capacities(total, shards)
    sizes: dict[int, int] = {}
    for shard, _, _, size in blocks:
        sizes[shard] = sizes.get(shard, 0) + size
    moves = flows(sizes, capacity)
    by_shard: dict[int, list] = {}
    for b in blocks:
        by_shard.setdefault(b[0], []).append(b)
    target: dict[tuple[int, int], int] = {}
    load = [0] * shards
    for shard, own in by_shard.items():
        left = {j: n for (i, j), n in moves.items() if i == shard and j != shard}
        for b in sorted(own, key=lambda b: (b[1], -b[3], b[2])):  # file by file, large blocks first
            fits = [j for j, n in left.items() if n >= b[3]]
            if shard >= shards:  # the shard goes away: every block moves
                j = max(left, key=lambda j: (left[j], -j)) if left else min(range(shards), key=load.__getitem__)
            else:
                j = max(fits, key=lambda j: (left[j], -j)) if fits else shard
            if j != shard and j in left:
                left[j] -= b[3]
            target[b[0], b[2]] = j
            load[j] += b[3]
    return _repair(blocks, target, load)


def _repair(blocks: list[tuple[int, int, int, int]], target: dict, load: list[int]) -> dict:
    """Move single blocks from the fullest to the emptiest shard while that narrows the gap."""
    held: list[list[tuple[int, int, int]]] = [[] for _ in load]
    for shard, _, block, size in blocks:
        held[target[shard, block]].append((size, shard, block))
    for own in held:
        own.sort()
    for _ in range(20 * len(blocks)):
        high, low = max(range(len(load)), key=load.__getitem__), min(range(len(load)), key=load.__getitem__)
        gap = load[high] - load[low]
        at = bisect_left(held[high], (gap // 2 + 1, -1, -1))
        near = [k for k in (at - 1, at) if 0 <= k < len(held[high]) and held[high][k][0] < gap]
        if not near:
            return target
        k = min(near, key=lambda k: abs(gap - 2 * held[high][k][0]))
        size, shard, block = moved = held[high].pop(k)
        held[low].insert(bisect_left(held[low], moved), moved)
        target[shard, block] = low
        load[high] -= size
        load[low] += size
    return target


def row_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def reshard(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", old: int = OLD_SHARDS, new: int = NEW_SHARDS
) -> DataFrame:
    """Lay docs out in old shards under folder, then in new ones; return the new files' rows.

    Result: doc_id, text, size, shard, block, block_start (rows of the shard before the block).
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    mixed = F.xxhash64(F.col(id_col), text)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
        row_size(text).alias("size"),
        mixed.alias("h"),
        F.pmod(mixed, F.lit(old)).cast("int").alias("shard"),
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    large = F.col("size") > max(ROW_BYTES, total // (new * FINE))
    part = F.pmod(F.shiftrightunsigned("h", 20), F.lit(BLOCKS))
    rows = rows.withColumn(
        "block", F.when(large, F.col("h").bitwiseAND((1 << 62) - 1) + BLOCKS).otherwise(part)
    ).withColumn("file", F.pmod("block", F.lit(FILES)).cast("int"))
    parts = max(1, -(-total // (max(old, new) * FILES * PART_BYTES)))
    columns = ["doc_id", "text", "size", "block", "shard", "file"]
    slice_ = F.pmod(F.xxhash64("doc_id", "size"), F.lit(parts))
    laid = materialize(rows.select(*columns).repartition("shard", "file", slice_), f"{folder}/before", ["shard", "file"])
    sizes = laid.groupBy("shard", "file", "block").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    target = plan([(r.shard, r.file, r.block, r.size) for r in sizes], new)
    touched = {(r.shard, r.file) for r in sizes if target[r.shard, r.block] != r.shard}
    touched |= {(target[r.shard, r.block], r.file) for r in sizes if target[r.shard, r.block] != r.shard}
    starts, entries = {}, []
    for r in sorted(sizes, key=lambda r: (r.file, r.block, r.shard)):
        shard = target[r.shard, r.block]
        entries.append((r.shard, r.block, shard, starts.get(shard, 0)))
        starts[shard] = starts.get(shard, 0) + r.n
    # Bounded by old * BLOCKS + new * FINE entries, whatever the corpus.
    schema = "old_shard int, block long, new_shard int, block_start long"
    places = F.broadcast(spark.createDataFrame(entries, schema).withColumnRenamed("block", "b"))

    def placed(df: DataFrame) -> DataFrame:
        return df.join(places, (df["shard"] == places["old_shard"]) & (df["block"] == places["b"]))

    name = F.col("shard") * FILES + F.col("file")
    changed = name.isin([s * FILES + f for s, f in touched]) if touched else F.lit(False)
    kept = placed(laid.filter(~changed)).select(*columns, "block_start")
    again = placed(laid.filter(changed)).select(
        "doc_id", "text", "size", "block", F.col("new_shard").alias("shard"), "file", "block_start"
    )
    written = materialize(again.repartition("shard", "file", slice_), f"{folder}/after", ["shard", "file"])
    return kept.unionByName(written)


def with_slots(rows: DataFrame) -> DataFrame:
    """Add slot: rows of the shard before the block, plus the place within the block."""
    order = W.partitionBy("shard", "block", "block_start").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("slot", F.col("block_start") + F.row_number().over(order) - 1)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    files = reshard(docs, scratch(spark, "shards"))
    lean = files.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), "shard", "block", "block_start"
    )
    return with_slots(lean).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

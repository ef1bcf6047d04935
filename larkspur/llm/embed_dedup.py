"""Near-duplicate embeddings: exact threshold pairs by dual traversal of cover trees.

Equal vectors are one class.  Classes go to the cell of their nearest pivot (a bounded sample), a
large cell is split by hash, and cell pairs whose pivots lie further apart than both covering
radii and the limit allow are never met.  Each block gets a cover tree: nested levels with halving
radii, every centre standing for itself below.  Two blocks are joined from the roots down.  A pair
of nodes is pruned when its centres are further apart than the limit plus both covering radii, and
taken whole when even the farthest members are near enough; what is left is compared member by
member.  Distances are those of unit vectors, sqrt(2 - 2 cos), in double precision.

A task never emits pairs: it returns each class's number of linked vectors and a spanning forest
of the links, so output stays linear in its rows.  Components come from the forests.

The result is exact whatever the data; how much is pruned is not.  For vectors without any
structure the distance computations grow as the square of the rows.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do
vectors of different lengths.  Repeated rows link to each other.  Rows with a null id take part; a
component takes its id from those that are not null.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.components import connected_components
from larkspur.llm.sampling import sample_of
from larkspur.llm.storage import materialize, scratch

MIN_COSINE = 0.95
LEVELS = (1.0, 0.5, 0.25, 0.125)
#: Rows of a block at most about; pivots about so many at least and at most (they are collected).
BLOCK_ROWS, MIN_PIVOTS, MAX_PIVOTS = 8192, 16, 256
DENSE = 1 << 18
#: Nodes of at most so many members are opened rather than kept wide.
OPEN = 256
SLACK = 1e-9


def unit_rows(blobs) -> np.ndarray:
    """Unit vectors in double precision from rows of float32 bytes."""
    raw = np.frombuffer(b"".join(blobs), dtype="<f4").reshape(len(blobs), -1).astype(np.float64)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def cover(vectors: np.ndarray, members: np.ndarray, radius: float, batch: int = 512) -> np.ndarray:
    """For each member the centre (a row number) of its node at one level; greedy, first member first."""
    near = 1 - radius * radius / 2
    centre = np.full(len(members), -1, dtype=np.int64)
    pending = np.arange(len(members))
    while len(pending):
        head = pending[:batch]
        block = vectors[members[head]]
        close = block @ block.T >= near
        chosen = []
        for k in range(len(head)):
            if centre[head[k]] < 0:
                chosen.append(k)
                mine = close[k] & (centre[head] < 0)
                mine[k] = True
                centre[head[mine]] = members[head[k]]
        rest = pending[batch:]
        if len(rest):
            found = vectors[members[rest]] @ block[chosen].T >= near
            hit = found.any(axis=1)
            centre[rest[hit]] = members[head[np.array(chosen)]][found[hit].argmax(axis=1)]
            rest = rest[~hit]
        pending = rest
    return centre


def build_paths(vectors: np.ndarray) -> np.ndarray:
    """Cover tree of a block: for each row its centre's row number at every level."""
    paths = np.empty((len(vectors), len(LEVELS)), dtype=np.int64)
    groups = [np.arange(len(vectors))] if len(vectors) else []
    for level, radius in enumerate(LEVELS):
        below = []
        for members in groups:
            if len(members) == 1:
                paths[members, level] = members
                below.append(members)
                continue
            paths[members, level] = centres = cover(vectors, members, radius)
            order = np.argsort(centres, kind="stable")
            cuts = np.flatnonzero(np.diff(centres[order])) + 1
            for node in np.split(order, cuts):
                middle, mine = centres[node[0]], members[node]
                # the centre comes first, so that it is a centre of the next level too
                below.append(np.concatenate(([middle], mine[mine != middle])))
        groups = below
    return paths


class Block:
    """One side of a join: unit vectors, weights, and the nodes of each level."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, paths: np.ndarray):
        self.vectors, self.weights, self.paths = vectors, weights, paths

    def nodes(self, members: np.ndarray, level: int, limit: float) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Centres, members and covering radii of the nodes that members form at a level.

        Small nodes wider than the limit are opened at once: their bound would prune little.
        """
        path = self.paths[members, level].copy()
        while True:
            order = np.argsort(path, kind="stable")
            sorted_path = path[order]
            starts = np.flatnonzero(np.concatenate(([True], np.diff(sorted_path) != 0)))
            dots = np.einsum("ij,ij->i", self.vectors[members[order]], self.vectors[sorted_path])
            far = np.sqrt(np.maximum(0, 2 - 2 * np.minimum.reduceat(dots, starts)))
            counts = np.diff(np.concatenate((starts, [len(order)])))
            level += 1
            wide = (far > limit) & (counts > 1) & (counts <= OPEN)
            if level == len(LEVELS) or not wide.any():
                break
            rows = order[np.repeat(wide, counts)]
            path[rows] = self.paths[members[rows], level]
        # A node opened before may lie around a centre outside it, which still bounds it.
        centres = np.where(counts == 1, members[order][starts], sorted_path[starts])
        far = np.where(counts == 1, 0.0, far + SLACK)
        return centres, np.split(members[order], starts[1:]), far


class DualJoin:
    """Links between two blocks, or within one."""

    def __init__(self, a: Block, b: Block | None, min_cosine: float):
        self.same = b is None
        self.a, self.b, self.min_cosine = a, b or a, min_cosine
        self.limit = float(np.sqrt(2 - 2 * min_cosine))
        self.degree_a = np.zeros(len(a.vectors), dtype=np.int64)
        self.degree_b = self.degree_a if self.same else np.zeros(len(self.b.vectors), dtype=np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def run(self) -> None:
        self._descend(np.arange(len(self.a.vectors)), np.arange(len(self.b.vectors)), 0, self.same)

    def _descend(self, left: np.ndarray, right: np.ndarray, level: int, self_pair: bool) -> None:
        if level == len(LEVELS) or (level and len(left) * len(right) <= DENSE):
            self._dense(left, right, self_pair)
            return
        centres_a, nodes_a, far_a = self.a.nodes(left, level, self.limit)
        centres_b, nodes_b, far_b = (centres_a, nodes_a, far_a) if self_pair else self.b.nodes(right, level, self.limit)
        single_a = np.array([len(n) == 1 for n in nodes_a])
        single_b = single_a if self_pair else np.array([len(n) == 1 for n in nodes_b])
        # Few nodes are wide: columns of like radius share one bound, so that it stays tight.
        for columns in (far_b == 0, (far_b > 0) & (far_b <= self.limit), far_b > self.limit):
            some = np.flatnonzero(columns)
            if not len(some):
                continue
            vectors, widest = self.b.vectors[centres_b[some]].T, far_b[some].max()
            step = max(1, (1 << 21) // len(some))
            for at in range(0, len(centres_a), step):
                dots = self.a.vectors[centres_a[at : at + step]] @ vectors
                reach = self.limit + far_a[at : at + step] + widest + SLACK
                flat = np.flatnonzero(dots >= (1 - reach * reach / 2)[:, None])
                i, cos = flat // len(some), dots.ravel()[flat]
                i, j = i + at, some[flat % len(some)]
                apart = np.sqrt(np.maximum(0, 2 - 2 * cos))
                keep = apart <= self.limit + far_a[i] + far_b[j] + SLACK
                if self_pair:
                    keep &= i <= j
                i, j, cos, apart = i[keep], j[keep], cos[keep], apart[keep]
                both = single_a[i] & single_b[j]
                linked = both & (cos >= self.min_cosine)
                if self_pair:
                    linked &= i != j
                self._links(centres_a[i[linked]], centres_b[j[linked]])
                for x, y, d in zip(i[~both].tolist(), j[~both].tolist(), apart[~both].tolist(), strict=True):
                    own = self_pair and x == y
                    if (0 if own else d) + far_a[x] + far_b[y] < self.limit - SLACK:
                        self._whole(nodes_a[x], nodes_b[y], own)
                    else:
                        self._descend(nodes_a[x], nodes_b[y], level + 1, own)

    def _links(self, x: np.ndarray, y: np.ndarray) -> None:
        """Single links; each is seen once."""
        np.add.at(self.degree_a, x, self.b.weights[y])
        np.add.at(self.degree_b, y, self.a.weights[x])
        self.edges.append((x, y))

    def _whole(self, left: np.ndarray, right: np.ndarray, own: bool) -> None:
        """All members link: sums for the degrees, a star for the forest."""
        if own:
            self.degree_a[left] += self.a.weights[left].sum() - self.a.weights[left]
            self.edges.append((np.full(len(left) - 1, left[0]), left[1:]))
            return
        self.degree_a[left] += self.b.weights[right].sum()
        self.degree_b[right] += self.a.weights[left].sum()
        self.edges.append((np.full(len(right), left[0]), right))
        self.edges.append((left[1:], np.full(len(left) - 1, right[0])))

    def _dense(self, left: np.ndarray, right: np.ndarray, own: bool) -> None:
        step = max(1, (1 << 22) // len(right))
        for at in range(0, len(left), step):
            part = left[at : at + step]
            linked = self.a.vectors[part] @ self.b.vectors[right].T >= self.min_cosine
            if own:
                linked[np.arange(len(part)), np.arange(at, at + len(part))] = False
            self.degree_a[part] += linked @ self.b.weights[right]
            if not own:
                self.degree_b[right] += self.a.weights[part] @ linked
            self._forest(part, right, linked)

    def _forest(self, left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> None:
        """Breadth-first spanning edges; every row and column is opened once."""
        open_rows, open_columns = linked.any(axis=1), linked.any(axis=0)
        while open_rows.any():
            front = np.array([open_rows.argmax()])
            open_rows[front] = False
            while len(front):
                reached = linked[front] & open_columns
                columns = np.flatnonzero(reached.any(axis=0))
                self.edges.append((left[front[reached[:, columns].argmax(axis=0)]], right[columns]))
                open_columns[columns] = False
                back = linked[:, columns] & open_rows[:, None]
                front = np.flatnonzero(back.any(axis=1))
                self.edges.append((left[front], right[columns[back[front].argmax(axis=1)]] if len(front) else right[:0]))
                open_rows[front] = False


def _forest_of(ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges that join different trees, by union-find over the task's own links."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept_a, kept_b = [], []
    for x, y in zip(ids_a.tolist(), ids_b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept_a.append(x)
            kept_b.append(y)
    return kept_a, kept_b


def _tree_of(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("class").reset_index(drop=True)
    paths = build_paths(unit_rows(block["vector"]))
    block["path"] = list(paths.astype(np.int32))
    block["place"] = np.arange(len(block), dtype=np.int32)
    return block[["block", "class", "n", "vector", "path", "place"]]


def _side(rows: pd.DataFrame) -> tuple[Block, np.ndarray]:
    rows = rows.sort_values("place")
    paths = np.stack(rows["path"].to_numpy()).astype(np.int64)
    return Block(unit_rows(rows["vector"]), rows["n"].to_numpy(), paths), rows["class"].to_numpy()


def links_of_classes(classes: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """classes (class, n, vector as float32 bytes of one length) -> (a, b, n).

    Rows with b null: n vectors outside the class link to class a.  Others: forest edges a - b.
    """
    spark = classes.sparkSession
    limit = float(np.sqrt(2 - 2 * min_cosine))
    total = classes.count()
    wanted = min(MAX_PIVOTS, max(MIN_PIVOTS, -(-total // BLOCK_ROWS)))
    pivots = sample_of(classes.select(F.col("class").alias("id"), "vector"), wanted).collect()
    pivots = sorted(pivots, key=lambda p: p["id"]) or classes.limit(1).collect()
    if not pivots:
        return spark.createDataFrame([], "a long, b long, n long")
    shared = spark.sparkContext.broadcast(unit_rows([bytes(p.vector) for p in pivots]))

    @F.pandas_udf("cell int, apart double")
    def nearest(blobs: pd.Series) -> pd.DataFrame:
        dots = unit_rows(blobs) @ shared.value.T
        cell = dots.argmax(axis=1)
        apart = np.sqrt(np.maximum(0, 2 - 2 * dots[np.arange(len(cell)), cell]))
        return pd.DataFrame({"cell": cell.astype(np.int32), "apart": apart})

    celled = classes.withColumn("c", nearest("vector")).select("class", "n", "vector", "c.cell", "c.apart")
    sizes = celled.groupBy("cell").agg(F.count("*").alias("rows"), F.max("apart").alias("far")).collect()
    points, far = shared.value, {r["cell"]: r["far"] for r in sizes}
    first, parts, number = {}, {}, 0
    share = max(64, min(BLOCK_ROWS, int(1.5 * total / len(sizes))))
    for r in sorted(sizes, key=lambda r: r["cell"]):
        first[r["cell"]], parts[r["cell"]] = number, max(1, -(-r["rows"] // share))
        number += parts[r["cell"]]

    def meets(c: int, d: int) -> bool:
        apart = float(np.sqrt(max(0, 2 - 2 * points[c] @ points[d])))
        return c == d or apart <= limit + far[c] + far[d] + 1e-6

    # A table of at most MAX_PIVOTS cells, each with the ranges of blocks that it meets.
    ranges = [
        (c, first[c], parts[c], [x for d in sorted(first) if meets(c, d) for x in range(first[d], first[d] + parts[d])])
        for c in first
    ]
    table = F.broadcast(spark.createDataFrame(ranges, "cell int, first int, parts int, others array<int>"))
    placed = celled.join(table, "cell").select(
        (F.col("first") + F.pmod(F.xxhash64("class", F.lit(3)), F.col("parts"))).cast("int").alias("block"), "class", "n", "vector"
    )
    trees = placed.groupBy("block").applyInPandas(
        _tree_of, "block int, class long, n long, vector binary, path array<int>, place int"
    )
    trees = materialize(trees, scratch(spark, "cover-trees"))
    lookup = [(first[c] + k, others) for c, _, _, others in ranges for k in range(parts[c])]
    partners = F.broadcast(spark.createDataFrame(lookup, "block int, others array<int>"))
    spread = (
        trees.join(partners, "block")
        .withColumn("other", F.explode("others"))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("others", "other")
    )

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        low, high = key
        a, ids_a = _side(rows[rows["block"] == low])
        b, ids_b = (None, ids_a) if low == high else _side(rows[rows["block"] == high])
        task = DualJoin(a, b, min_cosine)
        task.run()
        x = np.concatenate([ids_a[e[0]] for e in task.edges] + [ids_a[:0]])
        y = np.concatenate([ids_b[e[1]] for e in task.edges] + [ids_a[:0]])
        kept_a, kept_b = _forest_of(x, y)
        counted = [(ids_a, task.degree_a)] + ([] if b is None else [(ids_b, task.degree_b)])
        out = [pd.DataFrame({"a": kept_a, "b": kept_b, "n": 0}, dtype="Int64")]
        out += [pd.DataFrame({"a": i[d > 0], "b": pd.NA, "n": d[d > 0]}).astype("Int64") for i, d in counted]
        return pd.concat(out)

    found = spread.groupBy("low", "high").applyInPandas(join, "a long, b long, n long")
    return materialize(found, scratch(spark, "embedding-links"))


def near_duplicates(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", min_cosine: float = MIN_COSINE
) -> DataFrame:
    """(id, n_links, component) for every row of table."""
    spark = table.sparkSession
    vector = F.col(vector_col).cast("array<float>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = table.select(F.col(id_col).alias("id"), F.when(usable, vector).alias("v"))
    rows = rows.withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(1), "v")})
    good = rows.filter("v IS NOT NULL")
    classes = good.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.first("v").alias("v"))

    @F.pandas_udf("binary")
    def packed(vectors: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(v, dtype="<f4").tobytes() for v in vectors])

    classes = classes.select(
        F.monotonically_increasing_id().alias("class"), "k1", "k2", "n", "least", F.size("v").alias("dims"), packed("v").alias("vector")
    )
    classes = materialize(classes, scratch(spark, "vector-classes"))
    found = None
    for row in classes.groupBy("dims").count().collect():  # one length as a rule
        some = links_of_classes(classes.filter(F.col("dims") == row["dims"]).select("class", "n", "vector"), min_cosine)
        found = some if found is None else found.union(some)
    if found is None:
        found = spark.createDataFrame([], "a long, b long, n long")
    degrees = found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("links"))
    roots = connected_components(found.filter("b IS NOT NULL").select("a", "b"))
    named = (
        classes.select("class", "k1", "k2", "n", "least")
        .join(degrees.withColumnRenamed("a", "class"), "class", "left")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("component", "class"))
    )
    least = named.groupBy("root").agg(F.min("least").alias("smallest"))
    answer = named.join(least, "root").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.col("smallest").alias("component")
    )
    joined = good.select("id", "k1", "k2").join(answer, ["k1", "k2"]).select("id", "n_links", "component")
    alone = rows.filter("v IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return joined.unionByName(alone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return near_duplicates(table).select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a
), components AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), degrees AS (
  SELECT a AS vec_id, count(*) AS n_links FROM pairs GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN degrees USING (vec_id)
"""

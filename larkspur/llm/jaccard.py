"""Near-duplicates by the Jaccard similarity of word shingles, found by an exact prefix join.

Shingles are the sets of 5 consecutive words as fingerprints see them (A-Z lowered, split at ASCII white space; fewer words:
the whole sequence; none: no shingle), as 64-bit hashes.  Texts of equal sets are one node.  Two nodes link if they share p/q =
0.8 of all their shingles or more.

Search: shingles have one global order, those common in a sample of documents last, by hash otherwise.  The sample is a fixed
share of large tables, so the order puts the same absolute frequencies last at any size.  It decides what it costs, never what is found: nodes of n <= m shingles that link share a shingle among the first ``n - ceil(2pn/(p+q)) + 1`` of
the smaller and the first ``m - ceil(pm/q) + 1`` of the larger.  Those are the keys, joined by value.  Candidates whose
sketches (two to four bits a shingle) differ in more bits than linked sets can are dropped, the rest is verified on whole sets.

Buckets of at most ``PAIR_BUCKET`` nodes are joined with themselves.  In larger ones all nodes are held against one head first;
after that only nodes outside the bucket's largest component are joined with the bucket.  A large group of near copies costs its
size, but many texts that share a key and do not link cost the square of their number.
"""

from __future__ import annotations

import uuid
from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm.components import connected_components
from larkspur.llm.storage import materialize, remove, scratch
from larkspur.llm.worker import held

SHINGLE_WORDS = 5
SIMILARITY = 0.8
PAIR_BUCKET = 32
SEED = 42
#: A shingle is common if COMMON_IN of the sampled texts hold it: one text in SAMPLE_SHARE, or more of small tables (about
#: SAMPLE_TEXTS).  At most COMMON_MOST are sent to the tasks.
SAMPLE_TEXTS, SAMPLE_SHARE, COMMON_IN, COMMON_MOST = 4000, 8, 4, 200_000
BASE = np.uint64(0x9E3779B97F4A7C15)
KEYS = T.StructType([T.StructField("node", T.LongType()), T.StructField("n", T.LongType()), T.StructField("first", T.LongType()),
                     T.StructField("sketch", T.ArrayType(T.LongType())), T.StructField("keys", T.ArrayType(T.LongType()))])
SET = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])


def shingle_set(text: str | None, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), dtype=np.uint64, count=len(words))
    size = min(shingle_words, len(words))
    out = np.full(len(words) - size + 1, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        out = out * BASE + hashes[k : k + len(out)]
    out ^= out >> np.uint64(29)
    return np.unique(out * BASE)


def node_of(shingles: np.ndarray) -> int:
    return int(np.array(xxhash.xxh64_intdigest(shingles.tobytes(), SEED), dtype=np.uint64).view(np.int64))


def sketch_of(shingles: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of shingles falls on each.  Sets differ in as many shingles as sketches in bits, or more.

    There are two to four bits a shingle, 512 at least, always a power of two: a sketch folds to half its bits by the exclusive
    or of its halves.
    """
    bits = max(512, 1 << (2 * len(shingles) - 1).bit_length())
    at = (shingles >> np.uint64(20)) & np.uint64(bits - 1)
    odd = (np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def folds(ratio: Fraction) -> int:
    """How often the longer of two sketches is folded at most, where the sizes of the sets let them link."""
    k = 0
    while ratio * (1 << k) < 1:
        k += 1
    return k


def differing_bits(x: str, y: str, times: int) -> Column:
    """Bits in which two sketches differ; null if one is over ``times`` folds longer."""
    words = F.least(F.size(x), F.size(y))

    def folded(sketch: Column) -> Column:
        half = F.shiftright(F.size(sketch), 1)
        ends = F.zip_with(F.slice(sketch, 1, half), F.slice(sketch, half + 1, half), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(sketch) > words, ends).otherwise(sketch)

    one, two = F.col(x), F.col(y)
    for _ in range(times):
        one, two = folded(one), folded(two)
    bits = F.zip_with(one, two, lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.aggregate(bits, F.lit(0), lambda u, v: u + v)


def prefixes(n: int, ratio: Fraction) -> tuple[int, int]:
    """Keys of a node as the smaller of two, and as either."""
    p, q = ratio.numerator, ratio.denominator
    return (n + (-2 * p * n) // (p + q) + 1, n + (-p * n) // q + 1) if n else (0, 0)


def keys_of(text: str | None, common: np.ndarray, shingle_words: int, ratio: Fraction) -> tuple:
    found = shingle_set(text, shingle_words)
    first, most = prefixes(len(found), ratio)
    ordered = found
    if len(common):
        late = common[np.minimum(np.searchsorted(common, found), len(common) - 1)] == found
        ordered = np.concatenate((found[~late], found[late]))
    return node_of(found), len(found), first, sketch_of(found), ordered[:most].view(np.int64)


def _set_udf(shingle_words: int):
    @F.pandas_udf(SET)
    def sets(texts: pd.Series) -> pd.DataFrame:
        found = [shingle_set(t, shingle_words) for t in texts]
        return pd.DataFrame({"node": [node_of(s) for s in found], "shingles": [s.view(np.int64) for s in found]})

    return sets.asNondeterministic()  # or a filter on its result would run it once more below a join


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps that are done: it does so when the driver's collector runs."""
    spark.sparkContext._jvm.System.gc()


def common_shingles(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted hashes of shingles that many of a sample of docs (id, text) hold."""
    share = max(1, min(SAMPLE_SHARE, docs.count() // SAMPLE_TEXTS))
    picked = docs.filter(F.pmod(F.xxhash64(F.lit(SEED), "id", "text"), F.lit(share)) == 0).select(F.explode(_set_udf(shingle_words)("text")["shingles"]).alias("s"))
    often = picked.groupBy("s").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON_IN)
    rows = often.orderBy(F.desc("n"), "s").limit(COMMON_MOST).toArrow()
    return np.sort(rows["s"].to_numpy().astype(np.int64).view(np.uint64))


class Linker:
    """Rows of docs with their nodes, and the links between nodes."""

    def __init__(self, docs: DataFrame, shingle_words: int = SHINGLE_WORDS, similarity: float = SIMILARITY, *more: Column) -> None:
        """docs (id, text); more: further columns of the rows, made in the same pass."""
        self.spark, self.docs, self.words = docs.sparkSession, docs, shingle_words
        self.paths: dict[str, str] = {}
        self.ratio = ratio = Fraction(similarity).limit_denominator(1000)
        shared, name = self.spark.sparkContext.broadcast(common_shingles(docs, shingle_words)), uuid.uuid4().hex

        @F.pandas_udf(KEYS)
        def keys(texts: pd.Series) -> pd.DataFrame:
            common = held(("shingles", name), lambda: shared.value)
            return pd.DataFrame([keys_of(t, common, shingle_words, ratio) for t in texts], columns=KEYS.names)

        rows = docs.select("id", keys("text").alias("k"), F.struct(F.lit(0).alias("__none"), *more).alias("m"))
        rows = rows.select("id", "k.*", "m.*").drop("__none")
        self.rows = self.kept(rows, "keys")

    def kept(self, rows: DataFrame, name: str) -> DataFrame:
        self.paths[name] = scratch(self.spark, f"shingle-{name}")
        out = materialize(rows, self.paths[name])
        release(self.spark)
        return out

    def drop(self, *names: str) -> None:
        """Delete tables that are read no more."""
        for name in names:
            remove(self.spark, self.paths.pop(name))

    def enough(self, shared: Column, n: Column, m: Column) -> Column:
        p, q = self.ratio.numerator, self.ratio.denominator
        return shared * (p + q) >= (n + m) * p

    def candidates(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """(a, b) of nodes that share a key in the roles of smaller and larger; a of left, b of right."""
        other = right.select("key", F.col("node").alias("b"), F.col("n").alias("m"), F.col("small").alias("b_small"),
                             *[F.col(c).alias("b_" + c) for c in right.columns if c == "comp"])
        roles = (F.col("small") | (F.col("n") > F.col("m"))) & (F.col("b_small") | (F.col("m") > F.col("n")))
        fits = self.enough(F.least("n", "m"), F.col("n"), F.col("m"))
        differ = F.col("comp") != F.col("b_comp") if "comp" in right.columns else F.col("node") < F.col("b")
        pairs = left.join(other, "key").filter(roles & fits & differ)
        return pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Of (a, b) that link, as many as give the same components."""
        p, q = self.ratio.numerator, self.ratio.denominator
        known = self.rows.select("node", "n", "sketch").dropDuplicates(["node"])
        pairs = pairs.filter("a <> b").distinct().join(known.select(F.col("node").alias("a"), "n", F.col("sketch").alias("x")), "a")
        pairs = pairs.join(known.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y")), "b")
        fits = self.enough(F.least("n", "m"), F.col("n"), F.col("m"))
        close = differing_bits("x", "y", folds(self.ratio)) * (p + q) <= (F.col("n") + F.col("m")) * (q - p)
        pairs = self.kept(pairs.filter(fits & close).select("a", "b"), "pairs")
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        ids = self.rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("id").alias("__id"))
        ids = ids.select("__id").distinct()
        texts = self.docs.join(ids, F.col("id").eqNullSafe(F.col("__id")), "left_semi")
        sets = texts.select(_set_udf(self.words)("text").alias("s")).select("s.*").join(nodes, "node", "left_semi")
        sets = sets.groupBy("node").agg(F.first("shingles").alias("shingles"))
        sets = self.kept(sets, "sets")
        # One partner of each node first: pairs that meet in a partner of both add nothing to their component.
        least = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        first = self.close(least, sets)
        rest = pairs.join(least, ["a", "b"], "left_anti")
        for end in ("a", "b"):
            roots = first.select(F.col("b").alias(end), F.col("a").alias(f"root_{end}"))
            rest = rest.join(roots, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
        second = self.close(rest.filter("root_a <> root_b").select("a", "b"), sets)
        self.drop("pairs", "sets")
        return first.union(second)

    def close(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of (a, b) whose sets (node, shingles) are similar enough."""
        one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        both = pairs.join(one, "a").join(two, "b")
        enough = self.enough(F.size(F.array_intersect("x", "y")), F.size("x"), F.size("y"))
        return self.kept(both.filter(enough).select("a", "b"), "links")

    def links(self, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
        """Edges (a, b) whose components are those of all pairs of nodes that link."""
        keyed = self.rows.select("node", "n", "first", F.posexplode("keys").alias("place", "key"))
        keyed = keyed.select("key", "node", "n", (F.col("place") < F.col("first")).alias("small"))
        met = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.max("small").alias("any"))
        met = self.kept(met.filter("lo <> hi AND any").select("key"), "shared")
        shared = self.kept(keyed.join(met, "key").distinct(), "buckets")
        self.drop("shared")
        sizes = shared.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("head"))
        sized = shared.join(sizes, "key")
        few = sized.filter(F.col("size") <= pair_bucket).select("key", "node", "n", "small")
        many = sized.filter(F.col("size") > pair_bucket)
        stars = many.select(F.col("head").alias("a"), F.col("node").alias("b"))
        found = self.verified(self.candidates(few, few).union(stars))
        if many.isEmpty():
            return found
        parts = connected_components(found)
        many = many.select("key", "node", "n", "small").join(parts, "node", "left")
        many = many.withColumn("comp", F.coalesce("component", "node")).drop("component")
        counted = many.groupBy("key", "comp").agg(F.count("*").alias("n"))
        main = counted.groupBy("key").agg(F.max(F.struct("n", "comp"))["comp"].alias("main"), F.count("*").alias("parts"))
        many = many.join(main.filter("parts > 1"), "key")
        return found.union(self.verified(self.candidates(many.filter("comp <> main"), many)))

    def classes(self, edges: DataFrame) -> DataFrame:
        """(id, node, component) for every row, nodes joined by edges (a, b)."""
        components = connected_components(edges).withColumnRenamed("component", "root")
        nodes = self.rows.groupBy("node").agg(F.min("id").alias("least"))
        nodes = nodes.join(components, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
        least = nodes.groupBy("root").agg(F.min("least").alias("component"))
        return self.rows.select("id", "node").join(nodes.join(least, "root").select("node", "component"), "node")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    pair_bucket: int = PAIR_BUCKET,
) -> DataFrame:
    """(id, node, component) for every row of docs; component the smallest id reachable, null if none has one."""
    linker = Linker(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), shingle_words, similarity)
    return linker.classes(linker.links(pair_bucket))

"""SimHash near-duplicates found by Golay-code fuzzy hashing.

Fingerprint: A-Z lowered, words ``[^\\x20\\x09-\\x0D]+``, 3-word shingles with repeats (fewer words:
the whole sequence; none: fingerprint zero), XXH64 of each with seed 42, one bit of 64 set where
over half of the hashes have it.  Two fingerprints link at ``MAX_BITS`` = 2 or fewer differing bits.

Search: the 64 bits are cut into segments of 22, 21 and 21 bits, each padded to 23 and decoded
with the perfect binary Golay code, whose 4096 spheres of radius 3 fill the space.  A word's keys
are the codeword indices of all words within one bit of it (six as a rule).  Words within *two*
bits of each other share a word in the middle, and so a key.  Of three segments with two errors in
all, some segment is free of errors while the next one (in cyclic order) has one at most, so
(segment, exact bits, key of the next segment) meets for every linked pair: about 18 keys of 33
bits for each distinct fingerprint.

Buckets of at most ``PAIR_BUCKET`` fingerprints are joined with themselves and verified.  Larger
ones are never paired: their fingerprints are keyed once more by each of the 65 words within one
bit.  Two that share such a word are within two bits, and any two within two bits share one, so a
star per middle word gives the same components in linear size.  No pair is lost either way.

Equal fingerprints are one node.  Rows with null ids are classed too, but a class takes its id
from those that are not null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm import jaccard
from larkspur.llm.components import connected_components
from larkspur.llm.storage import materialize, scratch

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
PAIR_BUCKET = 32
# The segments (first bit, bits) and the generator polynomial of the [23, 12, 7] code.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GENERATOR = 0xC75


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    hash64 = xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        hashes = np.array([hash64(joined, SEED)], dtype="<u8")
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist(), strict=True)
        hashes = np.fromiter((hash64(joined[a:b], SEED) for a, b in spans), dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded working memory for very long texts
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def fingerprint_udf(texts: pd.Series) -> pd.Series:
    found = np.array([fingerprint(t) for t in texts], dtype=np.uint64)
    return pd.Series(found.view(np.int64))


class Golay:
    """Syndrome decoder of the binary Golay code for numpy arrays of 23-bit words."""

    def __init__(self) -> None:
        single = np.array([self._remainder(1 << bit) for bit in range(23)], dtype=np.int64)
        self._low = self._table(single[:12])
        self._high = self._table(single[12:])
        self._error = np.zeros(2048, dtype=np.int64)
        for a in range(23):
            self._error[single[a]] = 1 << a
            for b in range(a):
                self._error[single[a] ^ single[b]] = 1 << a | 1 << b
                for c in range(b):
                    self._error[single[a] ^ single[b] ^ single[c]] = 1 << a | 1 << b | 1 << c
        self._near = np.concatenate(([0], 1 << np.arange(23)))

    @staticmethod
    def _remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    @staticmethod
    def _table(single: np.ndarray) -> np.ndarray:
        table = np.zeros(1, dtype=np.int64)
        for s in single:
            table = np.concatenate((table, table ^ s))
        return table

    def index(self, words: np.ndarray) -> np.ndarray:
        """The 12-bit index of the codeword whose sphere of radius 3 holds each word."""
        syndrome = self._low[words & 0xFFF] ^ self._high[words >> 12]
        return (words ^ self._error[syndrome]) >> 11

    def keys(self, words: np.ndarray) -> np.ndarray:
        """For each word the indices of all words within one bit; repeats in a row are -1."""
        found = np.sort(self.index(words[:, None] ^ self._near[None, :]), axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        return found


_golay: Golay | None = None


def _segment(prints: np.ndarray, k: int) -> np.ndarray:
    first, bits = SEGMENTS[k]
    return (prints.view(np.uint64) >> np.uint64(first)).astype(np.int64) & ((1 << bits) - 1)


@F.pandas_udf(T.ArrayType(T.LongType()))
def golay_keys(prints: pd.Series) -> pd.Series:
    """About 18 bucket keys of each fingerprint (signed 64-bit)."""
    global _golay
    _golay = _golay or Golay()
    values = prints.to_numpy(dtype=np.int64)
    parts = []
    for k in range(3):
        near = _golay.keys(_segment(values, (k + 1) % 3))
        exact = _segment(values, k)[:, None]
        parts.append(np.where(near < 0, -1, (exact << 14) | (near << 2) | k))
    every = np.concatenate(parts, axis=1)
    return pd.Series([row[row >= 0] for row in every])


@F.pandas_udf(T.ArrayType(T.LongType()))
def middle_words(prints: pd.Series) -> pd.Series:
    """All 65 words within one bit of each fingerprint."""
    flips = np.concatenate(([0], np.uint64(1) << np.arange(64, dtype=np.uint64))).astype(np.uint64)
    every = prints.to_numpy(dtype=np.int64).view(np.uint64)[:, None] ^ flips[None, :]
    return pd.Series(list(every.view(np.int64)))


def link_fingerprints(distinct: DataFrame, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``fp`` within two bits."""
    keyed = distinct.select("fp", F.explode(golay_keys("fp")).alias("key"))
    keyed = materialize(keyed, scratch(distinct.sparkSession, "golay-keys"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = keyed.join(sizes, "key")
    small = shared.filter(F.col("n") <= pair_bucket).select("key", "fp")
    other = small.select("key", F.col("fp").alias("b"))
    close = (F.col("fp") < F.col("b")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= MAX_BITS)
    pairs = small.join(other, "key").filter(close).select(F.col("fp").alias("a"), "b").distinct()
    large = shared.filter(F.col("n") > pair_bucket).select("fp").distinct()
    spread = large.select("fp", F.explode(middle_words("fp")).alias("middle"))
    heads = spread.groupBy("middle").agg(F.min("fp").alias("head"), F.count("*").alias("n")).filter("n > 1")
    stars = spread.join(heads, "middle").filter("fp <> head").select(F.col("head").alias("a"), F.col("fp").alias("b"))
    return pairs.union(stars.distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component) for every row of docs; fp signed, component the smallest id reachable."""
    spark = docs.sparkSession
    prints = docs.select(F.col(id_col).alias("id"), fingerprint_udf(F.coalesce(F.col(text_col), F.lit(""))).alias("fp"))
    prints = materialize(prints, scratch(spark, "fingerprints"))
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least"))
    distinct = materialize(distinct, scratch(spark, "distinct-fingerprints"))
    components = connected_components(link_fingerprints(distinct.select("fp")))
    nodes = distinct.join(components.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    least = nodes.groupBy("root").agg(F.min("least").alias("component"))
    classes = nodes.join(least, "root").select("fp", "component")
    return prints.join(classes, "fp").select("id", "fp", "component")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, node, component) for every row of docs, linked by two bits of their fingerprints or by the Jaccard similarity of ``jaccard``.

    Neither kind of link holds all of the other: both are found, in one pass over the texts, and joined before components are made.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    print_ = fingerprint_udf(F.coalesce("text", F.lit(""))).alias("fp")
    linker = jaccard.Linker(rows, jaccard.SHINGLE_WORDS, jaccard.SIMILARITY, print_)
    prints = linker.rows.select("node", "fp").distinct()
    near = connected_components(link_fingerprints(prints.select("fp").distinct())).withColumnRenamed("node", "fp")
    classed = prints.join(near, "fp", "left").select("node", F.coalesce("component", "fp").alias("class"))
    heads = classed.groupBy("class").agg(F.min("node").alias("a"))
    stars = classed.join(heads, "class").filter("node <> a").select("a", F.col("node").alias("b"))
    return linker.classes(linker.links().union(stars))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline form: of each component of ``near_copies`` the document with the smallest id stays.

    Rows with a null id stay.  Rows that share the smallest id all stay.
    """
    found = near_copies(docs)
    gone = found.filter(F.col("id") > F.col("component")).select(F.col("id").alias("__nd_id")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__nd_id"), "left_anti")

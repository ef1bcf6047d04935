"""Benchmark decontamination by template canonicalisation.

Words (split at white space, punctuation at their ends dropped) become template tokens: numbers,
units after a number, and capitalised words within a sentence become typed placeholders, all
others their lowered form.  Windows of ``WINDOW`` template tokens are hashed; an item shorter than
that, but of ``SHORTEST`` tokens or more, is one window of its own length.  Document windows pass a
fixed-size bitmap of the benchmark's windows (no false negatives) and the rest is hash-joined.
Windows on one diagonal (place in the document minus place in the item) are one alignment.  It
counts if what fills the placeholders maps one to one by type, item to document, all along, and
if it holds ``LITERALS`` literal tokens or more; so a question with new numbers or names is found,
and a text that merely has numbers in the same places is not.

Null, empty and shorter texts match nothing; nor does an empty benchmark.  Repeated rows of a
document match alike and are reported once.  Items of repeated ids count as one.  Null ids are
reported as null.  Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW, SHORTEST, LITERALS = 8, 5, 4
#: Size of the bitmap that is sent to every task, whatever the benchmark's size.
BITS = 24
CACHE_ENTRIES = 300_000
BASE = np.uint64(0x9E3779B97F4A7C15)
# Unit words.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec min h hr hrs ms day days week weeks month months year years "
    "hour hours minute minutes second seconds meter meters metre metres kilometer kilometers mile miles foot feet inch inches "
    "gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres gallon gallons dollar dollars cent "
    "cents euro euros percent degree degrees w kw kwh v mv a hz khz mhz ghz b kb mb gb tb mph kmh kph k c f pa kpa j kj cal kcal".split()
)
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d,]*(?:\.\d+)?%?")
NUMBER_UNIT = re.compile(r"([+-]?[$€£]?\d[\d,]*(?:\.\d+)?)([a-z]+)")
EDGE = "\"'`.,;:!?()[]{}<>*#&%$|~_"
LITERAL, NUM, UNIT, NAME, NUM_UNIT = range(5)
HIT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text_hash", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("window", T.LongType()),
        T.StructField("slots", T.ArrayType(T.StringType())),
    ]
)


class Templates:
    """Template tokens of texts, with a bounded table of words."""

    def __init__(self) -> None:
        self._holders = np.array([self._hash(f"\0{k}") for k in range(5)], dtype=np.uint64)
        self._clear()

    def _clear(self) -> None:
        self._places: dict[str, int] = {}
        self._values: list[str] = []
        self._hashes, self._kinds = np.zeros(1024, dtype=np.uint64), np.zeros(1024, dtype=np.int8)
        self._ends, self._filled = np.zeros(1024, dtype=bool), np.zeros(1024, dtype=bool)

    @staticmethod
    def _hash(word: str) -> int:
        return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 7)

    def _add(self, word: str) -> None:
        """Hash of the literal, what it may be, its value, whether a sentence ends with it."""
        core = word.strip(EDGE)
        low = core.lower()
        kind = LITERAL
        if NUMBER.fullmatch(core):
            kind = NUM
        elif (m := NUMBER_UNIT.fullmatch(low)) and m[2] in UNITS:
            kind = NUM_UNIT
        elif low in UNITS:
            kind = UNIT
        elif core[:1].isupper() and core[1:] and not core[1:].isupper():
            kind = NAME
        at = len(self._values)
        if at == len(self._hashes):
            for name in ("_hashes", "_kinds", "_ends", "_filled"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate((old, np.zeros_like(old))))
        self._places[word] = at
        self._values.append(low)
        self._hashes[at], self._kinds[at], self._filled[at] = self._hash(low), kind, low != ""
        self._ends[at] = word.rstrip("\"')]}")[-1:] in (".", "!", "?", ":")

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, kinds and word numbers of the template tokens of a text."""
        words = (text or "").split()
        if len(self._values) > CACHE_ENTRIES:
            self._clear()
        for word in set(words).difference(self._places):
            self._add(word)
        at = np.fromiter(map(self._places.__getitem__, words), dtype=np.int64, count=len(words))
        if not len(at):
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int8), at
        kinds, ends = self._kinds[at], self._ends[at]
        starts, after_number = np.ones(len(at), dtype=bool), np.zeros(len(at), dtype=bool)
        starts[1:], after_number[1:] = ends[:-1], kinds[:-1] == NUM
        plain = (kinds == LITERAL) | (kinds == NAME) & starts | (kinds == UNIT) & ~after_number
        kinds = np.where(plain, LITERAL, kinds)
        hashes = np.where(plain, self._hashes[at], self._holders[kinds])
        keep = self._filled[at]  # a word of punctuation only is no token
        return (hashes, kinds, at) if keep.all() else (hashes[keep], kinds[keep], at[keep])

    def slots(self, kinds: np.ndarray, words: np.ndarray, at: int, size: int) -> list[str | None]:
        return [None if kinds[k] == LITERAL else f"{kinds[k]}:{self._values[words[k]]}" for k in range(at, at + size)]


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of size tokens."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        out = out * BASE + hashes[k : k + n]
    return out ^ (out >> np.uint64(29))


def item_sizes(length: int) -> list[int]:
    return [WINDOW] if length >= WINDOW else [length] if length >= SHORTEST else []


def _rows(batch: pd.DataFrame, templates: Templates, pick):
    out = []
    for row in batch.itertuples(index=False):
        hashes, kinds, words = templates.tokens(row.text)
        for at, size, window in pick(hashes, kinds):
            out.append((row.id, getattr(row, "text_hash", 0), at, size, window, templates.slots(kinds, words, at, size)))
            if len(out) >= 20_000:
                yield pd.DataFrame(out, columns=HIT.names)
                out = []
    if out:
        yield pd.DataFrame(out, columns=HIT.names)


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(id, pos, size, window, slots) of every window of items (id, text)."""

    def make(batches):
        templates = Templates()

        def every(hashes, kinds):
            for size in item_sizes(len(hashes)):
                for at, h in enumerate(windows(hashes, size).view(np.int64).tolist()):
                    yield at, size, h

        for batch in batches:
            yield from _rows(batch, templates, every)

    source = items.filter("text IS NOT NULL").select(F.col("id").cast("long").alias("id"), "text")
    return source.mapInPandas(make, HIT).drop("text_hash")


def _bitmap(found: DataFrame) -> tuple[np.ndarray, list[int]]:
    """One bit for each of 2 ** BITS hash values, and the window sizes in use; of fixed size."""

    def fold(batches):
        bits = np.zeros(1 << (BITS - 3), dtype=np.uint8)
        sizes = set()
        for batch in batches:
            at = batch["window"].to_numpy(dtype=np.int64).view(np.uint64) >> np.uint64(64 - BITS)
            np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))
            sizes |= set(batch["size"].tolist())
        if sizes:
            yield pd.DataFrame({"bits": [bits.tobytes()], "sizes": [sorted(sizes)]})

    total, sizes = np.zeros(1 << (BITS - 3), dtype=np.uint8), set()
    for row in found.select("window", "size").mapInPandas(fold, "bits binary, sizes array<int>").toLocalIterator():
        total |= np.frombuffer(row["bits"], dtype=np.uint8)
        sizes |= set(row["sizes"])
    return total, sorted(sizes)


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(doc_id, item_id, covered, start, slots_changed): alignments of documents with items."""
    spark = docs.sparkSession
    known = benchmark_windows(items.select(F.col(item_col).alias("id"), F.col("text")))
    shared = spark.sparkContext.broadcast(_bitmap(known))

    def search(batches):
        bits, sizes = shared.value
        templates = Templates()

        def hits(hashes, kinds):
            for size in sizes:
                found = windows(hashes, size)
                if not len(found):
                    continue
                at = found >> np.uint64(64 - BITS)
                on = np.flatnonzero(bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1)
                if len(on):
                    yield from ((p, size, h) for p, h in zip(on.tolist(), found[on].view(np.int64).tolist(), strict=True))

        for batch in batches:
            yield from _rows(batch, templates, hits)

    source = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")
    )
    found = source.mapInPandas(search, HIT)
    theirs = known.select(
        F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), F.col("size").alias("item_size"),
        F.col("window").alias("item_window"), F.col("slots").alias("item_slots"),
    ).distinct()
    joined = found.join(theirs, (F.col("window") == F.col("item_window")) & (F.col("size") == F.col("item_size")))
    pairs = F.filter(F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b")), lambda s: s["a"].isNotNull())
    places = F.sequence("item_pos", F.col("item_pos") + F.col("size") - 1)
    literal = F.filter(
        F.zip_with(places, "slots", lambda p, s: F.when(s.isNull(), p)), lambda p: p.isNotNull()
    )
    lined = joined.groupBy("id", "text_hash", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).agg(
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
        F.size(F.array_distinct(F.flatten(F.collect_set(places)))).alias("covered"),
        F.size(F.array_distinct(F.flatten(F.collect_set(literal)))).alias("literals"),
        F.min("pos").alias("start"),
    )
    one_to_one = (F.size(F.array_distinct(F.transform("pairs", lambda s: s["a"]))) == F.size("pairs")) & (
        F.size(F.array_distinct(F.transform("pairs", lambda s: s["b"]))) == F.size("pairs")
    )
    changed = F.size(F.filter("pairs", lambda s: s["a"] != s["b"]))
    return (
        lined.filter(one_to_one & (F.col("literals") >= LITERALS))
        .groupBy("id", "item_id")
        .agg(F.max("covered").alias("covered"), F.min("start").alias("start"), F.max(changed).alias("slots_changed"))
        .withColumnRenamed("id", "doc_id")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and item that it leaks; clean documents have none."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return matches(docs, items)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline form: documents that leak an item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    leaked = matches(docs.select("doc_id", "text"), items).select(F.col("doc_id").alias("__dc_id")).distinct()
    return docs.join(leaked, F.col("doc_id") == F.col("__dc_id"), "left_anti")

"""Toxicity scores over text restored by a noisy-channel decoder.

Restoration: a token is a lattice of characters.  Leetspeak symbols may stand for letters,
separators inside a word and further repeats in a run of three or more may be dropped, each at a
cost; runs of single characters may be one spaced-out word.  Viterbi decoding over pairs of
characters finds the reading of least cost under a character trigram model, whose counts come from
*every* document of the corpus.  A token of letters without such signs has one reading: itself.

Score: logistic regression (FTRL with elastic net) over the set of restored words and their
prefixes of 3 to 7 characters, hashed, then Platt calibration on a fifth of the sample.  The fit
uses about ``SAMPLE_ROWS`` labelled rows, drawn by hash of the id (a documented bound); they are
read whole and their features are made on the executors.

Null or empty text has no features: its score is the calibrated bias.  Labels that are null or of
unknown documents teach nothing; of repeated labels of a document the largest holds, and of rows that
share an id the one of least text hash teaches.  Without both
classes in the sample every score is the share of toxic rows (0 if there are none).  Other columns
are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm.langid import held_out
from larkspur.llm.sampling import sample_of
from larkspur.llm.worker import held

DIMS = 1 << 20
SAMPLE_ROWS = 5000
EPOCHS = 10
ALPHA, BETA, L1, L2 = 0.3, 1.0, 10.0, 1e-3
THRESHOLD = 0.3
PREFIXES = range(3, 8)
SPACED_RUN = 4
CACHE_ENTRIES = 300_000
WINDOW = 256
SYMBOLS = 28  # 0 boundary, 1-26 a-z, 27 any other letter
# What leetspeak symbols may stand for, and separators within words.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = "._-*~'`^:,;/\\#%&=\""
LEET_COST, DROP_SYMBOL_COST, DROP_REPEAT_COST, DROP_SEPARATOR_COST = 0.5, 12.0, 0.3, 0.3
EDGE = re.compile(r"^[^\w@$!|+(€£]+|^[@$!|+(€£]{3,}|[^\w@$|+€£]+$|[^\w]{3,}$")
TRIPLE = re.compile(r"(.)\1\1")


def symbol(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 27 if char.isalpha() else 0


class CharModel:
    """Trigram costs (negative logarithms) from a flat table of counts."""

    def __init__(self, counts: np.ndarray):
        table = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS) + 0.05
        self.cost = (-np.log(table / table.sum(axis=2, keepdims=True))).ravel().tolist()

    def word_cost(self, word: str) -> float:
        a = b = 0
        total = 0.0
        for s in [*map(symbol, word), 0]:
            total += self.cost[(a * SYMBOLS + b) * SYMBOLS + s]
            a, b = b, s
        return total

    def decode(self, token: str) -> str:
        """The reading of least cost of one token of lowered characters."""
        if len(token) > WINDOW:
            return "".join(self.decode(token[k : k + WINDOW]) for k in range(0, len(token), WINDOW))
        cost = self.cost
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for k, char in enumerate(token):
            arcs: list[tuple[str, float]] = []
            if char.isalpha():
                arcs.append((char, 0.0))
                if k and token[k - 1] == char and (token[k + 1 : k + 2] == char or token[k - 2 : k - 1] == char):
                    arcs.append(("", DROP_REPEAT_COST))
            else:
                arcs.extend((letter, LEET_COST) for letter in LEET.get(char, ""))
                arcs.append(("", DROP_SEPARATOR_COST if char in SEPARATORS else DROP_SYMBOL_COST))
            new: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (total, out) in states.items():
                for letter, extra in arcs:
                    if letter:
                        s = symbol(letter)
                        key, value = (b, s), total + extra + cost[(a * SYMBOLS + b) * SYMBOLS + s]
                    else:
                        key, value = (a, b), total + extra
                    if key not in new or value < new[key][0]:
                        new[key] = (value, out + letter)
            states = new
        end = ((total + cost[(a * SYMBOLS + b) * SYMBOLS], out) for (a, b), (total, out) in states.items())
        return min(end)[1]

    def restore(self, token: str) -> str:
        """The restored word of one lowered token; empty if it has no letter."""
        core = EDGE.sub("", token)
        if core.isalpha():
            return self.decode(core) if TRIPLE.search(core) else core
        if not any(map(str.isalpha, core)):
            return ""
        return self.decode(core)

    def spaced(self, tokens: list[str]) -> str:
        """One word for a run of single characters, if that is likelier than the run; else empty."""
        word = self.decode("".join(tokens))
        apart = sum(self.word_cost(t) for t in tokens)
        return word if len(word) >= SPACED_RUN - 1 and self.word_cost(word) < apart else ""


def corpus_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Character trigram counts over all texts; at most SYMBOLS ** 3 rows reach the driver."""

    def count(batches):
        table = np.full(0x110000, 0, dtype=np.uint8)
        table[:0x10000] = [symbol(chr(p).lower()[0]) for p in range(0x10000)]
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                if not text:
                    continue
                points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                for at in range(0, len(points), 1 << 22):
                    s = np.concatenate(([0, 0], table[points[at : at + (1 << 22)]], [0])).astype(np.int32)
                    # Of two boundaries in a row the second starts a word: its context is (0, 0).
                    before = np.where(s[1:-1] == 0, 0, s[:-2])
                    code = (before * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
                    total += np.bincount(code[(s[1:-1] != 0) | (s[2:] != 0)], minlength=SYMBOLS**3)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"code": at, "n": total[at]})

    parts = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "code int, n long")
    rows = parts.groupBy("code").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    out = np.zeros(SYMBOLS**3)
    out[rows["code"].to_numpy()] = rows["n"].to_numpy()
    return out


def word_features(word: str) -> list[int]:
    raw = [b"=" + word.encode()] + [b"^" + word[:k].encode() for k in PREFIXES if len(word) >= k]
    return [zlib.crc32(r) & (DIMS - 1) for r in raw]


class Features:
    """Feature sets of texts; with weights, only features that weigh anything."""

    def __init__(self, model: CharModel, weights: np.ndarray | None = None):
        self.model, self.weights = model, weights
        self._cache: dict[str, tuple[int, ...]] = {}

    def of_token(self, token: str) -> tuple[int, ...]:
        known = self._cache.get(token)
        if known is None:
            word = self.model.restore(token)
            known = self._kept(word_features(word)) if word else ()
            if len(self._cache) >= CACHE_ENTRIES:
                self._cache.clear()
            self._cache[token] = known
        return known

    def _kept(self, found: list[int]) -> tuple[int, ...]:
        return tuple(found) if self.weights is None else tuple(f for f in found if self.weights[f])

    def of_text(self, text: str | None) -> set[int]:
        tokens = (text or "").lower().split()
        out: set[int] = set()
        for token in set(tokens):
            out.update(self.of_token(token))
        marks = "".join(["1" if len(t) == 1 else "0" for t in tokens])
        at = marks.find("1" * SPACED_RUN)
        while at >= 0:
            end = marks.find("0", at)
            end = len(marks) if end < 0 else end
            for k in range(at, end, WINDOW):
                word = self.model.spaced(tokens[k : min(end, k + WINDOW)])
                if word:
                    out.update(self._kept(word_features(word)))
            at = marks.find("1" * SPACED_RUN, end)
        return out


class Ftrl:
    """Binary logistic regression by FTRL-proximal over sets of features; the last weight is the bias."""

    def __init__(self):
        self.z, self.n = np.zeros(DIMS + 1), np.zeros(DIMS + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        out = -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        out[-1] = -z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA)  # the bias, always last, goes free of penalties
        return out

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = (1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label)
        sigma = (np.sqrt(self.n[at] + gradient**2) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += gradient - sigma * w
        self.n[at] += gradient**2


def platt(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through held-back logits, by damped Newton steps."""
    a, b = 1.0, 0.0
    positive = labels.sum()
    if not 0 < positive < len(labels):
        return a, b
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        w = p * (1 - p)
        g = np.array([((p - target) * logits).sum(), (p - target).sum()])
        h = np.array([[(w * logits**2).sum(), (w * logits).sum()], [(w * logits).sum(), w.sum()]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2 / max(1e-9, np.abs(step).max()))
        a, b = max(1e-3, a - step[0]), b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


class ToxicityModel:
    def __init__(self, counts: np.ndarray, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.parts = counts, weights, bias, slope, offset
        self.weights, self.bias, self.slope, self.offset = weights, bias, slope, offset
        self.features = Features(CharModel(counts), weights)

    def score(self, text: str | None) -> float:
        found = self.features.of_text(text)
        logit = self.bias + float(self.weights[list(found)].sum()) if found else self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * logit + self.offset, -30, 30))))


def constant(share: float, counts: np.ndarray) -> ToxicityModel:
    bias = log(max(share, 1e-9) / max(1 - share, 1e-9))
    return ToxicityModel(counts, np.zeros(DIMS + 1, dtype=np.float32), bias, 1.0, 0.0)


def sampled_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, toxic, text): one row for each chosen (id, toxic), however many rows of docs share the id."""
    rows = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("id"))
    return rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """docs (doc_id, text), labels (doc_id, toxic); learns from rows that held_out() leaves."""
    spark = docs.sparkSession
    counts = corpus_counts(docs)
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumnRenamed("doc_id", "id")
    chosen = F.broadcast(sample_of(known, sample_rows))  # about sample_rows pairs
    shared, name = spark.sparkContext.broadcast(counts), uuid.uuid4().hex

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def featured(texts: pd.Series) -> pd.Series:
        features = held(("toxicity-features", name), lambda: Features(CharModel(shared.value)))
        return pd.Series([np.array(sorted(features.of_text(t)), dtype=np.int32) for t in texts])

    rows = sampled_texts(docs, chosen).select("doc_id", "toxic", featured("text").alias("f")).toArrow().to_pandas()
    rows = rows.sort_values("doc_id", kind="stable")
    y = (rows["toxic"].to_numpy() > 0).astype(np.int64)
    if not len(y) or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.0, counts)
    seen = np.bincount(np.concatenate([*rows["f"]]).astype(np.int64), minlength=DIMS + 1)
    sets = [np.append(f[seen[f] > 1].astype(np.int64), DIMS) for f in rows["f"]]
    rng = np.random.default_rng(0)
    order = rng.permutation(len(y))
    back, front = order[: len(order) // 5], order[len(order) // 5 :]
    model = Ftrl()
    for _ in range(EPOCHS):
        for k in rng.permutation(front):
            model.learn(sets[k], y[k])
    w = model.weights(slice(None))
    logits = np.array([w[sets[k]].sum() for k in back])
    slope, offset = platt(logits, y[back])
    bias, w[DIMS] = float(w[DIMS]), 0
    return ToxicityModel(counts, w.astype(np.float32), bias, slope, offset)


def scorer(spark: SparkSession, model: ToxicityModel):
    """Column function text -> double; the model is of fixed size."""
    shared, name = spark.sparkContext.broadcast(model.parts), uuid.uuid4().hex

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        use = held(("toxicity", name), lambda: ToxicityModel(*shared.value))
        return pd.Series([use.score(t) for t in texts], dtype="float64")

    return score


def scored(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Column:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    return scorer(spark, model)("text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored(spark, docs, sf_dir).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline form: documents with a score of THRESHOLD or more go."""
    names = docs.columns
    return docs.withColumn("__tx_score", scored(spark, docs, sf_dir)).filter(F.col("__tx_score") < THRESHOLD).select(*names)

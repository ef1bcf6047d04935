"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features: hashed n-grams of 1 to 3 characters of the lowered text (case folded by str.lower,
runs of characters that are not letters become one space), weight (1 + ln tf) * idf, scaled to
unit length.  idf = ln((1 + N) / (1 + df)) + 1, with df counted over *all* training documents.

Fit: follow-the-regularised-leader with per-coordinate rates and elastic-net penalties, for
``EPOCHS`` passes over about ``SAMPLE_ROWS`` training rows (drawn by hash of the id; a documented
bound; their texts are read whole, their features counted on the executors).  One fifth of them is
kept back to calibrate: a single temperature divides the logits so that their log loss is least.

Null or empty text, or one without a letter, is ``und`` with score 0.  Rows with a null lang teach
nothing.  Without any training row every text is ``und``.  Every other column is ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm.sampling import sample_of

DIMS = 1 << 16
SAMPLE_ROWS = 2000
#: Characters counted at a time: working memory for very long texts.
STEP = 1 << 22
EPOCHS = 3
BATCH = 16
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
MULTIPLIERS = (np.uint32(1), np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B))


def _mapping() -> np.ndarray:
    """Lowered code point of every code point of the basic plane; 32 for what is not a letter."""
    table = np.full(0x10000, 32, dtype=np.uint32)
    for point in range(0x10000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low[0])
    return table


_table: np.ndarray | None = None


def letters_of(text: str | None) -> np.ndarray:
    """Lowered code points with one space for each run of other characters, space at both ends."""
    global _table
    if _table is None:
        _table = _mapping()
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    wide = points > 0xFFFF
    if wide.any():  # beyond the basic plane: letters stand for themselves
        low = _table[np.where(wide, 32, points)]
        for at in np.flatnonzero(wide):
            if chr(points[at]).isalpha():
                low[at] = points[at]
    else:
        low = _table[points]
    low = np.concatenate(([32], low, [32])).astype(np.uint32)
    keep = np.concatenate(([True], (low[1:] != 32) | (low[:-1] != 32)))
    return low[keep]


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and counts of one text; none if it has no letter."""
    points = letters_of(text)
    if len(points) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    counts: np.ndarray | None = None
    for at in range(0, len(points), STEP):
        part = points[at : at + STEP + 2]
        hashes = []
        rolled = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, 4):
            if len(part) < n:
                break
            rolled = rolled[: len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1 :] * MULTIPLIERS[n - 1] + np.uint32(n)
            mixed = rolled * np.uint32(0xC2B2AE35)
            hashes.append(((mixed ^ (mixed >> np.uint32(15))) & np.uint32(DIMS - 1))[:STEP])
        found = np.bincount(np.concatenate(hashes), minlength=DIMS)
        counts = found if counts is None else counts + found
    at = np.flatnonzero(counts)
    return at, counts[at]


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf
    norm = np.sqrt((values**2).sum())
    return values / norm if norm else values


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class FtrlSoftmax:
    """Multinomial logistic regression by FTRL-proximal; weights are a closed form of (z, n)."""

    def __init__(self, dims: int, classes: int):
        self.z = np.zeros((dims, classes))
        self.n = np.zeros((dims, classes))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
        """One step on a small batch."""
        at = np.unique(np.concatenate([a for a, _ in rows]))
        w = self.weights(at)
        gradient = np.zeros_like(w)
        for (a, v), label in zip(rows, labels, strict=True):
            local = np.searchsorted(at, a)
            p = softmax(v @ w[local])
            p[label] -= 1
            gradient[local] += np.outer(v, p)
        sigma = (np.sqrt(self.n[at] + gradient**2) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += gradient - sigma * w
        self.n[at] += gradient**2


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean())

    low, high, gold = np.log(0.02), np.log(20), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - gold * (high - low), low + gold * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


class LanguageModel:
    def __init__(self, classes: list[str], weights: np.ndarray, idf: np.ndarray, heat: float):
        self.classes, self.weights, self.idf, self.heat = classes, weights, idf, heat

    def predict(self, text: str | None) -> tuple[str, float]:
        at, counts = term_counts(text)
        if not len(at) or not self.classes:
            return "und", 0.0
        p = softmax(weigh(counts, self.idf[at]) @ self.weights[at] / self.heat)
        best = int(p.argmax())
        return self.classes[best], float(p[best])


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """(rows, df of each feature) over all texts of docs: per-partition vectors, summed by feature."""

    def count(batches):
        n, df = 0, np.zeros(DIMS, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                if text is None:
                    continue
                at, _ = term_counts(text)
                n += 1
                df[at] += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"term": np.append(at, -1), "df": np.append(df[at], n)})

    parts = docs.select("text").mapInPandas(count, "term int, df long")
    # At most DIMS + 1 rows reach the driver, whatever the corpus.
    rows = parts.groupBy("term").agg(F.sum("df").alias("df")).toArrow().to_pandas()
    df = np.zeros(DIMS)
    total = int(rows.loc[rows["term"] < 0, "df"].sum())
    seen = rows[rows["term"] >= 0]
    df[seen["term"].to_numpy()] = seen["df"].to_numpy()
    return total, df


COUNTED = T.StructType([T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("at", "counts")])


@F.pandas_udf(COUNTED)
def counted(texts: pd.Series) -> pd.DataFrame:
    found = [term_counts(t) for t in texts]
    return pd.DataFrame(
        {"at": [a.astype(np.int32) for a, _ in found], "counts": [c.astype(np.int32) for _, c in found]}
    )


def fit(train: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit on rows (id, text, lang) with text and lang not null."""
    train = train.filter("lang IS NOT NULL")
    total, df = document_frequencies(train)
    idf = np.log((1 + total) / (1 + df)) + 1
    picked = sample_of(train, sample_rows).select("lang", counted("text").alias("c")).select("lang", "c.*").toArrow().to_pandas()
    classes = sorted(picked["lang"].unique().tolist())
    rows, labels = [], []
    for lang, at, counts in zip(picked["lang"], picked["at"], picked["counts"], strict=True):
        if len(at):
            rows.append((at.astype(np.int64), weigh(counts, idf[at])))
            labels.append(classes.index(lang))
    labels = np.array(labels, dtype=np.int64)
    if not len(rows):
        return LanguageModel([], np.zeros((DIMS, 0), dtype=np.float32), idf, 1.0)
    model = FtrlSoftmax(DIMS, len(classes))
    back = np.arange(len(rows)) % 5 == 4
    fitted = np.flatnonzero(~back)
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        order = rng.permutation(fitted)
        for k in range(0, len(order), BATCH):
            part = order[k : k + BATCH]
            model.learn([rows[i] for i in part], labels[part])
    weights = model.weights()
    kept = np.flatnonzero(back)
    logits = np.array([rows[i][1] @ weights[rows[i][0]] for i in kept]).reshape(len(kept), len(classes))
    heat = temperature(logits, labels[kept])
    return LanguageModel(classes, weights.astype(np.float32), idf, heat)


def predictor(spark: SparkSession, model: LanguageModel):
    """Column function text -> struct(lang_pred, score); the model is of fixed size (DIMS x classes)."""
    shared = spark.sparkContext.broadcast((model.classes, model.weights, model.idf, model.heat))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        use = LanguageModel(*shared.value)
        return pd.DataFrame([use.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    train = docs.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), "text", "lang")
    predict = predictor(spark, fit(train))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p"))
    return scored.select("doc_id", "held_out", "p.lang_pred", "p.score")

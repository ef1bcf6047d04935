"""Secret scans: base patterns plus a character convolutional network over candidates.

Base spans (leftmost, not overlapping within a kind, ASCII letters in either case for the keywords):
``assign`` a keyword, ``:`` or ``=``, and a value of 12 characters or more; ``access`` a key id of 18
or more; ``hex`` 16 hexadecimal digits or more.  They always stay.

Candidates are runs of 12 to ``WIDTH`` token characters with a digit and a letter, and the values of
base spans.  The network sees the candidate and ``CONTEXT`` characters on either side: character
embeddings, one convolution, maximum and mean pooling, and a logistic output, in numpy.  It is
trained on labelled findings: the values of ``assign`` and ``access`` spans in a bounded sample of
texts are secrets, each with a copy of another keyword, quote and alphabet so that the network does
not merely learn the patterns; other candidates, long words and numbers are none.  A held-back fifth calibrates the scores (Platt) and sets the threshold: one that finds ``RECALL`` of the
held-back secrets and as few others as any such threshold can.  Candidates that reach it and overlap no
base span are added as ``model`` spans.  Longer runs are cut into windows of ``WIDTH`` characters,
and the best window decides.

Null text is empty text: no spans.  Offsets are code points, the end exclusive.  Repeated rows give
repeated results; other columns are ignored.  Without any secret to learn from, nothing is added.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm.sampling import sample_of
from larkspur.llm.toxicity import platt

# The base patterns.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(?P<value>[A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "model")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")

WIDTH, CONTEXT = 64, 24
EMBED, FILTERS, KERNEL = 16, 32, 5
#: About so many texts are read (whole) for training, drawn by hash of the id.
SAMPLE_TEXTS = 12_000
#: At most so many labelled findings of a class are kept of each sampled text; of texts without a
#: secret, only one in PLAIN_SHARE teaches what is none.
PER_TEXT, PLAIN_SHARE = 4, 8
#: Passes over the findings; more of them if there are few, for LEAST_STEPS steps.
EPOCHS, LEAST_STEPS, BATCH, RATE = 6, 600, 64, 3e-3
RECALL = 0.98
ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-.\"':;, \n"
ALPHABETS = (string.ascii_letters + string.digits, string.ascii_uppercase + string.digits, string.hexdigits, string.ascii_letters + string.digits + "+/")
COPIES = 3
VARIANTS = ("", "client_secret: ", "auth=", 'key = "', "credential='", "bearer ", "pwd: ")
LOOKUP = {c: k + 2 for k, c in enumerate(ALPHABET)}  # 0 outside the text, 1 any other character


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans in order."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m["value"]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs that may be secrets: with a digit and a letter."""
    out = []
    for m in CANDIDATE.finditer(text):
        run = m.group()
        if not run.isalpha() and not run.isdigit() and any(map(str.isdigit, run)) and any(map(str.isalpha, run)):
            out.append(m.span())
    return out


def window(text: str, start: int, end: int) -> list[int]:
    """Codes of one candidate with its context, of fixed length; the candidate starts at CONTEXT."""
    end = min(end, start + WIDTH)
    left = text[max(0, start - CONTEXT) : start]
    right = text[end : end + CONTEXT]
    codes = [0] * (CONTEXT - len(left)) + [LOOKUP.get(c, 1) for c in left + text[start:end] + right]
    return codes + [0] * (2 * CONTEXT + WIDTH - len(codes))


def windows_of(text: str, start: int, end: int) -> list[list[int]]:
    return [window(text, at, min(end, at + WIDTH)) for at in range(start, end, WIDTH)]


class CharCnn:
    """Embedding, one convolution, two poolings, logistic output; gradients by hand, steps by Adam."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        size = len(ALPHABET) + 2
        self.p = {
            "e": rng.normal(0, 0.3, (size, EMBED)).astype(np.float32),
            "w": rng.normal(0, (2 / (KERNEL * EMBED)) ** 0.5, (KERNEL * EMBED, FILTERS)).astype(np.float32),
            "b": np.zeros(FILTERS, dtype=np.float32),
            "o": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            "c": np.zeros(1, dtype=np.float32),
        }
        self.p["e"][0] = 0
        self._m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self._v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self._steps = 0

    def _forward(self, codes: np.ndarray):
        p = self.p
        x = p["e"][codes]
        n, length, _ = x.shape
        out = length - KERNEL + 1
        strips = np.stack([x[:, k : k + out] for k in range(KERNEL)], axis=2).reshape(n, out, KERNEL * EMBED)
        h = strips @ p["w"] + p["b"]
        a = np.maximum(h, 0)
        top = a.argmax(axis=1)
        pooled = np.concatenate((np.take_along_axis(a, top[:, None], axis=1)[:, 0], a.mean(axis=1)), axis=1)
        return pooled @ p["o"] + p["c"][0], strips, h, top, pooled

    def logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [self._forward(codes[k : k + 256])[0] for k in range(0, len(codes), 256)]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.float32)

    def learn(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        p = self.p
        z, strips, h, top, pooled = self._forward(codes)
        n, out, _ = h.shape
        d = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * weights / weights.sum()).astype(np.float32)
        g = {"o": pooled.T @ d, "c": np.array([d.sum()], dtype=np.float32)}
        back = np.broadcast_to((d[:, None] * p["o"][FILTERS:] / out)[:, None, :], h.shape).copy()
        rows, cols = np.arange(n)[:, None], np.arange(FILTERS)[None, :]
        back[rows, top, cols] += d[:, None] * p["o"][:FILTERS]
        back *= h > 0
        flat = back.reshape(-1, FILTERS)
        g["w"] = strips.reshape(-1, KERNEL * EMBED).T @ flat
        g["b"] = flat.sum(axis=0)
        dx = (flat @ p["w"].T).reshape(n, out, KERNEL, EMBED)
        g["e"] = np.zeros_like(p["e"])
        for k in range(KERNEL):
            np.add.at(g["e"], codes[:, k : k + out].ravel(), dx[:, :, k].reshape(-1, EMBED))
        g["e"][0] = 0
        self._steps += 1
        for k, grad in g.items():
            self._m[k] = 0.9 * self._m[k] + 0.1 * grad
            self._v[k] = 0.999 * self._v[k] + 0.001 * grad * grad
            m, v = self._m[k] / (1 - 0.9**self._steps), self._v[k] / (1 - 0.999**self._steps)
            p[k] -= RATE * m / (np.sqrt(v) + 1e-8)


class SecretModel:
    def __init__(self, parameters: dict | None, slope: float = 1.0, offset: float = 0.0, threshold: float = 1.0):
        self.parts = parameters, slope, offset, threshold
        self.slope, self.offset, self.threshold = slope, offset, threshold
        self.net = None
        if parameters:
            self.net = CharCnn()
            self.net.p = parameters

    def scores(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.net.logits(codes) + self.offset, -30, 30)))

    def scan(self, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
        """All spans (start, kind, end) of each text, in order."""
        out, waiting, codes, where = [], [], [], []
        for text in texts:
            text = text or ""
            found = base_spans(text)
            out.append(found)
            if self.net is None:
                continue
            for start, end in candidates(text):
                if any(s < end and start < e for s, _, e in found):
                    continue
                rows = windows_of(text, start, end)
                where.extend([len(waiting)] * len(rows))
                waiting.append((len(out) - 1, start, end))
                codes.extend(rows)
        if codes:
            best = np.zeros(len(waiting))
            np.maximum.at(best, where, self.scores(np.array(codes)))
            for (row, start, end), score in zip(waiting, best.tolist(), strict=True):
                if score >= self.threshold:
                    out[row] = sorted([*out[row], (start, 3, end)])
        return out


FINDING = T.ArrayType(
    T.StructType([T.StructField("label", T.IntegerType()), T.StructField("codes", T.ArrayType(T.IntegerType()))])
)


def findings(text: str | None) -> list[tuple[int, list[int]]]:
    """Labelled windows of one text, with varied copies of the secrets."""
    text = text or ""
    spans = base_spans(text)
    seed = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    secrets = [s for s in spans if s[1] < 2][:PER_TEXT]
    if not secrets and seed % PLAIN_SHARE:
        return []
    rng = np.random.default_rng(seed)
    out = []
    for start, kind, end in secrets:
        value = ASSIGN.match(text, start)["value"] if kind == 0 else text[start:end]
        at = end - len(value)
        out.append((1, window(text, at, end)))
        for _ in range(COPIES):
            letters = ALPHABETS[rng.integers(len(ALPHABETS))]
            mixed = "".join(rng.choice(list(letters), int(rng.integers(16, 44))))
            lead, tail = text[max(0, at - CONTEXT) : at], text[end : end + CONTEXT]
            if rng.random() < 0.7:  # somewhere else in the same text
                place = int(rng.integers(len(text)))
                lead, tail = text[max(0, place - CONTEXT) : place].rstrip() + " ", " " + text[place : place + CONTEXT].lstrip()
            lead += str(rng.choice(VARIANTS))
            out.append((1, window(lead + mixed + tail, len(lead), len(lead) + len(mixed))))
    plain = [(m.start(), m.end()) for m in re.finditer(r"\S{12,}", text)]
    clear = [s for s in plain if not any(a < s[1] and s[0] < b for a, _, b in spans)]
    other = [s for s in candidates(text) if not any(a < s[1] and s[0] < b for a, _, b in spans)]
    for group in (clear, other):
        for k in rng.permutation(len(group))[:PER_TEXT]:
            out.append((0, window(text, *group[k])))
    numbers = [m.span() for m in re.finditer(r"[0-9]{12,}", text)]
    out += [(0, window(text, *s)) for s in numbers[:PER_TEXT]]
    return out


@F.pandas_udf(FINDING)
def findings_udf(texts: pd.Series) -> pd.Series:
    return pd.Series([findings(t) for t in texts])


def fit(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> SecretModel:
    """docs (id, text)."""
    sample = sample_of(docs, sample_texts)
    picked = sample.select("id", F.explode(findings_udf("text")).alias("f")).select("id", "f.label", "f.codes")
    table = picked.toArrow().to_pandas().sort_values(["id", "label"], kind="stable")
    y = table["label"].to_numpy(dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return SecretModel(None)
    x = np.stack(table["codes"].to_numpy()).astype(np.int64)
    rng = np.random.default_rng(0)
    order = rng.permutation(len(y))
    back, front = order[: len(order) // 5], order[len(order) // 5 :]
    weight = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0).astype(np.float32)
    net = CharCnn()
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // max(1, len(front))))):
        shuffled = rng.permutation(front)
        for k in range(0, len(shuffled), BATCH):
            some = shuffled[k : k + BATCH]
            net.learn(x[some], y[some], weight[some])
    logits = net.logits(x[back]).astype(np.float64)
    slope, offset = platt(logits, y[back].astype(np.int64))
    p = 1 / (1 + np.exp(-np.clip(slope * logits + offset, -30, 30)))
    return SecretModel(net.p, slope, offset, threshold_of(p[y[back] == 1], p[y[back] == 0]))


def threshold_of(positive: np.ndarray, negative: np.ndarray, recall: float = RECALL) -> float:
    """Half way between the score that recall demands and the best negative below it."""
    if not len(positive):
        return 1.0
    top = float(np.sort(positive)[int((1 - recall) * len(positive))])
    below = negative[negative < top]
    return (top + float(below.max())) / 2 if len(below) else top / 2


RESULT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex")]
    + [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans")]
)


def scanner(spark: SparkSession, model: SecretModel):
    """Column function text -> struct of counts, digest of the base spans, and all spans."""
    shared = spark.sparkContext.broadcast(model.parts)

    @F.pandas_udf(RESULT)
    def scan(texts: pd.Series) -> pd.DataFrame:
        use, rows = SecretModel(*shared.value), []
        for spans in use.scan(texts.tolist()):
            told = [(k, f"{KINDS[k]}:{s}:{e}") for s, k, e in spans]
            base = ",".join(t for k, t in told if k < 3)
            counts = [sum(k == n for k, _ in told) for n in range(3)]
            rows.append((*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(t for _, t in told)))
        return pd.DataFrame(rows, columns=RESULT.names)

    return scan


def scanned(spark: SparkSession, docs: DataFrame) -> Column:
    return scanner(spark, fit(docs.select(F.col("doc_id").alias("id"), "text")))("text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs.select("doc_id", scanned(spark, docs).alias("s")).select("doc_id", "s.*")

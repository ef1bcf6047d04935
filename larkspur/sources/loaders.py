"""Table loaders by file kind, and discovery of train, test and submission files.

Files are read by Spark, so any path that Spark knows works, on a cluster too.
"""

from __future__ import annotations

import io
import json
import os
import zipfile
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.tabular import draw

KINDS = {".csv": "csv", ".parquet": "parquet", ".pq": "parquet", ".json": "json", ".jsonl": "jsonl", ".ndjson": "jsonl", ".zip": "zip"}


def _bytes(spark: SparkSession, path: str) -> bytes:
    """The bytes of one small file (an archive or a JSON document), through Spark."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first().content)


def load_csv(spark: SparkSession, path: str, infer: bool = True) -> DataFrame:
    """UTF-8, or Latin-1 if any line is not valid UTF-8."""
    raw = spark.read.format("text").load(path)
    bad = raw.filter(~F.is_valid_utf8("value")).limit(1).collect()
    options = {"header": True, "inferSchema": infer, "quote": '"', "escape": '"', "multiLine": True}
    return spark.read.csv(path, encoding="ISO-8859-1" if bad else "UTF-8", **options)


def load_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def load_json(spark: SparkSession, path: str) -> DataFrame:
    """A top-level list of objects, or one object (of columns or a single row)."""
    document = json.loads(_bytes(spark, path))
    if isinstance(document, dict) and document and all(isinstance(v, list) for v in document.values()):
        names = list(document)
        document = [dict(zip(names, row, strict=True)) for row in zip(*document.values(), strict=True)]
    rows = document if isinstance(document, list) else [document]
    return spark.read.json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))


def load_jsonl(spark: SparkSession, path: str, max_lines: int | None = None) -> DataFrame:
    """One object for each line; a bad line raises.  max_lines counts blank lines too."""
    reader = spark.read.option("mode", "FAILFAST")
    if max_lines is None:
        return reader.json(path)
    lines = spark.read.text(path).limit(max_lines).filter(F.trim("value") != "")
    return reader.json(lines.rdd.map(lambda r: r.value))


def load_zip(spark: SparkSession, path: str, member: str | None = None) -> DataFrame:
    """One member (the first unless named) of an archive: CSV, Parquet, JSON or JSON lines."""
    import pandas as pd

    with zipfile.ZipFile(io.BytesIO(_bytes(spark, path))) as archive:
        names = [n for n in archive.namelist() if not n.endswith("/")]
        if not names or member and member not in names:
            raise ValueError(f"{path} has no {member or 'files'}")
        name = member or names[0]
        content, kind = archive.read(name), KINDS.get(PurePosixPath(name).suffix.lower())
    readers = {
        "csv": lambda b: pd.read_csv(io.BytesIO(b)),
        "parquet": lambda b: pd.read_parquet(io.BytesIO(b)),
        "json": lambda b: pd.read_json(io.BytesIO(b)),
        "jsonl": lambda b: pd.read_json(io.BytesIO(b), lines=True),
    }
    if kind not in readers:
        raise ValueError(f"{name} is of no known kind")
    return spark.createDataFrame(readers[kind](content))


def load_data(spark: SparkSession, path: str) -> DataFrame:
    """By suffix; TSV is not among the kinds."""
    kind = KINDS.get(PurePosixPath(path).suffix.lower())
    if kind is None:
        raise ValueError(f"unsupported file kind: {path}")
    readers = {"csv": load_csv, "parquet": load_parquet, "json": load_json, "jsonl": load_jsonl, "zip": load_zip}
    return readers[kind](spark, path)


def sample_rows(rows: DataFrame, n: int, row_id: str, seed: int = 42, mode: str = "debug") -> DataFrame:
    """n rows by hash order; all of them if mode is final."""
    if mode == "final":
        return rows
    return rows.orderBy(draw(seed, row_id), row_id).limit(n)


# Words in file names.
TRAIN_WORDS = ("train", "training", "trn")
TEST_WORDS = ("test", "testing", "tst", "sample_submission")
VALID_WORDS = ("val", "valid", "validation", "eval")


def file_scores(name: str, size: int, largest: int) -> dict[str, float]:
    """How like a train, test or submission file it is, by name and size."""
    low, share = os.path.splitext(name)[0].lower(), size / max(largest, 1)
    train = float(any(w in low for w in TRAIN_WORDS))
    test = float(any(w in low for w in TEST_WORDS))
    sub = 0.0
    if any(w in low for w in VALID_WORDS):
        train, test = train + 0.3, test + 0.3
    if "submission" in low:
        sub, train, test = sub + 1, train - 1, test - 0.5
    if "sample" in low:
        sub, train = sub + 0.5, train - 0.5
    return {"train": round(train + 0.4 * share, 3), "test": round(test + 0.2 * (1 - share), 3), "submission": round(sub, 3)}


def discover_files(folder: str) -> dict[str, list[str]]:
    """The best two files for train, test and submission below a local folder; a test file is never the train file."""
    found = []
    for base, _, names in os.walk(folder):
        found += [(os.path.join(base, n), n) for n in names if os.path.splitext(n)[1].lower() in KINDS]
    sizes = {p: os.path.getsize(p) for p, _ in found}
    largest = max(sizes.values(), default=0)
    scores = {p: file_scores(n, sizes[p], largest) for p, n in found}

    def best(kind: str, without: str | None = None) -> list[str]:
        ranked = sorted((p for p in scores if p != without and scores[p][kind] > 0), key=lambda p: (-scores[p][kind], p))
        return ranked[:2]

    train = best("train")
    return {"train": train, "test": best("test", train[0] if train else None), "submission": best("submission")}


def discover_file(name: str, roots: list[str]) -> str | None:
    """The shortest path of that name below any root."""
    hits = [os.path.join(b, name) for r in roots for b, _, names in os.walk(r) if name in names]
    return min(hits, key=lambda p: (len(p), p), default=None)

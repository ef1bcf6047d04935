"""Experiment ledgers as CSV tables that Spark reads and appends to, and small text reports."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The ledgers' columns.
EXPERIMENT_FIELDS = (
    "experiment_id", "timestamp", "hypothesis", "task", "feature_version", "split_version", "model", "params", "cv_mean", "cv_std",
    "runtime_seconds", "memory_mb", "notes", "decision",
)
LINKAGE_FIELDS = (
    "experiment_id", "timestamp", "git_commit", "blocking_version", "feature_version", "model_version", "threshold", "candidate_recall",
    "candidate_count", "entity_f05", "precision", "recall", "n_entities", "n_singletons", "false_merges", "missed_matches", "runtime_sec",
    "memory_mb", "observations",
)
SUBMISSION_FIELDS = (
    "submission_id", "timestamp", "experiment_id", "blocking_version", "feature_version", "model_version", "threshold", "validation_f05",
    "public_score", "n_entities", "n_singletons", "total_matches", "submission_number", "observations",
)
DAILY_SUBMISSIONS = 5


class Ledger:
    """An append-only CSV folder with fixed columns."""

    def __init__(self, spark: SparkSession, path: str, fields: tuple[str, ...]):
        self.spark, self.path, self.fields = spark, path, fields

    @property
    def schema(self) -> str:
        return ", ".join(f"`{f}` string" for f in self.fields)

    def log(self, **values) -> str:
        unknown = set(values) - set(self.fields)
        if unknown:
            raise ValueError(f"unknown fields: {sorted(unknown)}")
        key = self.fields[0]
        row = {key: f"{key[0].upper()}-{uuid.uuid4().hex[:12]}", "timestamp": datetime.now(timezone.utc).isoformat(timespec="seconds")} | values
        text = [None if row.get(f) is None else row[f] if isinstance(row[f], str) else json.dumps(row[f]) for f in self.fields]
        self.spark.createDataFrame([tuple(text)], self.schema).coalesce(1).write.mode("append").csv(self.path, header=True, quoteAll=True, escape='"')
        return row[key]

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).csv(self.path, header=True, escape='"', multiLine=True)

    def best(self, column: str, greater_is_better: bool, where: str = "true") -> dict | None:
        """The row of the best value; ties by id."""
        rows = self.read().filter(where).withColumn("__v", F.col(column).try_cast("double")).filter("__v IS NOT NULL")
        first = rows.orderBy(F.desc("__v") if greater_is_better else F.asc("__v"), self.fields[0]).drop("__v").first()
        return None if first is None else first.asDict()

    def table(self, column: str, greater_is_better: bool) -> DataFrame:
        value = F.col(column).try_cast("double")
        return self.read().orderBy(value.desc_nulls_last() if greater_is_better else value.asc_nulls_last(), self.fields[0])

    def count_on(self, day: str) -> int:
        return self.read().filter(F.col("timestamp").startswith(day)).count()


def can_submit(ledger: Ledger, day: str | None = None, most: int = DAILY_SUBMISSIONS) -> bool:
    return ledger.count_on(day or datetime.now(timezone.utc).date().isoformat()) < most


def markdown(rows: DataFrame, most: int = 50) -> str:
    """The first rows as a Markdown table."""
    lines = ["| " + " | ".join(rows.columns) + " |", "|" + " --- |" * len(rows.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows.limit(most).collect()]
    return "\n".join(lines)

"""Record linkage over a stream of first-source records joined to static targets.

Ranking within a record is not allowed on a stream, so each micro-batch is linked as a batch;
results carry the batch id and are written to a folder of that id, so a batch that is run again
replaces its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import pairs
from larkspur.operators.blocking import generate, strong, together
from larkspur.sources.records import normalised


def link(ref: DataFrame, targets: DataFrame, blockers: list[str], threshold: float) -> DataFrame:
    """Matches (s1_id, candidate_id, score) of normalised records."""
    if together(blockers):  # without a second threshold, every pair that reaches the first one is kept
        return strong(ref, targets, blockers, pairs.rule_floor(threshold)).filter(F.col("score") >= threshold)
    found = generate(ref, targets, blockers)
    records = ref.unionByName(targets)
    scored = pairs.rule_score(pairs.pair_features(found.frame.select("s1_id", "candidate_id", "blockers"), records))
    return pairs.resolve(scored, threshold).select("s1_id", "candidate_id", "score")


def link_stream(stream: DataFrame, targets: DataFrame, out: str, checkpoint: str, blockers: list[str], threshold: float = 0.5, each: Callable[[DataFrame, int], None] | None = None):
    """Start a query that links every micro-batch of raw records and writes Parquet to out/batch=<id>."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        matches = link(normalised(batch, 1), targets, blockers, threshold)
        matches.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if each:
            each(matches, batch_id)

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_stream(spark: SparkSession, path: str, schema, file_format: str = "parquet", files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", files_per_batch).load(path)

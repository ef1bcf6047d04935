"""Line deduplication with levelled sorted runs of line hashes (DataFrame functions only).

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z lowered.
Documents arrive in batches of descending id.  Each batch is reduced to one sorted run of
(hash, documents, largest id); before it is added, it is merge-anti-joined with the keys that the
older runs already settle, so a settled key is never stored again.  When a level holds ``fanout``
runs they are merged into one run of the next level.  The first run that holds a key also holds
its largest document, so the finished runs say which lines go.

Keys are 128 bits (two XXH64 of different seeds).  Rows count as documents of their own; rows that
share id and text share one fate.  Null or empty text is one empty line; a null id ranks below
every other id.  Other columns are neither read nor changed, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.storage import materialize, remove, scratch

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


class LineRuns:
    """Levelled sorted runs of (h1, h2, n_docs, owner) in shared storage."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[tuple[str, DataFrame]]] = []

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        if len(runs) == 1:
            return runs[0]
        both = runs[0]
        for run in runs[1:]:
            both = both.union(run)
        return both.groupBy(*HASH).agg(F.sum("n_docs").alias("n_docs"), F.max("owner").alias("owner"))

    def _write(self, df: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        path = scratch(self.spark, f"line-run-{level}")
        self.levels[level].append((path, materialize(df.sortWithinPartitions(*HASH), path)))

    def all(self) -> DataFrame:
        """Every key once, with its documents (exact up to min_docs) and its largest id."""
        return self._merged([run for level in self.levels for _, run in level])

    def settled(self) -> DataFrame:
        return self.all().filter(F.col("n_docs") >= self.min_docs)

    def add(self, counts: DataFrame) -> None:
        """Merge-anti-join one batch's (h1, h2, n_docs, owner) with the runs, then add its own run."""
        if any(self.levels):
            counts = counts.join(self.settled().select(*HASH).hint("merge"), HASH, "left_anti")
        self._write(counts, 0)
        self._compact()

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._write(self._merged([run for _, run in runs]), level + 1)
            for path, _ in runs:
                remove(self.spark, path)
            level += 1


def _batch_of(ids: Column, bounds: list) -> Column:
    """0 for the largest ids, then on downwards; null ids come last."""
    out = F.lit(0)
    for bound in bounds:
        out = out + F.when(ids >= F.lit(bound), 0).otherwise(1)
    return out


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, batches: int = 4
) -> DataFrame:
    """(id, text_hash, dropped): positions of the lines that go, for each document that loses any."""
    spark = docs.sparkSession
    text = F.col(text_col)
    bounds = docs.agg(
        F.percentile_approx(F.col(id_col), [1 - k / batches for k in range(1, batches)], 1000)
    ).first()[0]
    bounds = sorted(set(bounds or []), reverse=True)
    lines = (
        docs.select(
            F.col(id_col).alias("id"),
            F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
            F.posexplode(text_lines(text)).alias("pos", "line"),
        )
        .select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
        .filter(F.length("key") >= min_chars)
        .select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    held = (
        lines.groupBy(*HASH, "id", "text_hash")
        .agg(F.collect_list("pos").alias("positions"))
        .withColumn("batch", _batch_of(F.col("id"), bounds))
    )
    held_path = scratch(spark, "line-index")
    held = materialize(held, held_path, ["batch"])
    # A repeated (id, text) row is a document too: its copies add one position list each in the
    # same group, so count the copies instead of the groups.
    copies = F.expr("aggregate(transform(positions, p -> CASE WHEN p = positions[0] THEN 1 ELSE 0 END), 0, (a, x) -> a + x)")
    runs = LineRuns(spark, min_docs)
    for batch in range(len(bounds) + 1):
        runs.add(
            held.filter(F.col("batch") == batch)
            .groupBy(*HASH)
            .agg(F.sum(copies).alias("n_docs"), F.max("id").alias("owner"))
        )
    verdict = runs.settled()
    lost = (F.col("id") < F.col("owner")) | (F.col("id").isNull() & F.col("owner").isNotNull())
    return (
        held.join(verdict, HASH)
        .filter(lost)
        .groupBy("id", "text_hash")
        .agg(F.array_distinct(F.flatten(F.collect_list("positions"))).alias("dropped"))
    )


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    out_col: str = "line_dedup",
) -> DataFrame:
    """docs plus ``kept_text``, ``n_lines`` and ``n_dropped`` in one struct column ``out_col``, in place of one so named."""
    drops = repeated_lines(docs, id_col, text_col, min_chars, min_docs, batches).select(
        F.col("id").alias("__ld_id"), F.col("text_hash").alias("__ld_hash"), F.col("dropped").alias("__ld_dropped")
    )
    names = docs.columns
    left = docs.withColumn("__ld_text_hash", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    joined = left.join(
        drops, (F.col("__ld_text_hash") == F.col("__ld_hash")) & F.col(id_col).eqNullSafe(F.col("__ld_id")), "left"
    )
    lines = text_lines(F.col(text_col))
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("__ld_lines") - 1), F.col("__ld_dropped")),
        lambda i: F.col("__ld_lines")[i],
    )
    none = F.col("__ld_dropped").isNull()
    return joined.withColumn("__ld_lines", lines).select(
        *[F.col(n) for n in names if n != out_col],
        F.struct(
            F.when(none, F.coalesce(F.col(text_col), F.lit(""))).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
            F.size("__ld_lines").cast("long").alias("n_lines"),
            F.when(none, 0).otherwise(F.size("__ld_dropped")).cast("long").alias("n_dropped"),
        ).alias(out_col),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = dedup_lines(docs)
    return found.select(
        "doc_id",
        F.col("line_dedup.n_lines").alias("n_lines"),
        F.col("line_dedup.n_dropped").alias("n_dropped"),
        F.sha2(F.col("line_dedup.kept_text"), 256).alias("kept_sha256"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline form: the documents with the lines that stay, and n_chars to match."""
    names = docs.columns
    new = {"text": F.col("__ld_out.kept_text"), "n_chars": F.length("__ld_out.kept_text").cast("long")}
    changed = F.col("__ld_out.n_dropped") > 0
    return dedup_lines(docs, out_col="__ld_out").select(
        *[F.when(changed, new[n]).otherwise(F.col(n)).alias(n) if n in new else F.col(n) for n in names]
    )


ORACLE = """
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), settled AS (
  SELECT k, max(doc_id) AS owner FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT keyed.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE owner IS NOT NULL AND keyed.doc_id < owner) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (WHERE owner IS NULL OR keyed.doc_id >= owner), '')) AS kept_sha256
FROM keyed LEFT JOIN settled USING (k)
GROUP BY keyed.doc_id
"""

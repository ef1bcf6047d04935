"""The driver tables as record-linkage inputs: three sources of business records from documents.

source = 1 + doc_id % 3; the name is the first four words of the text, the address the next eight,
the country the language; two records match if their whole texts are equal.

Records are normalised once and kept (memory, then disk): the blockers, both record joins and the
evaluation of one query read the short columns again, not the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from larkspur.sources.records import normalised, production_records


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda t: t != "")
    source = (1 + F.col("doc_id") % 3).cast("string")
    return docs.select(
        F.concat(F.lit("S"), source, F.lit("-"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("entity_id"),
        F.array_join(F.slice(words, 1, 4), " ").alias("business_name"),
        F.array_join(F.slice(words, 5, 8), " ").alias("business_address"),
        F.col("lang").alias("country"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalised(raw_records(spark, sf_dir)).persist(StorageLevel.MEMORY_AND_DISK)


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rec = records(spark, sf_dir)
    return rec.filter("source = 1"), rec.filter("source > 1")


def production_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rec = production_records(raw_records(spark, sf_dir)).persist(StorageLevel.MEMORY_AND_DISK)
    return rec.filter("source = 1"), rec.filter("source > 1")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, truth array) for every first-source record; equal texts meet on their digest."""
    docs = table(spark, sf_dir, "documents")
    source = 1 + F.col("doc_id") % 3
    entity = F.concat(F.lit("S"), source.cast("string"), F.lit("-"), F.lpad(F.col("doc_id").cast("string"), 8, "0"))
    keyed = docs.select(source.alias("source"), entity.alias("entity_id"), F.sha2("text", 256).alias("digest"))
    a, b = keyed.filter("source = 1"), keyed.filter("source > 1")
    found = a.join(b.select("digest", F.col("entity_id").alias("t")), "digest", "left")
    return found.groupBy(F.col("entity_id").alias("s1_id")).agg(F.array_sort(F.collect_set("t")).alias("truth"))

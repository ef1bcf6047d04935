"""Shared scratch storage.

Lineage is cut by writing Parquet below the folder that the cluster names in
``spark.checkpoint.dir``; only where that is unset (tests, a laptop) a folder of
our own is made.  Nothing is ever kept in one executor's local folder.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="larkspur-")
        atexit.register(_remove_local, base)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def _remove_local(base: str) -> None:
    import shutil

    shutil.rmtree(base.removeprefix("file://"), ignore_errors=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/larkspur/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df as Parquet and read it back: the result no longer depends on lost executors."""
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through Spark's own filesystem layer."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

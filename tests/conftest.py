from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(frame):
    """Columns by name, values as text, rows sorted."""
    frame = frame[sorted(frame.columns)].copy()

    def text(v):
        if v is None or v != v:
            return "NULL"
        return repr(round(v, 9) + 0.0) if isinstance(v, float) else str(v)

    for column in frame.columns:
        frame[column] = frame[column].map(text)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def assert_same(spark_frame, duck_frame):
    got, want = canonical(spark_frame), canonical(duck_frame)
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    assert got.equals(want), got.compare(want).head()

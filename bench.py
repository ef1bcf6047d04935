"""Headline queries on one machine: prints one JSON line with the seconds of each."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from larkspur.plans.catalogue import QUERIES

HEADLINE = [
    "norm_name", "norm_address", "sim_jaro_winkler", "block_exact", "block_token", "block_rare", "block_address", "block_tfidf",
    "block_char_ngram", "block_union_provenance", "pair_features", "rule_score", "resolve_matches", "threshold_grid", "matching_results",
    "entity_f05", "blocking_metrics", "nb_evidence", "nb_resolve", "m_smape", "m_ranking", "m_class_scores", "text_structured",
    "numeric_features", "freq_count_encode", "target_encode", "target_encode_loo", "impute_scale", "quantile_clip", "tfidf_features",
    "column_profile", "split_timeseries", "oof_corr", "rank_avg", "validate_tabular",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    QUERIES["m_mae"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the session's code paths
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        spark.catalog.clearCache()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}))
    spark.stop()


if __name__ == "__main__":
    main()

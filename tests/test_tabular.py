from __future__ import annotations

import json
import math
import zipfile

import pytest
from pyspark.sql import functions as F

from larkspur.operators import audit, ensemble, metrics, models, splits, submission, tabular
from larkspur.sources import loaders


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(i, float(i % 7), "abc"[i % 3], float(i)) for i in range(60)], "id long, x double, c string, y double")


def test_metric_values(spark):
    def value(name, rows):
        return metrics.get_metric(name).run(spark.createDataFrame([tuple(map(float, r)) for r in rows], "t double, p double"), "t", "p").first()[0]

    assert value("smape", [(10, 20)]) == pytest.approx(66.667, abs=1e-3)
    assert value("mae", [(0, 1), (0, 3)]) == 2
    assert value("rmse", [(0, 1), (0, -1)]) == 1
    assert value("r2", [(1, 2), (2, 2), (3, 2)]) == pytest.approx(0)
    assert value("accuracy", [(1, 1), (0, 1)]) == 0.5
    assert value("roc_auc", [(1, 0.9), (0, 0.9), (0, 0.1), (1, 0.8)]) == pytest.approx(0.625)
    assert value("kappa", [(1, 1), (0, 0)]) == 1
    with pytest.raises(ValueError, match="unknown"):
        metrics.get_metric("auc")
    assert metrics.REGISTRY["rmse"].is_better(1, 2) and metrics.REGISTRY["r2"].best_of([1, 2]) == 2
    assert len(metrics.REGISTRY) == 15


def test_unseen_category_and_guard(spark):
    train = spark.createDataFrame([(c,) for c in "AABBC"] + [(None,)], "c string")
    test = spark.createDataFrame([("A",), ("D",), (None,)], "c string")
    rows = {r.c: r for r in tabular.category_features(test, ["c"], train).collect()}
    assert rows["A"].cat_c_freq == 0.4 and rows["D"].cat_c_freq == 0 and rows[None].cat_c_count == 0
    with pytest.raises(tabular.LeakageGuardError):
        tabular.category_features(test, ["c"], None)


def test_target_encoding(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "c string, y double")
    s = 1 / (1 + math.exp(-1))
    overall = 14 / 3
    made = {(r.c, r.y): r.c_te for r in tabular.target_encode_leave_one_out(train, "c", "y").collect()}
    assert made["a", 1.0] == pytest.approx(s * 3 + (1 - s) * overall)
    assert made["b", 10.0] == pytest.approx(overall)
    unseen = tabular.target_encode(spark.createDataFrame([("z",)], "c string"), train, "c", "y").first()
    assert unseen.c_te == pytest.approx(overall)


def test_imputers_and_clip(spark):
    rows = spark.createDataFrame([(1.0, "b"), (None, "a"), (3.0, None), (100.0, "a"), (2.0, "b")], "x double, c string")
    filled = tabular.impute(rows, rows, {"x": "median", "c": "most_frequent"}).collect()
    assert sorted(r.x for r in filled) == [1, 2, 2.5, 3, 100] and sorted(r.c for r in filled) == list("aaabb")
    assert tabular.impute(rows, rows, {"x": "constant"}, 7.0).filter("x = 7").count() == 1
    clipped = tabular.quantile_clip(rows, rows, ["x"], 0.0, 0.5)
    assert clipped.agg(F.max("x_clipped")).first()[0] == 2.5 and clipped.filter("x_clipped IS NULL").count() == 1
    flat = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert tabular.standard_scale(flat, flat, ["x"]).first().x_scaled == 0


def test_encoders(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert {r.c: r.c_ord for r in tabular.ordinal_encode(test, train, "c").collect()} == {"a": 0, "z": -1, None: -1}
    hot = {r.c: (r["c=a"], r["c=b"]) for r in tabular.one_hot(test, train, "c").collect()}
    assert hot == {"a": (1, 0), "z": (0, 0), None: (0, 0)}


def test_text_and_numeric_features(spark):
    rows = spark.createDataFrame([("Pack of 3 USB-C cables 2 m x 10X20 AB123 https://x.y ABCD-12", -1.0, 0.0), (None, None, 2.0)], "s string, a double, b double")
    first, second = tabular.text_features(rows, ["s", "none"], []).collect()
    assert (first.txt_s__has_pack_size, first.txt_s__has_url, first.txt_s__has_dimension, first.txt_s__has_sku_pattern, first.txt_s__has_model_number) == (1,) * 5
    assert (second.txt_s__char_count, second.txt_s__word_count, second.txt_s__avg_word_len) == (0, 0, 0)
    made = tabular.numeric_features(rows, ["a"], [("a", "b")], [("a", "b")]).collect()
    assert made[0].num_log1p_a == 0 and made[0].num_ratio_a_b == -1e8 and made[1].num_log1p_a is None


def test_leakage_and_downcast(spark, numbers):
    rows = numbers.withColumn("leak_y", F.col("y") * 2)
    found = {r.feature: r for r in tabular.leakage_report(rows, ["x", "leak_y", "y", "c"], "y").collect()}
    assert found["leak_y"].high_correlation and found["leak_y"].suspicious_name and found["y"].is_target and not found["c"].high_correlation
    assert dict(tabular.downcast(numbers).dtypes) == {"id": "tinyint", "x": "float", "c": "string", "y": "float"}


def test_splits(numbers):
    assert sorted(r.n for r in splits.fold_sizes(splits.make_splits(numbers, "kfold", "id")).collect()) == [12] * 5
    even = splits.make_splits(numbers, "stratified", "id", 3, target="c").groupBy("fold", "c").count()
    assert {r["count"] for r in even.collect()} <= {6, 7}
    grouped = splits.make_splits(numbers.withColumn("g", F.col("id") % 9), "group", "id", 3, group_col="g")
    assert grouped.groupBy("g").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0
    times = {r.id: r.fold for r in splits.make_splits(numbers, "timeseries", "id", 5, time_col="y").collect()}
    assert times[0] == 0 and times[59] == 5 and sorted(times.values()) == [times[i] for i in range(60)]
    assert splits.make_splits(numbers, "holdout", "id", fraction=0.25).filter("fold = 1").count() == 15
    by_group = splits.make_splits(numbers, "holdout", "id", fraction=0.34, group_col="c")
    assert by_group.filter("fold = 1").select("c").distinct().count() == 1
    both = splits.make_splits(numbers.withColumn("g", F.col("id") % 9), "stratified_group", "id", 3, target="c", group_col="g")
    assert both.groupBy("g").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0
    with pytest.raises(ValueError):
        splits.make_splits(numbers, "group", "id")
    with pytest.raises(ValueError):
        splits.make_splits(numbers, "nope", "id")


def test_models_and_cross_validation(spark, numbers):
    rows = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)], "f1 double, y double")
    assert models.build_model("dummy_mean").fit(rows, "y").predict(rows).first().prediction == 2.0
    with pytest.raises(ValueError):
        models.build_model("nope")
    split = splits.kfold(numbers, "id", 3)
    result = models.cross_validate(split, "y", ["id"], lambda: models.build_model("linear"), "rmse", "id")
    assert result.cv_mean < 1e-6 and result.oof.count() == 60 and len(result.models) == 3
    blended = models.ensemble_predictions(result.models, numbers, "median", lambda c: c + 1)
    assert blended.filter(F.abs(F.col("prediction") - F.col("y") - 1) > 1e-6).count() == 0


def test_ensemble(spark):
    rows = spark.createDataFrame([(k, float(k), float(k), float(-k), k + 0.5) for k in (1, 2, 3)], "id int, y double, m1 double, m2 double, m3 double")
    assert ensemble.select_models(rows, "y", ["m1", "m2", "m3"], "rmse") == ["m1"]
    ranks = {r.id: r.rank_avg for r in ensemble.rank_average(rows, ["m1", "m2"], "id").collect()}
    assert ranks == pytest.approx({1: 2 / 3, 2: 2 / 3, 3: 2 / 3})
    weights, score = ensemble.optimise_weights(rows, "y", ["m1", "m2"], "rmse", 20)
    assert weights == [1, 0] and score == 0
    stacked = ensemble.stack(rows, "y", ["m3"])
    assert ensemble.predict_stack(stacked, rows, ["m3"]).filter(F.abs(F.col("stacked") - F.col("y")) > 1e-6).count() == 0
    with pytest.raises(ValueError):
        ensemble.weighted_average(["a"], [0.0])


def test_audit(spark, numbers):
    rows = spark.createDataFrame(
        [(f"ID_{k:04d}", str(k * 1.5), "AB"[k % 2], f"http://x.y/{k}", f"http://x.y/{k}.jpg", "some longer words of a text here", 1, None, f"2024-01-{k % 28 + 1:02d}", "True" if k % 2 else "False", k % 2) for k in range(60)],
        "id string, num string, cat string, url string, img string, txt string, const int, empty string, day string, flag string, bit int",
    )
    kinds = audit.infer_types(rows)
    assert kinds == {
        "id": "identifier", "num": "numeric", "cat": "categorical", "url": "url", "img": "image_path", "txt": "constant", "const": "constant",
        "empty": "unknown", "day": "datetime", "flag": "boolean", "bit": "boolean",
    }
    assert audit.probable_columns(numbers, audit.infer_types(numbers)) == ("y", "id")
    profile = {r.column_name: r for r in audit.column_profile(rows).collect()}
    assert profile["empty"].missing_pct == 100 and profile["const"].near_constant and profile["id"].unique_ratio == 1
    twice = numbers.select("c").union(numbers.select("c").limit(1))
    assert audit.duplicates(twice, "c").first().duplicate_ids == 58
    assert audit.compare_columns(numbers, numbers.drop("y").withColumn("z", F.lit(1)))["only_test"] == ["z"]
    assert "identifier" in audit.describe(rows)


def test_submission(spark, tmp_path):
    ids = spark.createDataFrame([(k,) for k in range(5)], "id long")
    good = ids.withColumn("v", F.col("id") * 1.5)
    assert submission.write_submission(good, ids, "id", "v", f"file://{tmp_path}/sub")["rows"] == 5
    bad = good.withColumn("v", F.when(F.col("id") == 1, float("inf")).when(F.col("id") == 2, float("nan")).otherwise(F.col("v"))).filter("id < 4")
    problems = " ".join(submission.validate_submission(bad, ids, "id", "v", 0, 3).problems)
    assert all(w in problems for w in ("nans: 1", "infinite: 1", "missing_ids: 1", "4 rows instead of 5", "out_of_range: 2"))
    assert not submission.validate_submission(good.drop("v"), ids, "id", "v").valid
    out = good.select(submission.postprocess(F.col("v"), None, 1, 5, 0).alias("p")).collect()
    assert [r.p for r in out] == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        submission.postprocess(F.col("v"), "log")


def test_loaders(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2,y\n")
    (tmp_path / "latin.csv").write_bytes("id,name\n1,é\n".encode("latin-1"))
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n\n{"id": 2}\n{"id": 3}\n')
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1}, {"id": 2}]))
    (tmp_path / "b.json").write_text(json.dumps({"id": [1, 2, 3]}))
    (tmp_path / "bad.jsonl").write_text('{"id": 1}\nnope\n')
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("inner.csv", "id\n1\n2\n")
    load = lambda name: loaders.load_data(spark, str(tmp_path / name))
    assert load("a.csv").count() == 2 and load("latin.csv").first().name == "é"
    assert load("a.jsonl").count() == 3 and loaders.load_jsonl(spark, str(tmp_path / "a.jsonl"), 3).count() == 2
    assert load("a.json").count() == 2 and load("b.json").count() == 3 and load("a.zip").count() == 2
    with pytest.raises(Exception):
        load("bad.jsonl").collect()
    with pytest.raises(ValueError):
        load("a.tsv")
    load("a.csv").write.parquet(str(tmp_path / "t.parquet"))
    assert loaders.load_parquet(spark, str(tmp_path / "t.parquet"), ["id"]).columns == ["id"]
    assert loaders.sample_rows(spark.range(10), 3, "id").count() == 3 and loaders.sample_rows(spark.range(10), 3, "id", mode="final").count() == 10


def test_discovery(tmp_path):
    for name, size in (("train.csv", 100), ("test.csv", 50), ("sample_submission.csv", 10), ("notes.md", 5)):
        (tmp_path / name).write_text("x" * size)
    found = loaders.discover_files(str(tmp_path))
    assert found["train"][0].endswith("train.csv") and found["test"][0].endswith("test.csv") and found["submission"][0].endswith("sample_submission.csv")
    assert loaders.discover_file("test.csv", [str(tmp_path)]).endswith("test.csv") and loaders.discover_file("none", [str(tmp_path)]) is None
    assert loaders.file_scores("train.csv", 10, 10) == {"train": 1.4, "test": 0.0, "submission": 0.0}

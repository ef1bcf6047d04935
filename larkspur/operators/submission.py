"""Checks and sinks of results: record-linkage packages and tabular submissions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def postprocess(value: Column, transform: str | None = None, low: float | None = None, high: float | None = None, digits: int | None = None) -> Column:
    """exp or expm1, then clipping, then rounding half to even."""
    if transform not in (None, "exp", "expm1"):
        raise ValueError("transform is exp, expm1 or none")
    out = F.exp(value) if transform == "exp" else F.expm1(value) if transform == "expm1" else value
    if low is not None:
        out = F.when(out.isNotNull(), F.greatest(out, F.lit(float(low))))
    if high is not None:
        out = F.when(out.isNotNull(), F.least(out, F.lit(float(high))))
    return out if digits is None else F.bround(out, digits)


def id_list(matches: DataFrame, s1: DataFrame, column: str, id_col: str = "candidate_id") -> DataFrame:
    """(source1_entity_id, column): ids sorted and joined by commas, empty for records without any."""
    found = matches.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set(id_col)), ",").alias(column))
    return s1.select("s1_id").distinct().join(found, "s1_id", "left").select(
        F.col("s1_id").alias("source1_entity_id"), F.coalesce(column, F.lit("")).alias(column)
    )


def matching_results(matches: DataFrame, s1: DataFrame) -> DataFrame:
    return id_list(matches, s1, "matched_entity_ids")


def matching_lists(predicted: DataFrame) -> DataFrame:
    """``matching_results`` of (s1_id, predicted), whose arrays are sorted."""
    return predicted.select(F.col("s1_id").alias("source1_entity_id"), F.array_join("predicted", ",").alias("matched_entity_ids"))


def candidate_pairs(candidates: DataFrame, s1: DataFrame) -> DataFrame:
    return id_list(candidates, s1, "candidate_entity_ids")


def write_tsv(table: DataFrame, path: str, order: str = "source1_entity_id") -> None:
    """A folder of range-sorted TSV parts: their names in order give the whole order."""
    table.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="")


CHECKS = (
    "missing_s1", "extra_s1", "s1_in_matches", "unknown_ids", "duplicate_ids", "match_not_candidate", "bad_prefix",
)


def matched_pairs(results: DataFrame) -> DataFrame:
    """(s1_id, candidate_id) of results (source1_entity_id, matched_entity_ids)."""
    ids = F.filter(F.split("matched_entity_ids", ","), lambda x: x != "")
    return results.select(F.col("source1_entity_id").alias("s1_id"), F.explode(ids).alias("candidate_id"))


def validate_linkage(results: DataFrame, s1: DataFrame, targets: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """(check_name, violations) of results (source1_entity_id, matched_entity_ids).

    Ids of the first source among the matches count as unknown too.
    """
    ids = F.filter(F.split("matched_entity_ids", ","), lambda x: x != "")
    rows = results.select(F.col("source1_entity_id").alias("s1_id"), ids.alias("ids"))
    pairs = rows.select("s1_id", F.explode("ids").alias("candidate_id"))
    known = s1.select("s1_id").distinct()
    mine, theirs = rows.select("s1_id").distinct(), targets.select(F.col("entity_id").alias("candidate_id")).distinct()
    prefix = F.upper(F.substring("candidate_id", 1, 2))
    parts = {
        "missing_s1": known.join(mine, "s1_id", "left_anti"),
        "extra_s1": mine.join(known, "s1_id", "left_anti"),
        "s1_in_matches": pairs.filter(prefix == "S1"),
        "unknown_ids": pairs.join(theirs, "candidate_id", "left_anti"),
        "duplicate_ids": pairs.groupBy("s1_id", "candidate_id").count().filter("count > 1"),
        "bad_prefix": pairs.filter(~prefix.isin("S2", "S3")),
    }
    if candidates is not None:
        parts["match_not_candidate"] = pairs.join(candidates.select("s1_id", "candidate_id").distinct(), ["s1_id", "candidate_id"], "left_anti")
    out = None
    for name, bad in parts.items():
        one = bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        out = one if out is None else out.unionByName(one)
    return out


def write_package(spark: SparkSession, matches: DataFrame, candidates: DataFrame, s1: DataFrame, targets: DataFrame, folder: str) -> dict[str, int]:
    """Both files, then the checks: the files are there even if it raises."""
    results = matching_results(matches, s1)
    write_tsv(results, f"{folder}/matching_results.tsv")
    write_tsv(candidate_pairs(candidates, s1), f"{folder}/candidate_pairs.tsv")
    row = results.agg(F.count("*").alias("records"), F.count_if(F.col("matched_entity_ids") != "").alias("matched")).first()
    bad = {r.check_name: r.violations for r in validate_linkage(results, s1, targets, candidates).collect() if r.violations}
    if bad:
        raise ValueError(f"the package is not valid: {bad}")
    return {"records": row.records, "matched": row.matched}


@dataclass
class SubmissionReport:
    problems: list[str] = field(default_factory=list)

    @property
    def valid(self) -> bool:
        return not self.problems


def submission_checks(table: DataFrame, ids: DataFrame, id_col: str, value_col: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """One row of counts: nulls, NaN, infinite, duplicate ids, row difference, unknown and missing ids, out of range."""
    v = F.col(value_col).cast("double")
    finite = v.isNotNull() & ~F.isnan(v)
    outside = F.lit(False)
    if low is not None:
        outside = outside | (v < low)
    if high is not None:
        outside = outside | (v > high)
    one = table.agg(
        F.count_if(v.isNull()).alias("nulls"),
        F.count_if(F.isnan(v)).alias("nans"),
        F.count_if(F.abs(v) == float("inf")).alias("infinite"),
        (F.count("*") - F.count_distinct(id_col)).alias("duplicate_ids"),
        F.count_if(finite & outside).alias("out_of_range"),
        F.count("*").alias("rows"),
    )
    want = ids.select(F.col(id_col).alias("__id")).distinct()
    have = table.select(F.col(id_col).alias("__id")).distinct()
    return (
        one.join(want.join(have, "__id", "left_anti").agg(F.count("*").alias("missing_ids")), F.lit(True))
        .join(have.join(want, "__id", "left_anti").agg(F.count("*").alias("unknown_ids")), F.lit(True))
        .join(ids.agg(F.count("*").alias("expected_rows")), F.lit(True))
    )


def validate_submission(table: DataFrame, ids: DataFrame, id_col: str, value_col: str, low: float | None = None, high: float | None = None) -> SubmissionReport:
    missing = [c for c in (id_col, value_col) if c not in table.columns]
    if missing:
        return SubmissionReport([f"missing columns {missing}"])
    row = submission_checks(table, ids, id_col, value_col, low, high).first().asDict()
    bad = [f"{k}: {row[k]}" for k in ("nulls", "nans", "infinite", "duplicate_ids", "out_of_range", "missing_ids", "unknown_ids") if row[k]]
    if row["rows"] != row["expected_rows"]:
        bad.append(f"{row['rows']} rows instead of {row['expected_rows']}")
    return SubmissionReport(bad)


def submission_statistics(table: DataFrame, value_col: str) -> DataFrame:
    v = F.col(value_col).cast("double")
    return table.agg(
        F.count("*").alias("rows"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.percentile(v, F.lit(0.5)).alias("median"),
    )


def write_submission(table: DataFrame, ids: DataFrame, id_col: str, value_col: str, path: str) -> dict:
    """Check, write CSV, read it again, check again, describe."""
    first = validate_submission(table, ids, id_col, value_col)
    if not first.valid:
        raise ValueError("; ".join(first.problems))
    table.select(id_col, value_col).write.mode("overwrite").csv(path, header=True)
    again = table.sparkSession.read.schema(table.select(id_col, value_col).schema).csv(path, header=True)
    second = validate_submission(again, ids, id_col, value_col)
    if not second.valid:
        raise ValueError("after reading: " + "; ".join(second.problems))
    return submission_statistics(again, value_col).first().asDict()


def validate_tsv(spark: SparkSession, path: str, header: tuple[str, str] = ("source1_entity_id", "matched_entity_ids")) -> DataFrame:
    """(problem, n) of the raw lines of a results file: header, field count, repeated records and ids, self matches, prefixes."""
    lines = spark.read.text(path).select("value")
    fields = F.split("value", "\t")
    first = "\t".join(header)
    body = lines.filter(F.col("value") != first).select("value", fields.alias("f"))
    good = body.filter(F.size("f") == 2).select(F.col("f")[0].alias("s1"), F.filter(F.split(F.col("f")[1], ","), lambda x: x != "").alias("ids"))
    counts = {
        "missing_header": lines.agg((F.count_if(F.col("value") == first) == 0).cast("long").alias("n")),
        "malformed_row": body.agg(F.count_if(F.size("f") != 2).alias("n")),
        "duplicate_row": good.groupBy("s1").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n")),
        "repeated_id": good.agg(F.count_if(F.size("ids") != F.size(F.array_distinct("ids"))).alias("n")),
        "self_match": good.agg(F.count_if(F.array_contains("ids", F.col("s1"))).alias("n")),
        "bad_prefix": good.agg(F.count_if(F.exists("ids", lambda x: ~F.substring(x, 1, 2).isin("S2", "S3"))).alias("n")),
    }
    out = None
    for name, one in counts.items():
        part = one.select(F.lit(name).alias("problem"), F.col("n").cast("long").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


def aligned(*tables: DataFrame) -> int:
    """Rows at which files that should list the same ids in the same order differ (first column against first column)."""
    def numbered(t: DataFrame, name: str) -> DataFrame:
        schema = f"row long, {name} string"
        return t.sparkSession.createDataFrame(t.select(F.col(t.columns[0]).cast("string")).rdd.zipWithIndex().map(lambda x: (x[1], x[0][0])), schema)

    base = numbered(tables[0], "c0")
    bad = 0
    for k, t in enumerate(tables[1:], 1):
        both = base.join(numbered(t, f"c{k}"), "row", "full")
        bad += both.filter(~F.col("c0").eqNullSafe(F.col(f"c{k}"))).count()
    return bad

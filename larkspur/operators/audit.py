"""Schema audits: column profiles, type inference, duplicates, comparisons of train and test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")
URL = r"^(?i)https?://"
IMAGE = r"(?i)\.(?:jpg|jpeg|png|gif|bmp|webp|tiff)$"
BOOLEAN_WORDS = ("True", "False", "true", "false")
LEAK_WORDS = ("target", "label", "leak")
NEAR_CONSTANT = 0.995


def column_profile(rows: DataFrame) -> DataFrame:
    """One row for each column: missing, missing_pct, n_unique, unique_ratio, top_share, near_constant, leak_name.

    One pass for nulls; values of all columns are counted together in one long table, so the number
    of shuffles does not grow with the number of columns.
    """
    total = rows.count()
    long = rows.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in rows.columns])).alias("x")
    ).select("x.*")
    counts = long.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    per = counts.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.count("value").alias("n_unique"),
        F.max("n").alias("top"),
    )
    share = F.col("top") / max(total, 1)
    return per.select(
        "column_name",
        "missing",
        F.bround(100 * F.col("missing") / max(total, 1), 2).alias("missing_pct"),
        "n_unique",
        F.bround(F.col("n_unique") / max(total, 1), 4).alias("unique_ratio"),
        (share > NEAR_CONSTANT).alias("near_constant"),
        F.lower("column_name").rlike("|".join(LEAK_WORDS)).alias("leak_name"),
    )


def _type_rules(s: dict, kind: str) -> str:
    """Ordered rules over one column's sample statistics."""
    if not s["present"]:
        return "unknown"
    if s["distinct"] <= 1:
        return "constant"
    if kind == "boolean" or s["booleans"] == s["present"]:
        return "boolean"
    if kind in NUMERIC:
        return "boolean" if s["distinct"] == 2 else "numeric"
    if kind.startswith(("timestamp", "date")):
        return "datetime"
    if s["numbers"] > 0.8:
        return "numeric"
    if s["dates"] > 0.8:
        return "datetime"
    if s["urls"] > 0.7:
        return "image_path" if s["images"] > 0.5 else "url"
    if s["images"] > 0.5:
        return "image_path"
    if s["words"] > 4:
        return "text"
    unique = s["distinct"] / s["rows"]
    return "identifier" if unique > 0.95 else "high_cardinality" if unique > 0.5 else "categorical"


def infer_types(rows: DataFrame) -> dict[str, str]:
    """Inferred kind of every column from one aggregate row."""
    aggregates: list[Column] = []
    for k, name in enumerate(rows.columns):
        text = F.trim(F.col(f"`{name}`").cast("string"))
        share = lambda flag, text=text: F.avg(F.when(text.isNotNull(), flag.cast("double")))
        dates = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}|^\d{1,2}/\d{1,2}/\d{4}") & F.coalesce(text.try_cast("timestamp"), F.try_to_timestamp(text, F.lit("M/d/yyyy"))).isNotNull()
        parts = {
            "rows": F.count("*"),
            "present": F.count(text),
            "distinct": F.count_distinct(text),
            "booleans": F.count_if(text.isin(*BOOLEAN_WORDS)),
            "numbers": share(text.try_cast("double").isNotNull()),
            "dates": share(dates),
            "urls": share(text.rlike(URL)),
            "images": share(text.rlike(IMAGE)),
            "words": F.avg(F.size(F.split(text, r"\s+"))),
        }
        aggregates += [v.alias(f"c{k}_{n}") for n, v in parts.items()]
    row = rows.agg(*aggregates).first()
    names = ("rows", "present", "distinct", "booleans", "numbers", "dates", "urls", "images", "words")
    return {
        name: _type_rules({n: row[f"c{k}_{n}"] or 0 for n in names}, rows.schema[k].dataType.typeName())
        for k, name in enumerate(rows.columns)
    }


def probable_columns(rows: DataFrame, types: dict[str, str]) -> tuple[str | None, str | None]:
    """(target, id): the last numeric column without id or index in its name, the first identifier."""
    numeric = [c for c, t in types.items() if t == "numeric" and not any(w in c.lower() for w in ("id", "index"))]
    ids = [c for c, t in types.items() if t == "identifier" or c.lower() in ("id", "index") or c.lower().endswith("_id")]
    return (numeric[-1] if numeric else None), (ids[0] if ids else None)


def duplicates(rows: DataFrame, id_col: str | None = None) -> DataFrame:
    """duplicate_rows and duplicate_ids: rows less distinct rows (nulls compare equal)."""
    whole = rows.groupBy(*rows.columns).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_rows"))
    if id_col is None:
        return whole.withColumn("duplicate_ids", F.lit(0).cast("long"))
    ids = rows.groupBy(id_col).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_ids"))
    return whole.join(ids, F.lit(True))


def compare_columns(train: DataFrame, test: DataFrame) -> dict[str, list]:
    a, b = dict(train.dtypes), dict(test.dtypes)
    return {
        "only_train": sorted(a.keys() - b.keys()),
        "only_test": sorted(b.keys() - a.keys()),
        "type_mismatch": sorted(c for c in a.keys() & b.keys() if a[c] != b[c]),
    }


def unseen_categories(train: DataFrame, test: DataFrame, columns: list[str], most: int = 20) -> DataFrame:
    """(column_name, value): test categories that training lacks, sorted, at most so many for a column."""
    def long(rows: DataFrame) -> DataFrame:
        parts = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
        return rows.select(F.explode(F.array(*parts)).alias("x")).select("x.*").filter("value IS NOT NULL").distinct()

    new = long(test).join(long(train), ["column_name", "value"], "left_anti")
    return new.groupBy("column_name").agg(F.slice(F.array_sort(F.collect_set("value")), 1, most).alias("v")).select("column_name", F.explode("v").alias("value"))


def row_ratio(train: DataFrame, test: DataFrame) -> float:
    return test.count() / max(train.count(), 1)


def audit_source(raw: DataFrame, expected_source: int, top: int = 12) -> tuple[DataFrame, DataFrame]:
    """(one row of counts, the most frequent countries) of raw records, in one pass each; duplicates are exact."""
    fields = ("entity_id", "business_name", "business_address", "country")
    prefix = F.upper(F.substring(F.trim("entity_id"), 1, 2))
    counts = raw.agg(
        F.count("*").alias("rows"),
        F.count_if(prefix != f"S{expected_source}").alias("wrong_prefix"),
        *[F.count_if(F.trim(F.coalesce(c, F.lit(""))) == "").alias(f"blank_{c}") for c in fields],
        (F.count("entity_id") - F.count_distinct("entity_id")).alias("duplicate_ids"),
    )
    countries = raw.groupBy("country").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country").limit(top)
    return counts, countries


def describe(rows: DataFrame) -> str:
    """A text report of an audit."""
    types = infer_types(rows)
    lines = [f"{'column':30} {'type':16} missing% unique"]
    for r in column_profile(rows).orderBy("column_name").collect():
        lines.append(f"{r.column_name[:30]:30} {types[r.column_name]:16} {r.missing_pct:8.2f} {r.n_unique}")
    return "\n".join(lines)

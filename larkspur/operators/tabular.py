"""Feature engineering, encoders, imputation and leakage checks for tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EPS = 1e-8
# The patterns of the text features.
UNITS = (
    r"\b(?:mg|g|kg|ml|l|litre|liter|cm|mm|m|inch|inches|in|ft|oz|lb|lbs|watt|watts|w|volt|volts|v|amp|amps|a|hz|mhz|ghz|rpm|psi|"
    r"gb|mb|tb|kb|pixel|px|dp|dpi)\b"
)
NUMBERS = r"\b\d+\.?\d*\b"
DIMENSIONS = r"\d+\s*[xX×]\s*\d+(?:\s*[xX×]\s*\d+)?"
PACK = r"\b(?:pack\s*of|set\s*of|pack|pieces|pcs|count|ct|qty)\s*\d+|\b\d+\s*(?:pack|pcs|pieces|count)\b"
SKU, MODEL, CAPS, URL, SPECIAL = (
    r"\b[A-Z0-9]{4,}-[A-Z0-9]{2,}\b", r"\b[A-Z]{1,4}\d{3,}\b", r"\b[A-Z][A-Z0-9]{2,}\b", r"https?://\S+", r"[^a-zA-Z0-9\s]",
)


class LeakageGuardError(ValueError):
    """Statistics were asked for without the training rows that they must come from."""


def text_features(rows: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """16 structural features of each text column, named txt_<column>__<feature>."""
    out: list[Column] = []
    for name in columns:
        if name not in rows.columns:
            continue
        s = F.coalesce(F.col(name).cast("string"), F.lit(""))
        tokens = F.filter(F.split(s, r"(?U)\s+"), lambda t: t != "")
        letters = F.length(F.array_join(tokens, ""))
        prefix = f"txt_{name.replace(' ', '_').replace('-', '_')}"

        def flag(pattern: str, s: Column = s) -> Column:
            return s.rlike("(?U)" + pattern).cast("int")

        def count(pattern: str, s: Column = s) -> Column:
            return F.regexp_count(s, F.lit("(?U)" + pattern))

        features = {
            "char_count": F.length(s),
            "word_count": F.size(tokens),
            "unique_word_count": F.size(F.array_distinct(F.filter(F.split(F.lower(s), r"(?U)\s+"), lambda t: t != ""))),
            "avg_word_len": F.coalesce(F.try_divide(letters, F.size(tokens)), F.lit(0.0)),
            "digit_count": count(r"\d"),
            "number_count": count(NUMBERS),
            "uppercase_ratio": count(r"\p{Lu}") / F.greatest(F.length(s), F.lit(1)),
            "special_char_count": count(SPECIAL),
            "has_unit": flag("(?i)" + UNITS),
            "unit_count": count("(?i)" + UNITS),
            "has_dimension": flag(DIMENSIONS),
            "has_pack_size": flag("(?i)" + PACK),
            "has_sku_pattern": flag(SKU),
            "has_model_number": flag(MODEL),
            "has_brand_caps": flag(CAPS),
            "has_url": flag(URL),
        }
        out += [c.alias(f"{prefix}__{n}") for n, c in features.items()]
    return rows.select(*keep, *out)


def numeric_features(rows: DataFrame, log_columns: list[str] = (), ratios: list[tuple[str, str]] = (), products: list[tuple[str, str]] = ()) -> DataFrame:
    """log1p of non-negative parts (null stays null), a / (b + 1e-8) and a * b."""
    made = {f"num_log1p_{c}": F.when(F.col(c).isNotNull(), F.log1p(F.greatest(F.col(c), F.lit(0.0)))) for c in log_columns}
    made |= {f"num_ratio_{a}_{b}": F.col(a) / (F.col(b) + EPS) for a, b in ratios}
    made |= {f"num_prod_{a}_{b}": F.col(a) * F.col(b) for a, b in products}
    return rows.withColumns(made)


def category_features(rows: DataFrame, columns: list[str], train: DataFrame | None) -> DataFrame:
    """Frequency (share of the non-null training rows) and count of each category; 0 for unseen ones."""
    if train is None:
        raise LeakageGuardError("category statistics need the training rows")
    for name in columns:
        counts = train.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("__c")).agg(F.count("*").alias("__n"))
        total = counts.agg(F.sum("__n").alias("__total"))
        table = counts.join(F.broadcast(total), F.lit(True)).select("__c", "__n", (F.col("__n") / F.col("__total")).alias("__f"))
        rows = rows.join(table, F.col(name) == F.col("__c"), "left").withColumns(
            {f"cat_{name}_freq": F.coalesce("__f", F.lit(0.0)), f"cat_{name}_count": F.coalesce("__n", F.lit(0))}
        ).drop("__c", "__n", "__f")
    return rows


frequency_encode = category_features


def _smoother(n: Column, min_leaf: float, smoothing: float) -> Column:
    return 1 / (1 + F.exp(-(n - min_leaf) / smoothing))


def target_encoding(train: DataFrame, column: str, target: str, min_leaf: float = 1, smoothing: float = 1.0) -> DataFrame:
    """(category, encoding): smoothed category means of the training rows."""
    overall = train.agg(F.avg(target).alias("__g"))
    stats = train.groupBy(F.col(column).alias("category")).agg(F.count(target).alias("n"), F.avg(target).alias("m"))
    s = _smoother(F.col("n"), min_leaf, smoothing)
    return stats.join(F.broadcast(overall), F.lit(True)).select("category", (s * F.col("m") + (1 - s) * F.col("__g")).alias("encoding"))


def target_encode(rows: DataFrame, train: DataFrame, column: str, target: str, min_leaf: float = 1, smoothing: float = 1.0) -> DataFrame:
    table = target_encoding(train, column, target, min_leaf, smoothing)
    overall = train.agg(F.avg(target).alias("__g"))
    joined = rows.join(table, F.col(column).eqNullSafe(F.col("category")), "left").join(F.broadcast(overall), F.lit(True))
    return joined.withColumn(f"{column}_te", F.coalesce("encoding", "__g")).drop("category", "encoding", "__g")


def target_encode_leave_one_out(train: DataFrame, column: str, target: str, min_leaf: float = 1, smoothing: float = 1.0) -> DataFrame:
    """Each training row's category mean without itself; the smoother still uses the whole count."""
    stats = train.groupBy(F.col(column).alias("__c")).agg(F.count(target).alias("__n"), F.sum(target).alias("__s"))
    overall = train.agg(F.avg(target).alias("__g"))
    joined = train.join(stats, F.col(column).eqNullSafe(F.col("__c"))).join(F.broadcast(overall), F.lit(True))
    n, s = F.col("__n"), _smoother(F.col("__n"), min_leaf, smoothing)
    mean = F.when(n > 1, F.try_divide(F.col("__s") - F.col(target), n - 1)).otherwise(F.col("__g"))
    return joined.withColumn(f"{column}_te", s * mean + (1 - s) * F.col("__g")).drop("__c", "__n", "__s", "__g")


IMPUTERS = {
    "mean": lambda c: F.avg(c),
    "median": lambda c: F.percentile(c, F.lit(0.5)),
    "most_frequent": lambda c: F.mode(c, True),
}


def impute(rows: DataFrame, train: DataFrame, columns: dict[str, str], fill: object = 0) -> DataFrame:
    """columns: name -> strategy (mean, median, most_frequent, constant); statistics of the training rows."""
    asked = {c: s for c, s in columns.items() if s != "constant"}
    out = {c: F.coalesce(F.col(c), F.lit(fill)) for c, s in columns.items() if s == "constant"}
    if asked:
        stats = train.agg(*[IMPUTERS[s](F.col(c)).alias(f"__{c}") for c, s in asked.items()])
        rows = rows.join(F.broadcast(stats), F.lit(True))
        out |= {c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in asked}
    return rows.withColumns(out).drop(*[f"__{c}" for c in asked])


def standard_scale(rows: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population deviation of the training rows; a deviation of 0 counts as 1."""
    stats = train.agg(
        *[F.avg(c).alias(f"__m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"__s_{c}") for c in columns]
    )
    scaled = {
        f"{c}_scaled": (F.col(c) - F.col(f"__m_{c}")) / F.when(F.col(f"__s_{c}") == 0, 1.0).otherwise(F.col(f"__s_{c}")) for c in columns
    }
    return rows.join(F.broadcast(stats), F.lit(True)).withColumns(scaled).drop(*stats.columns)


def ordinal_encode(rows: DataFrame, train: DataFrame, column: str) -> DataFrame:
    """Rank of the category among the sorted training categories, from 0; -1 for unseen ones and nulls.

    Categories are collected: meant for columns of few values (at most 10,000, else it raises).
    """
    values = [r[0] for r in train.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).limit(10_001).collect()]
    if len(values) > 10_000:
        raise ValueError(f"{column} has over 10,000 categories")
    if not values:
        return rows.withColumn(f"{column}_ord", F.lit(-1))
    places = F.broadcast(rows.sparkSession.createDataFrame(list(enumerate(values)), f"__o int, __c {train.schema[column].dataType.simpleString()}"))
    joined = rows.join(places, F.col(column) == F.col("__c"), "left")
    return joined.withColumn(f"{column}_ord", F.coalesce("__o", F.lit(-1))).drop("__c", "__o")


def one_hot(rows: DataFrame, train: DataFrame, column: str) -> DataFrame:
    """One 0/1 column for each training category (at most 1,000); unseen ones and nulls are all 0."""
    values = [r[0] for r in train.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).limit(1_001).collect()]
    if len(values) > 1_000:
        raise ValueError(f"{column} has over 1,000 categories")
    return rows.withColumns({f"{column}={v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values})


def quantile_clip(rows: DataFrame, train: DataFrame, columns: list[str], low: float = 0.001, high: float = 0.999) -> DataFrame:
    """Clip to exact, linearly interpolated quantiles of the training rows."""
    stats = train.agg(*[F.percentile(c, F.array(F.lit(low), F.lit(high))).alias(f"__{c}") for c in columns])
    clipped = {
        f"{c}_clipped": F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.col(f"__{c}")[0]), F.col(f"__{c}")[1])) for c in columns
    }
    return rows.join(F.broadcast(stats), F.lit(True)).withColumns(clipped).drop(*stats.columns)


KEYWORDS = ("target", "label", "leak")


def leakage_report(train: DataFrame, features: list[str], target: str, limit: float = 0.98) -> DataFrame:
    """(feature, correlation, is_target, suspicious_name, high_correlation) in one pass."""
    numeric = [f for f in features if train.schema[f].dataType.typeName() in ("integer", "long", "double", "float", "short", "byte")]
    row = train.agg(*[F.corr(f, target).alias(f) for f in numeric])
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), (F.col(f) if f in numeric else F.lit(None).cast("double")).alias("correlation")) for f in features]))
    rows = row.select(pairs.alias("r")).select("r.*")
    return rows.withColumns(
        {
            "is_target": F.col("feature") == target,
            "suspicious_name": F.lower("feature").rlike("|".join(KEYWORDS)),
            "high_correlation": F.coalesce(F.abs("correlation") > limit, F.lit(False)),
        }
    )


def downcast(rows: DataFrame) -> DataFrame:
    """Integers and doubles cast to the smallest type that holds the column's values."""
    whole = [f.name for f in rows.schema if f.dataType.typeName() in ("long", "integer", "short")]
    real = [f.name for f in rows.schema if f.dataType.typeName() == "double"]
    if whole:
        stats = rows.agg(*[F.min(c).alias(f"{c}__l") for c in whole], *[F.max(c).alias(f"{c}__h") for c in whole]).first()
    out = {c: F.col(c).cast("float") for c in real}
    for c in whole:
        low, high = stats[f"{c}__l"], stats[f"{c}__h"]
        if low is None:
            continue
        kind = next((k for k, b in (("byte", 7), ("short", 15), ("int", 31)) if -(1 << b) <= low and high < 1 << b), "long")
        out[c] = F.col(c).cast(kind)
    return rows.withColumns(out) if out else rows


def draw(seed: int, *keys: str | Column) -> Column:
    """A pseudo-random order of rows by their keys: the same in any engine, for any partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]))


def ranked_rows(rows: DataFrame, *order: Column) -> DataFrame:
    """rows plus a dense 0-based place in the given order, by ranges: no task holds all rows."""
    spread = rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    sizes = spread.groupBy("__part").agg(F.count("*").alias("__n"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = F.broadcast(sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")))
    place = F.row_number().over(W.partitionBy("__part").orderBy(*order)) - 1
    return spread.join(starts, "__part").withColumn("place", F.col("__start") + place).drop("__part", "__start")

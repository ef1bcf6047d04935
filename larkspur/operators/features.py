"""Feature pipelines: groups of features made together, fitted on training rows only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.vectors import fit_idf, term_counts, weigh, word_grams
from larkspur.operators import tabular


@dataclass
class FeatureConfig:
    text: list[str] = field(default_factory=list)
    log: list[str] = field(default_factory=list)
    ratios: list[tuple[str, str]] = field(default_factory=list)
    products: list[tuple[str, str]] = field(default_factory=list)
    categories: list[str] = field(default_factory=list)
    keep: list[str] = field(default_factory=list)


def create_features(rows: DataFrame, config: FeatureConfig, train: DataFrame | None = None) -> DataFrame:
    """All configured groups side by side.  Without training rows, categories count the rows themselves."""
    base = tabular.category_features(rows, config.categories, rows if train is None else train)
    base = tabular.numeric_features(base, config.log, config.ratios, config.products)
    made = [c for c in base.columns if c.startswith(("num_", "cat_"))]
    return tabular.text_features(base, config.text, [*config.keep, *made])


def bad_values(rows: DataFrame, names: list[str]) -> DataFrame:
    """(feature, nulls, nans, infinite) in one pass."""
    parts = []
    row = rows.agg(
        *[F.count_if(F.col(n).isNull()).alias(f"{n}__a") for n in names],
        *[F.count_if(F.isnan(F.col(n).cast("double"))).alias(f"{n}__b") for n in names],
        *[F.count_if(F.abs(F.col(n).cast("double")) == float("inf")).alias(f"{n}__c") for n in names],
    )
    for n in names:
        parts.append(F.struct(F.lit(n).alias("feature"), *[F.col(f"`{n}__{k}`").alias(v) for k, v in zip("abc", ("nulls", "nans", "infinite"), strict=True)]))
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


class FeaturePipeline:
    """fit() remembers the training rows; transform() makes the same features of any rows."""

    def __init__(self, config: FeatureConfig):
        self.config, self.train = config, None

    def fit(self, train: DataFrame) -> FeaturePipeline:
        self.train = train
        return self

    def transform(self, rows: DataFrame) -> DataFrame:
        if self.train is None:
            raise tabular.LeakageGuardError("fit the pipeline on training rows first")
        return create_features(rows, self.config, self.train)

    def fit_transform(self, train: DataFrame) -> DataFrame:
        return self.fit(train).transform(train)


class TfidfBuilder:
    """Word 1- and 2-gram TF-IDF of several text columns, vocabulary and idf from the training rows."""

    def __init__(self, columns: list[str], key: str, max_features: int = 50_000):
        self.columns, self.key, self.max_features, self.idf = columns, key, max_features, {}

    def _lists(self, rows: DataFrame, column: str) -> DataFrame:
        return rows.select(self.key, word_grams(F.coalesce(F.col(column).cast("string"), F.lit("")), 1, 2).alias("terms"))

    def fit(self, train: DataFrame) -> TfidfBuilder:
        for column in self.columns:
            lists = self._lists(train, column)
            total = lists.agg(F.count("*").alias("rows"))
            self.idf[column] = fit_idf(term_counts(lists, [self.key]), total, [], self.max_features)
        return self

    def transform(self, rows: DataFrame) -> DataFrame:
        """(key, column_name, term, weight): the columns' vectors one after another."""
        out = None
        for column in self.columns:
            part = weigh(term_counts(self._lists(rows, column), [self.key]), self.idf[column], [self.key], [])
            part = part.select(self.key, F.lit(column).alias("column_name"), "term", "weight")
            out = part if out is None else out.unionByName(part)
        return out

"""Business records: reading, checking and deriving their normalised columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import normalize as N

RAW = ["entity_id", "business_name", "business_address", "country"]
NORMALISED = [
    "entity_id", "source", "name_raw", "name_norm", "name_tokens", "name_compact", "address_raw", "address_norm",
    "address_tokens", "postal", "numeric_tokens", "country_raw", "country_norm",
]


def source_of(entity_id: Column) -> Column:
    """1, 2 or 3 from the id's first two characters in either case; anything else raises."""
    prefix = F.upper(F.substring(entity_id, 1, 2))
    known = F.when(prefix == "S1", 1).when(prefix == "S2", 2).when(prefix == "S3", 3)
    return known.otherwise(F.raise_error(F.concat(F.lit("unknown source of id: "), F.coalesce(entity_id, F.lit("null"))))).cast("byte")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings; empty fields are empty strings, never null."""
    table = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"')
    return table.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in table.columns])


def normalised(raw: DataFrame, expected_source: int | None = None) -> DataFrame:
    """The 13 columns of a record table from the four raw ones."""
    missing = [c for c in RAW if c not in raw.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    entity = F.trim("entity_id")
    source = source_of(entity)
    if expected_source is not None:
        wrong = F.concat(F.lit("record of another source: "), entity)
        source = F.when(source == expected_source, source).otherwise(F.raise_error(wrong).cast("byte"))
    name, address, country = (F.coalesce(F.col(c), F.lit("")) for c in RAW[1:])
    base = raw.select(
        entity.alias("entity_id"),
        source.alias("source"),
        name.alias("name_raw"),
        N.normalize_name(name).alias("name_norm"),
        address.alias("address_raw"),
        N.normalize_address(address).alias("address_norm"),
        N.extract_postal(F.lower(address)).alias("postal"),
        country.alias("country_raw"),
        N.normalize_country(country).alias("country_norm"),
    )
    return base.withColumns(
        {
            "name_tokens": N.words(F.col("name_norm")),
            "name_compact": N.compact(F.col("name_norm")),
            "address_tokens": N.words(F.col("address_norm")),
            "numeric_tokens": N.numeric_tokens(F.col("address_norm")),
        }
    ).select(*NORMALISED)


def production_records(raw: DataFrame) -> DataFrame:
    """The production convention: (entity_id, source, name_norm, name_compact, address_norm, address_compact, country_norm, postal)."""
    base = raw.select(
        F.trim("entity_id").alias("entity_id"),
        source_of(F.trim("entity_id")).alias("source"),
        N.production_name(F.col("business_name")).alias("name_norm"),
        N.production_address(F.col("business_address")).alias("address_norm"),
        F.lower(F.trim(F.coalesce("country", F.lit("")))).alias("country_norm"),
    )
    return base.withColumns(
        {
            "name_compact": N.production_compact(F.col("name_norm")),
            "address_compact": N.production_compact(F.col("address_norm")),
            "postal": N.production_postal(F.col("address_norm")),
        }
    )


def load_source_tsv(spark: SparkSession, path: str, expected_source: int | None = None) -> DataFrame:
    return normalised(read_tsv(spark, path), expected_source)


def load_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, truth array): ids split at commas, trimmed, distinct; "nan" and empty mean none.

    Of repeated ids the last row of the file holds.
    """
    table = read_tsv(spark, path)
    names = {c.lower(): c for c in table.columns}

    def column(exact: str, *parts: str) -> str:
        if exact in names:
            return names[exact]
        found = [c for low, c in names.items() if any(p in low for p in parts)]
        if not found:
            raise ValueError(f"no column like {exact}")
        return found[0]

    left, right = column("source1_entity_id", "source1", "s1"), column("matched_entity_ids", "match")
    listed = F.when(F.lower(F.trim(right)) == "nan", F.lit("")).otherwise(F.col(right))
    ids = F.array_distinct(F.filter(F.transform(F.split(listed, ","), lambda x: F.trim(x)), lambda x: x != ""))
    rows = table.select(F.trim(left).alias("s1_id"), ids.alias("truth"), F.monotonically_increasing_id().alias("row"))
    return rows.groupBy("s1_id").agg(F.max_by("truth", "row").alias("truth"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    return truth.select("s1_id", F.explode("truth").alias("target_id"))


def duplicate_ids(records: DataFrame) -> DataFrame:
    return records.groupBy("entity_id").count().filter("count > 1")


class RecordStore:
    """All records of all sources, each id once."""

    def __init__(self, frame: DataFrame):
        self.frame = frame

    @classmethod
    def from_sources(cls, *tables: DataFrame) -> RecordStore:
        frame = tables[0]
        for table in tables[1:]:
            frame = frame.unionByName(table)
        twice = duplicate_ids(frame).limit(1).collect()
        if twice:
            raise ValueError(f"repeated entity id: {twice[0].entity_id}")
        return cls(frame)

    def get_row(self, entity_id: str):
        return self.frame.filter(F.col("entity_id") == entity_id).first()

    def get_field(self, entity_id: str, field: str):
        row = self.get_row(entity_id)
        return None if row is None else row[field]

    def source_frame(self, source: int) -> DataFrame:
        return self.frame.filter(F.col("source") == source)

    def source_ids(self, source: int) -> DataFrame:
        return self.source_frame(source).select("entity_id")

    def all_ids(self) -> DataFrame:
        return self.frame.select("entity_id")

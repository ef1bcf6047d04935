"""Candidate generation: blockers that pair reference records with target records.

Every blocker is an equi-join on a derived key, per target source (all statistics are those of one
target source).  Records have the columns of ``sources.records``; a blocker returns
(s1_id, candidate_id, candidate_source, blocker, block_score).  Hot keys are handled by adaptive
skew joins; blockers that prune by frequency do so before the join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larkspur.functions.similarity import sequence_ratio
from larkspur.functions.vectors import char_wb_grams, cosine_top_k, word_grams
from larkspur.operators.bounds import Floor
from larkspur.operators.fuzzy import best_names
from larkspur.operators.products import (
    LEAST_ROWS, Bag, _side, id_lists, pair_best, pair_cells, pair_count, pair_features, pair_lists, pair_negatives, pair_scores, pair_tallies, pair_values, shared_counts,
)

# Words that block too much.
NAME_STOPWORDS = (
    "the", "and", "of", "in", "at", "to", "for", "a", "an", "private", "limited", "llc", "incorporated", "corporation",
    "company", "group", "international",
)
ADDRESS_STOPWORDS = (
    "street", "road", "avenue", "drive", "lane", "floor", "building", "suite", "apartment", "number", "near", "north",
    "south", "east", "west", "post", "office",
)
PAIR = ["s1_id", "candidate_id", "candidate_source"]
#: Records of a chunk where a key's pairs are dealt over tasks, and groups that a small table is dealt into nevertheless.
DEALT_REFS, DEALT_TARGETS, DEALT_GROUPS = 4_096, 16_384, 48


def _result(pairs: DataFrame, name: str, score: Column) -> DataFrame:
    return pairs.select(*PAIR, F.lit(name).alias("blocker"), score.cast("double").alias("block_score"))


def equal_key(ref: DataFrame, tgt: DataFrame, name: str, ref_keys: list[Column], tgt_keys: list[Column], keep_first: bool = True) -> DataFrame:
    """Pairs with equal keys; the first key must not be empty, the others may."""
    a = ref.select(F.col("entity_id").alias("s1_id"), *[k.alias(f"k{i}") for i, k in enumerate(ref_keys)])
    b = tgt.select(
        F.col("entity_id").alias("candidate_id"), F.col("source").alias("candidate_source"),
        *[k.alias(f"k{i}") for i, k in enumerate(tgt_keys)],
    )
    filled = F.col("k0") != ""
    return _result(a.filter(filled).join(b.filter(filled), [f"k{i}" for i in range(len(ref_keys))]), name, F.lit(1.0))


def exact_name(ref: DataFrame, tgt: DataFrame) -> DataFrame:
    key = [F.trim("name_norm")]
    return equal_key(ref, tgt, "exact_name", key, key)


def exact_compact_name(ref: DataFrame, tgt: DataFrame) -> DataFrame:
    key = [F.col("name_compact")]
    return equal_key(ref, tgt, "exact_compact_name", key, key)


def postal(ref: DataFrame, tgt: DataFrame) -> DataFrame:
    key = [F.col("postal")]
    return equal_key(ref, tgt, "postal", key, key)


def dealt_key(ref: DataFrame, tgt: DataFrame, name: str, key: Column, ref_rows: int = DEALT_REFS, tgt_rows: int = DEALT_TARGETS) -> DataFrame:
    """``equal_key`` for few keys of many records: a key's pairs are dealt over tasks by chunks of both sides.

    A row holds all targets of a key and chunk, which each reference of the key unfolds; so a task's targets are few, too, and
    their ids come in the same order again and again.
    """
    a, b = ref.select(F.col("entity_id").alias("s1_id"), key.alias("k")), tgt.select("entity_id", "source", key.alias("k"))
    a, b = a.filter("k <> ''"), b.filter("k <> ''")
    refs, down = ref.count(), max(1, -(-tgt.count() // tgt_rows))
    across = max(1, -(-refs // ref_rows), min(-(-DEALT_GROUPS // down), refs // LEAST_ROWS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    chunk = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    group = F.concat_ws(",", "i", "j", "k").alias("group")
    a = a.withColumn("i", chunk("s1_id", across)).withColumn("j", every(down)).select("s1_id", group)
    held = F.collect_list(F.struct(F.col("entity_id").alias("candidate_id"), F.col("source").alias("candidate_source"))).alias("held")
    b = b.withColumn("j", chunk("entity_id", down)).groupBy("j", "k").agg(held).withColumn("i", every(across)).select(group, "held")
    both = a.repartition(across * down, "group").join(b.repartition(across * down, "group").hint("shuffle_hash"), "group")
    return _result(both.select("s1_id", F.inline("held")), name, F.lit(1.0))


def country(ref: DataFrame, tgt: DataFrame) -> DataFrame:
    """A filter rather than a blocker: the fan-out is that of the countries.  Never on by default."""
    return dealt_key(ref, tgt, "country", F.col("country_norm"))


def name_country(ref: DataFrame, tgt: DataFrame) -> DataFrame:
    key = [F.col("name_norm"), F.col("country_norm")]
    return equal_key(ref, tgt, "name_country", key, key)


def _useful(column: str, stopwords: tuple[str, ...]) -> Column:
    return F.filter(column, lambda t: (F.length(t) > 1) & ~t.isin(*stopwords))


def _share(shared: Column, total: Column) -> Column:
    return shared / F.greatest(total, F.lit(1))


def _shared_tokens(ref: DataFrame, tgt: DataFrame, column: str, stopwords: tuple[str, ...], min_shared: int, name: str) -> DataFrame:
    """Shared token occurrences (bags: repeats multiply), over the reference's meaningful ones."""
    useful = _useful(column, stopwords)
    pairs = shared_counts(ref, tgt, [Bag(useful, F.col(column), min_shared)])
    return _result(pairs, name, _share(F.col("shared_0"), F.col("total_0")))


def token_name(ref: DataFrame, tgt: DataFrame, min_shared: int = 1) -> DataFrame:
    return _shared_tokens(ref, tgt, "name_tokens", NAME_STOPWORDS, min_shared, "token_name")


def address_token(ref: DataFrame, tgt: DataFrame, min_shared: int = 2) -> DataFrame:
    return _shared_tokens(ref, tgt, "address_tokens", ADDRESS_STOPWORDS, min_shared, "address_token")


def rare_token(ref: DataFrame, tgt: DataFrame, max_df: int = 10) -> DataFrame:
    """Tokens with at most max_df occurrences in the target source; the last shared one sets the score."""
    long = F.filter("name_tokens", lambda t: F.length(t) > 2)
    b = tgt.select(F.col("entity_id").alias("candidate_id"), F.col("source").alias("candidate_source"), long.alias("tokens"))
    df = b.select("candidate_source", F.explode("tokens").alias("token"))
    df = df.groupBy("candidate_source", "token").agg(F.count("*").alias("df")).filter(F.col("df") <= max_df)
    b = b.select("candidate_id", "candidate_source", F.explode(F.array_distinct("tokens")).alias("token")).join(df, ["candidate_source", "token"])
    a = ref.select(F.col("entity_id").alias("s1_id"), "name_tokens", F.explode(F.array_distinct("name_tokens")).alias("token"))
    last = F.size("name_tokens") - F.array_position(F.reverse("name_tokens"), F.col("token"))
    a = a.select("s1_id", "token", last.alias("pos"))
    pairs = a.join(b, "token").groupBy(*PAIR).agg(F.max_by(1 / F.col("df"), "pos").alias("score"))
    return _result(pairs, "rare_token", F.col("score"))


def tfidf_name(ref: DataFrame, tgt: DataFrame, top_k: int = 30, min_score: float = 0.15, max_features: int = 50_000) -> DataFrame:
    """Cosine of word 1- and 2-gram TF-IDF vectors, fitted on each target source."""
    return _cosine(ref, tgt, word_grams(F.col("name_norm"), 1, 2), top_k, min_score, max_features, "tfidf_name")


def char_ngram(ref: DataFrame, tgt: DataFrame, top_k: int = 50, min_score: float = 0.1, max_features: int = 50_000) -> DataFrame:
    """Cosine of character 3- and 4-gram TF-IDF vectors within words."""
    return _cosine(ref, tgt, char_wb_grams(F.col("name_norm"), 3, 4), top_k, min_score, max_features, "char_ngram")


def _cosine(ref: DataFrame, tgt: DataFrame, terms: Column, top_k: int, min_score: float, max_features: int, name: str) -> DataFrame:
    a = ref.select(F.col("entity_id").alias("query"), terms.alias("terms"))
    b = tgt.select(F.col("entity_id").alias("id"), F.col("source").alias("part"), terms.alias("terms"))
    pairs = cosine_top_k(a, b, top_k, min_score, max_features)
    return _result(
        pairs.select(F.col("query").alias("s1_id"), F.col("id").alias("candidate_id"), F.col("part").alias("candidate_source"), "score"),
        name, F.col("score"),
    )


def fuzzy_top_k(ref: DataFrame, tgt: DataFrame, top_k: int = 20, min_score: float = 60.0, variant: str = "installed") -> DataFrame:
    """The best top_k target records of each reference record and source by the names' weighted ratio, of those with min_score or more.

    Distinct names are scored once, not records, in a product of chunks; of a name's records only the first top_k can count.
    """
    a = ref.filter("name_norm <> ''").select(F.col("entity_id").alias("s1_id"), F.col("name_norm").alias("a"))
    b = tgt.filter("name_norm <> ''").select(F.col("entity_id").alias("id"), F.col("source").alias("part"), F.col("name_norm").alias("b"))
    scored = best_names(a, b, top_k, min_score, sequence_ratio if variant == "fallback" else None)
    first = b.withColumn("rank", F.row_number().over(W.partitionBy("part", "b").orderBy("id"))).filter(F.col("rank") <= top_k)
    first = first.select(F.col("id").alias("candidate_id"), F.col("part").alias("candidate_source"), F.col("b").alias("name"))
    found = scored.join(first, F.col("part").eqNullSafe(F.col("candidate_source")) & (F.col("b") == F.col("name")))
    best = W.partitionBy("s1_id", "candidate_source").orderBy(F.desc("score"), "candidate_id")
    pairs = a.join(found, "a").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_k)
    return _result(pairs, "fuzzy_topk", F.col("score"))


BLOCKERS = {
    "exact_name": exact_name,
    "exact_compact_name": exact_compact_name,
    "token_name": token_name,
    "rare_token": rare_token,
    "postal": postal,
    "country": country,
    "name_country": name_country,
    "address_token": address_token,
    "char_ngram": char_ngram,
    "tfidf_name": tfidf_name,
    "fuzzy_topk": fuzzy_top_k,
}


def _key(key: Column) -> Bag:
    tokens = F.when(key != "", F.array(key))
    return Bag(tokens, tokens)


# Blockers whose pairs are made together, in one product: each as a bag of tokens and whether its score is the share of them.
TOGETHER = {
    exact_name: lambda: (_key(F.trim("name_norm")), False),
    exact_compact_name: lambda: (_key(F.col("name_compact")), False),
    postal: lambda: (_key(F.col("postal")), False),
    token_name: lambda: (Bag(_useful("name_tokens", NAME_STOPWORDS), F.col("name_tokens"), 1), True),
    address_token: lambda: (Bag(_useful("address_tokens", ADDRESS_STOPWORDS), F.col("address_tokens"), 2), True),
}


@dataclass
class CandidateSet:
    """Deduplicated candidate pairs with their provenance."""

    frame: DataFrame  # s1_id, candidate_id, candidate_source, blockers (sorted array), block_scores (map)

    @classmethod
    def of(cls, hits: DataFrame) -> CandidateSet:
        """From blocker results; each pair once, whatever found it."""
        per = hits.groupBy(*PAIR, "blocker").agg(F.max("block_score").alias("block_score"))
        frame = per.groupBy(*PAIR).agg(
            F.array_sort(F.collect_set("blocker")).alias("blockers"),
            F.map_from_entries(F.collect_list(F.struct("blocker", "block_score"))).alias("block_scores"),
        )
        return cls(frame)

    def merge(self, other: CandidateSet) -> CandidateSet:
        hits = None
        for one in (self, other):
            part = one.frame.select(*PAIR, F.explode("block_scores").alias("blocker", "block_score"))
            hits = part if hits is None else hits.unionByName(part)
        return CandidateSet.of(hits)

    def candidates_for(self, s1_id: str) -> DataFrame:
        return self.frame.filter(F.col("s1_id") == s1_id)

    def contains(self, s1_id: str, candidate_id: str) -> bool:
        return not self.frame.filter((F.col("s1_id") == s1_id) & (F.col("candidate_id") == candidate_id)).isEmpty()

    def table(self) -> DataFrame:
        """The flat form: block_count and the blockers joined by commas."""
        return self.frame.select(*PAIR, F.size("blockers").alias("block_count"), F.array_join("blockers", ",").alias("blockers"))

    def candidate_map(self) -> DataFrame:
        return self.frame.groupBy("s1_id").agg(F.array_sort(F.collect_set("candidate_id")).alias("candidates"))


def together(blockers: list[str]) -> bool:
    """Whether one product makes the pairs of all these blockers."""
    return bool(blockers) and all(BLOCKERS[name] in TOGETHER for name in blockers)


def generate(ref: DataFrame, targets: DataFrame, blockers: list[str]) -> CandidateSet:
    """The union of all named blockers over all targets."""
    names = sorted(set(blockers))
    if together(names):
        return _together(ref, targets, names)
    hits = None
    for name in blockers:
        part = BLOCKERS[name](ref, targets)
        hits = part if hits is None else hits.unionByName(part)
    return CandidateSet.of(hits)


def _together(ref: DataFrame, targets: DataFrame, names: list[str]) -> CandidateSet:
    """One product for all blockers: each pair is made once, with what found it."""
    bags = [TOGETHER[BLOCKERS[name]]() for name in names]
    pairs = shared_counts(ref, targets, [bag for bag, _ in bags])
    found, scores = [], []
    for k, (name, (bag, share)) in enumerate(zip(names, bags, strict=True)):
        shared = F.col(f"shared_{k}")
        score = _share(shared, F.col(f"total_{k}")) if share else F.lit(1.0)
        found.append(F.when(shared >= bag.least, F.lit(name)))
        scores.append(F.when(shared >= bag.least, F.struct(F.lit(name).alias("blocker"), score.alias("block_score"))))
    blockers, block_scores = F.array_compact(F.array(*found)), F.map_from_entries(F.array_compact(F.array(*scores)))
    return CandidateSet(pairs.select(*PAIR, blockers.alias("blockers"), block_scores.alias("block_scores")))


def _bags(blockers: list[str]) -> list[Bag]:
    return [TOGETHER[BLOCKERS[name]]()[0] for name in sorted(set(blockers))]


def strong(ref: DataFrame, targets: DataFrame, blockers: list[str], floor: Floor, digits: int | None = None) -> DataFrame:
    """(s1_id, candidate_id, score) of the union's pairs with a rule score of the floor or more (or less by rounding); no other pair is made."""
    return pair_scores(ref, targets, _bags(blockers), floor, digits)


def strong_lists(ref: DataFrame, targets: DataFrame, blockers: list[str], floor: Floor, sure: float, ids: bool = True) -> DataFrame:
    """The same pairs as rows of ``products.pair_lists``."""
    return pair_lists(ref, targets, _bags(blockers), floor, sure, ids)


def featured(
    ref: DataFrame, targets: DataFrame, blockers: list[str], provenance: dict[str, str], names: tuple[str, ...], every: bool = False, digits: int | None = None,
) -> DataFrame:
    """(s1_id, candidate_id, *names) of the union's pairs: features are made where pairs are found.  every: names are all of them."""
    return pair_features(ref, targets, _bags(blockers), tuple(sorted(set(blockers))), provenance, names, every, digits)


def counted(ref: DataFrame, targets: DataFrame, blockers: list[str], highest: dict[str, float], truth: DataFrame) -> DataFrame:
    """(code, label, n) of ``products.pair_cells`` for the union's pairs."""
    return pair_cells(ref, targets, _bags(blockers), tuple(sorted(set(blockers))), highest, truth)


def valued(ref: DataFrame, targets: DataFrame, blockers: list[str], highest: dict[str, float], bins, known, values) -> DataFrame:
    """(s1_id, candidate_id, score) of ``products.pair_values`` for the union's pairs."""
    return pair_values(ref, targets, _bags(blockers), tuple(sorted(set(blockers))), highest, bins, known, values)


def steps(ref: DataFrame, targets: DataFrame, blockers: list[str], floor: Floor, grid: tuple[float, ...], digits: int) -> DataFrame:
    """(s1_id, step, n) of ``products.pair_tallies`` for the union's pairs."""
    return pair_tallies(ref, targets, _bags(blockers), floor, grid, digits)


def best(ref: DataFrame, targets: DataFrame, blockers: list[str], floor: Floor, digits: int) -> DataFrame:
    """(s1_id, candidate_id, score) of ``products.pair_best`` for the union's pairs."""
    return pair_best(ref, targets, _bags(blockers), floor, digits)


def listed(ref: DataFrame, targets: DataFrame, blockers: list[str]) -> DataFrame:
    """(s1_id, ids) of ``products.id_lists`` for the union's pairs."""
    return id_lists(ref, targets, _bags(blockers))


def negatives(ref: DataFrame, targets: DataFrame, blockers: list[str], truth: DataFrame, seed: int = 42) -> DataFrame:
    """(s1_id, candidate_id) of ``products.pair_negatives`` for the union's pairs."""
    return pair_negatives(ref, targets, _bags(blockers), tuple(sorted(set(blockers))), truth, seed)


def total(ref: DataFrame, targets: DataFrame, blockers: list[str], records: bool = False) -> DataFrame:
    """(total_candidates): the size of the union, whose pairs (of ids or of records) are counted where they are found."""
    return pair_count(ref, targets, _bags(blockers), records).select(F.col("pairs").alias("total_candidates"))


def among(pairs: DataFrame, ref: DataFrame, targets: DataFrame, blockers: list[str]) -> DataFrame:
    """Those of pairs (s1_id, candidate_id) that the union holds: each is looked up by its two records, the union is not made."""
    bags = _bags(blockers)
    a = _side(ref, {"s1_id": "entity_id"}, [b.ref for b in bags])
    b = _side(targets, {"candidate_id": "entity_id"}, [b.tgt for b in bags])
    names = [f"t{k}" for k in range(len(bags))]
    both = pairs.join(a.withColumnsRenamed({n: f"a_{n}" for n in names}), "s1_id").join(b.withColumnsRenamed({n: f"b_{n}" for n in names}), "candidate_id")

    def shared(name: str) -> Column:
        return F.aggregate(f"a_{name}", F.lit(0), lambda s, t: s + F.size(F.filter(f"b_{name}", lambda x: x == t)))

    held = F.lit(False)
    for n, bag in zip(names, bags, strict=True):
        held = held | (shared(n) >= bag.least)
    return both.filter(held).select(*pairs.columns)

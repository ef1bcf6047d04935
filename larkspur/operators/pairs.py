"""Pair features, rule scores, decisions and their evaluation (library convention)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larkspur.functions import similarity as S
from larkspur.functions.normalize import grams
from larkspur.operators.bounds import Floor
from larkspur.operators.tabular import draw

# Provenance flags and the blockers that they stand for.
PROVENANCE = {
    "block_exact_name": "exact_name", "block_token_name": "token_name", "block_rare_token": "rare_token",
    "block_char_ngram": "char_ngram", "block_tfidf": "tfidf_name", "block_fuzzy": "fuzzy_topk", "block_postal": "postal",
    "block_address": "address_token", "block_country": "country",
}
# The rule scorer's weights.
RULE_WEIGHTS = {
    "name_edit_sim": 0.35, "name_jaro_winkler": 0.10, "name_token_jaccard": 0.15, "name_compact_exact": 0.05,
    "addr_edit_sim": 0.10, "addr_token_jaccard": 0.10, "addr_postal_match": 0.05, "country_norm_exact": 0.05,
    "evidence_strength": 0.05,
}
# The features in their order.
FEATURES = (
    "name_exact", "name_norm_exact", "name_compact_exact", "name_edit_sim", "name_jaro_winkler", "name_token_jaccard",
    "name_token_overlap", "name_token_dice", "name_token_containment", "name_char3_sim", "name_char4_sim",
    "name_prefix_match", "name_containment", "name_length_ratio", "name_length_diff", "name_token_count_diff", "addr_exact",
    "addr_norm_exact", "addr_edit_sim", "addr_token_jaccard", "addr_token_overlap", "addr_token_containment",
    "addr_char3_sim", "addr_numeric_overlap", "addr_numeric_containment", "addr_postal_match", "addr_length_ratio",
    "addr_length_diff", "addr_token_count_diff", "country_exact", "country_norm_exact", "country_either_missing",
    "s1_name_missing", "cand_name_missing", "s1_addr_missing", "cand_addr_missing", "s1_country_missing",
    "cand_country_missing", "s1_name_token_count", "cand_name_token_count", "s1_addr_token_count", "cand_addr_token_count",
    "block_count", "block_exact_name", "block_token_name", "block_rare_token", "block_char_ngram", "block_tfidf",
    "block_fuzzy", "block_postal", "block_address", "block_country", "name_strong_addr_weak", "name_weak_addr_strong",
    "name_strong_addr_strong", "name_addr_consistency", "postal_name_agreement", "evidence_strength",
)
RECORD_FIELDS = {
    "name_raw": "", "name_norm": "", "name_compact": "", "address_raw": "", "address_norm": "", "postal": "",
    "country_raw": "", "country_norm": "", "name_tokens": None, "address_tokens": None, "numeric_tokens": None,
}


def _lookup(pairs: DataFrame, records: DataFrame, key: str, prefix: str) -> DataFrame:
    """Both sides of a pair as columns; an unknown id is a blank record."""
    side = records.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{prefix}{c}") for c in RECORD_FIELDS])
    joined = pairs.join(side, key, "left")
    blank = {
        f"{prefix}{c}": F.coalesce(f"{prefix}{c}", F.array().cast("array<string>") if v is None else F.lit(v))
        for c, v in RECORD_FIELDS.items()
    }
    return joined.withColumns(blank)


def _flag(condition: Column) -> Column:
    return condition.cast("double")


def pair_features(pairs: DataFrame, records: DataFrame, names: tuple[str, ...] | None = None) -> DataFrame:
    """58 features of candidate pairs (s1_id, candidate_id[, blockers array]), or those of names.

    Both records are joined once; only Jaro-Winkler leaves the JVM.
    """
    known = "blockers" in pairs.columns
    joined = _lookup(_lookup(pairs, records, "s1_id", "a_"), records, "candidate_id", "b_")
    sized = [(side, field, n) for side in "ab" for field, n in (("name_norm", 3), ("name_norm", 4), ("address_norm", 3)) if names is None]
    joined = joined.withColumns({f"{side}_{field}_{n}": grams(F.col(f"{side}_{field}"), n) for side, field, n in sized})

    def both(field: str) -> tuple[Column, Column]:
        return F.col(f"a_{field}"), F.col(f"b_{field}")

    name, address, tokens, places = both("name_norm"), both("address_norm"), both("name_tokens"), both("address_tokens")
    numbers, post = both("numeric_tokens"), both("postal")
    out = {
        "name_exact": S.exact_match(*both("name_raw")),
        "name_norm_exact": S.exact_match(*name),
        "name_compact_exact": S.exact_match(*both("name_compact")),
        "name_edit_sim": S.edit_similarity(*name),
        "name_jaro_winkler": S.jaro_winkler_similarity(*name),
        "name_token_jaccard": S.token_jaccard(*tokens),
        "name_token_overlap": S.token_overlap(*tokens),
        "name_token_dice": S.token_dice(*tokens),
        "name_token_containment": S.token_containment(*tokens),
        "name_char3_sim": S.gram_similarity(*name, *both("name_norm_3")),
        "name_char4_sim": S.gram_similarity(*name, *both("name_norm_4")),
        "name_prefix_match": S.prefix_match(*name),
        "name_containment": S.containment_match(*name),
        "name_length_ratio": S.length_ratio(*name),
        "name_length_diff": S.length_diff(*name),
        "name_token_count_diff": S.token_count_diff(*tokens),
        "addr_exact": S.exact_match(*both("address_raw")),
        "addr_norm_exact": S.exact_match(*address),
        "addr_edit_sim": S.edit_similarity(*address),
        "addr_token_jaccard": S.token_jaccard(*places),
        "addr_token_overlap": S.token_overlap(*places),
        "addr_token_containment": S.token_containment(*places),
        "addr_char3_sim": S.gram_similarity(*address, *both("address_norm_3")),
        "addr_numeric_overlap": S.numeric_token_overlap(*numbers),
        "addr_numeric_containment": S.numeric_containment(*numbers),
        "addr_postal_match": _flag((post[0] != "") & (post[0] == post[1])),
        "addr_length_ratio": S.length_ratio(*address),
        "addr_length_diff": S.length_diff(*address),
        "addr_token_count_diff": S.token_count_diff(*places),
        "country_exact": S.exact_match(*both("country_raw")),
        "country_norm_exact": S.exact_match(*both("country_norm")),
        "country_either_missing": _flag((F.col("a_country_norm") == "") | (F.col("b_country_norm") == "")),
        "s1_name_missing": _flag(name[0] == ""),
        "cand_name_missing": _flag(name[1] == ""),
        "s1_addr_missing": _flag(address[0] == ""),
        "cand_addr_missing": _flag(address[1] == ""),
        "s1_country_missing": _flag(F.col("a_country_norm") == ""),
        "cand_country_missing": _flag(F.col("b_country_norm") == ""),
        "s1_name_token_count": F.size(tokens[0]).cast("double"),
        "cand_name_token_count": F.size(tokens[1]).cast("double"),
        "s1_addr_token_count": F.size(places[0]).cast("double"),
        "cand_addr_token_count": F.size(places[1]).cast("double"),
        "block_count": F.size("blockers").cast("double") if known else F.lit(0.0),
    }
    for flag, blocker in PROVENANCE.items():
        out[flag] = _flag(F.array_contains("blockers", blocker)) if known else F.lit(0.0)
    n, a = F.col("name_edit_sim"), F.col("addr_edit_sim")
    mixed = {
        "name_strong_addr_weak": _flag((n > 0.8) & (a < 0.3)),
        "name_weak_addr_strong": _flag((n < 0.5) & (a > 0.7)),
        "name_strong_addr_strong": _flag((n > 0.7) & (a > 0.5)),
        "name_addr_consistency": (n + a) / 2,
        "postal_name_agreement": _flag((F.col("addr_postal_match") == 1) & (n > 0.5)),
        "evidence_strength": F.greatest(n, a, "name_token_jaccard", "addr_token_jaccard"),
    }
    if names is None:
        return joined.select("s1_id", "candidate_id", *[c.alias(n) for n, c in out.items()]).withColumns(mixed)
    parts = {"name_edit_sim", "addr_edit_sim", "name_token_jaccard", "addr_token_jaccard", "addr_postal_match"}
    base = joined.select("s1_id", "candidate_id", *[c.alias(n) for n, c in out.items() if n in parts or n in names])
    return base.withColumns({n: c for n, c in mixed.items() if n in names}).select("s1_id", "candidate_id", *names)


def rule_score(features: DataFrame) -> DataFrame:
    """features plus score: the weighted sum of nine features, clipped to 0..1."""
    total = F.lit(0.0)
    for name, weight in RULE_WEIGHTS.items():
        total = total + weight * F.col(name)
    return features.withColumn("score", F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def rule_floor(least: float) -> Floor:
    """The rule scorer for products, down to least."""
    return Floor(least, tuple(RULE_WEIGHTS.items()))


def resolve(
    scored: DataFrame, match_threshold: float | Column, multi_match_threshold: float | Column | None = None,
    max_matches: int | None = None, by: tuple[str, ...] = (), multi_match_gap: float | None = None,
) -> DataFrame:
    """Kept pairs of each s1_id: the best if it reaches the threshold, others if they reach both.

    Ties go by candidate id.  multi_match_gap is accepted and has no effect, as in the system that
    this reproduces.  by: further columns that separate decisions (as thresholds on a grid do).
    """
    one = match_threshold if isinstance(match_threshold, Column) else F.lit(float(match_threshold))
    more = one if multi_match_threshold is None else multi_match_threshold
    more = F.greatest(one, more if isinstance(more, Column) else F.lit(float(more)))
    rank = F.row_number().over(W.partitionBy(*by, "s1_id").orderBy(F.desc("score"), "candidate_id"))
    # What is under the first threshold is never kept and ranks after what is: it need not be moved.
    ranked = scored.filter(F.col("score") >= one).withColumn("rank", rank)
    kept = ranked.filter(F.col("score") >= F.when(F.col("rank") == 1, one).otherwise(more))
    return kept if max_matches is None else kept.filter(F.col("rank") <= max_matches)


def matches_of(kept: DataFrame, s1: DataFrame, id_col: str = "candidate_id") -> DataFrame:
    """(s1_id, predicted array) for every s1_id, empty arrays included."""
    found = kept.groupBy("s1_id").agg(F.array_sort(F.collect_set(id_col)).alias("predicted"))
    none = F.array().cast("array<string>")
    return s1.select("s1_id").distinct().join(found, "s1_id", "left").withColumn("predicted", F.coalesce("predicted", none))


def _decided(lists: DataFrame, match_threshold: float, multi_match_threshold: float, digits: int | None) -> DataFrame:
    """(s1_id, n, ids, more_ids, best) of ``products.pair_lists``: sure pairs, others that are kept anyway, and the best of the others."""
    score = F.col("score") if digits is None else F.round("score", digits)
    kept = F.when(score >= max(match_threshold, multi_match_threshold), F.col("candidate_id"))
    best = F.min(F.when(score >= match_threshold, F.struct((-score).alias("order"), "candidate_id")))
    sums = [F.sum("n").alias("n"), F.flatten(F.collect_list("ids")).alias("ids"), F.collect_set(kept).alias("more_ids"), best.alias("best")]
    return lists.groupBy("s1_id").agg(*sums)


def lists_of(lists: DataFrame, s1: DataFrame, match_threshold: float, multi_match_threshold: float, digits: int | None = None) -> DataFrame:
    """``matches_of`` the pairs that ``resolve`` keeps, from ``products.pair_lists`` down to the first threshold: no pair is ranked.

    A pair over both thresholds is kept whatever its rank; another one only if its record has none of those and no better one.
    """
    made = _decided(lists, match_threshold, multi_match_threshold, digits)
    none = F.array().cast("array<string>")
    alone = (F.size("ids") == 0) & (F.size("more_ids") == 0) & F.col("best").isNotNull()
    all_ = F.when(alone, F.array("best.candidate_id")).otherwise(F.array_union("ids", "more_ids"))
    found = made.select("s1_id", F.array_sort(all_).alias("predicted"))
    return s1.select("s1_id").distinct().join(found, "s1_id", "left").withColumn("predicted", F.coalesce("predicted", none))


def tallies(
    truth: DataFrame, lists: DataFrame, hits: DataFrame, match_threshold: float, multi_match_threshold: float, distinct: bool = False, digits: int | None = None,
) -> DataFrame:
    """``per_entity`` of the same pairs without their lists: hits are the scored candidates (s1_id, candidate_id, score) that are true.

    distinct: ids repeat, and lists has the ids of sure pairs.
    """
    more = max(match_threshold, multi_match_threshold)
    made = _decided(lists, match_threshold, multi_match_threshold, digits)
    score = F.col("score") if digits is None else F.round("score", digits)
    right = hits.filter(score >= more).groupBy("s1_id").agg(F.count_distinct("candidate_id").alias("right"))
    joined = truth.join(made, "s1_id", "left").join(right, "s1_id", "left")
    many = F.size(F.array_union("ids", "more_ids")) if distinct else F.col("n") + F.size("more_ids")
    many = F.coalesce(many, F.lit(0))
    alone = (many == 0) & F.col("best").isNotNull()
    own = F.coalesce(F.array_contains("truth", F.col("best.candidate_id")), F.lit(False))
    tp = F.coalesce("right", F.lit(0)) + (alone & own).cast("int")
    counted = joined.select("s1_id", tp.cast("int").alias("tp"), F.size("truth").alias("n_truth"), (many + alone.cast("int")).cast("int").alias("n_predicted"))
    return _judged(counted)


def per_entity(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """Per s1_id of truth (s1_id, truth): tp, fp, fn and F0.5; predictions for other ids are ignored."""
    none = F.array().cast("array<string>")
    joined = truth.join(predicted, "s1_id", "left").withColumn("predicted", F.coalesce("predicted", none))
    t, p = F.size("truth"), F.size("predicted")
    return _judged(joined.withColumns({"tp": F.size(F.array_intersect("truth", "predicted")), "n_truth": t, "n_predicted": p}))


def _judged(counted: DataFrame) -> DataFrame:
    t, p = F.col("n_truth"), F.col("n_predicted")
    counted = counted.withColumns({"fp": F.col("n_predicted") - F.col("tp"), "fn": F.col("n_truth") - F.col("tp")})
    # F0.5 = 1.25 P R / (0.25 P + R) = 1.25 tp / (0.25 |truth| + |predicted|)
    score = F.when((t == 0) & (p == 0), 1.0).otherwise(1.25 * F.col("tp") / (0.25 * F.col("n_truth") + F.col("n_predicted")))
    precision = F.when(p > 0, F.col("tp") / p).otherwise(F.when(t == 0, 1.0).otherwise(0.0))
    recall = F.when(t > 0, F.col("tp") / t).otherwise(F.when(p == 0, 1.0).otherwise(0.0))
    return counted.withColumns({"f05": score, "precision": precision, "recall": recall})


def entity_f05(truth: DataFrame, predicted: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Macro F0.5, precision and recall with counters; zeros for an empty truth."""
    return entity_report(per_entity(truth, predicted), by)


def entity_report(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``entity_f05`` of rows per entity."""
    single, empty = F.col("n_truth") == 0, F.col("n_predicted") == 0
    aggregates = [
        F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"),
        F.coalesce(F.avg("precision"), F.lit(0.0)).alias("macro_precision"),
        F.coalesce(F.avg("recall"), F.lit(0.0)).alias("macro_recall"),
        F.count("*").alias("entities"),
        F.count_if(single).alias("singletons"),
        F.count_if(single & empty).alias("singletons_correct"),
        F.coalesce(F.sum("tp"), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("fp"), F.lit(0)).alias("fp"),
        F.coalesce(F.sum("fn"), F.lit(0)).alias("fn"),
        F.coalesce(F.sum(F.when(single, F.col("n_predicted"))), F.lit(0)).alias("false_merges"),
        F.coalesce(F.sum(F.when(empty, F.col("n_truth"))), F.lit(0)).alias("missed"),
    ]
    return rows.groupBy(*by).agg(*aggregates) if by else rows.agg(*aggregates)


def production_f05(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """The production report: macro F0.5, micro precision and recall, singleton rates."""
    return production_report(per_entity(truth, predicted))


def production_report(rows: DataFrame) -> DataFrame:
    """``production_f05`` of rows per entity."""
    single = F.col("n_truth") == 0
    tp, fp, fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
    return rows.agg(
        F.avg("f05").alias("macro_f05"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("micro_precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("micro_recall"),
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"),
        F.count_if(single & (F.col("n_predicted") == 0)).alias("singleton_correct"),
        F.count_if(single & (F.col("n_predicted") > 0)).alias("singleton_false_merge"),
    )


def sorted_candidates(scored: DataFrame, truth: DataFrame, id_col: str = "candidate_id", *more: str) -> DataFrame:
    """(s1_id, t, ranked): each true record with its number of matches and its candidates, best first.

    One shuffle by record; any number of decision rules can then be tried on the array in place.
    """
    true = truth.select("s1_id", F.explode("truth").alias(id_col), F.lit(1).alias("hit"))
    labelled = scored.join(true, ["s1_id", id_col], "left")
    entry = F.struct((-F.col("score")).alias("order"), F.col(id_col).alias("id"), "score", F.coalesce("hit", F.lit(0)).alias("hit"), *more)
    lists = labelled.groupBy("s1_id").agg(F.sort_array(F.collect_list(entry)).alias("ranked"))
    return truth.select("s1_id", F.size("truth").alias("t")).join(lists, "s1_id", "left")


def f05_of(t: Column, p: Column, tp: Column) -> Column:
    return F.when((t == 0) & (p == 0), 1.0).otherwise(1.25 * tp / (0.25 * t + p))


def threshold_grid(scored: DataFrame, truth: DataFrame, low: float = 0.10, high: float = 0.95, step: float = 0.01) -> DataFrame:
    """(threshold, macro_f05) for every threshold of the grid, in one job.

    A pair counts at a threshold t if its score is t or more and, unless it is the best of its
    record, also 0.5 or more.  The grid is a broadcast table of fixed size; pairs are counted by
    record and threshold before they are shuffled.
    """
    n = round((high - low) / step) + 1
    grid = F.broadcast(scored.sparkSession.range(n).select((F.round(F.lit(low) + F.col("id") * step, 4)).alias("threshold")))
    ranked = scored.withColumn("rank", F.row_number().over(W.partitionBy("s1_id").orderBy(F.desc("score"), "candidate_id")))
    true = truth.select("s1_id", F.explode("truth").alias("candidate_id"), F.lit(1).alias("hit"))
    able = ranked.filter((F.col("rank") == 1) | (F.col("score") >= 0.5)).join(true, ["s1_id", "candidate_id"], "left")
    per = able.join(grid, F.col("score") >= F.col("threshold")).groupBy("threshold", "s1_id").agg(F.count("*").alias("p"), F.count("hit").alias("tp"))
    full = truth.select("s1_id", F.size("truth").alias("t")).join(grid, F.lit(True)).join(per, ["threshold", "s1_id"], "left").na.fill(0, ["p", "tp"])
    return full.groupBy("threshold").agg(F.avg(f05_of(F.col("t"), F.col("p"), F.col("tp"))).alias("macro_f05"))


def threshold_steps(low: float = 0.10, high: float = 0.95, step: float = 0.01) -> tuple[float, ...]:
    return tuple(round(low + k * step, 4) for k in range(round((high - low) / step) + 1))


def threshold_sums(steps: tuple[float, ...], tallies: DataFrame, best: DataFrame, hits: DataFrame, truth: DataFrame) -> DataFrame:
    """``threshold_grid`` without its pairs.

    tallies (s1_id, step, n): pairs of 0.5 or more by the last of steps that they reach; best (s1_id, candidate_id, score): the
    best pair of each record that has none of those; hits (s1_id, candidate_id, score): the candidates that are true.
    """
    spark = truth.sparkSession
    last = F.lit(-1)
    for k, t in enumerate(steps):
        last = F.when(F.col("score") >= t, k).otherwise(last)
    right = hits.filter("score >= 0.5").select("s1_id", last.alias("step"), F.lit(0).cast("long").alias("p"), F.lit(1).cast("long").alias("tp"))
    true = truth.select("s1_id", F.explode("truth").alias("candidate_id"), F.lit(1).alias("hit"))
    alone = best.join(true, ["s1_id", "candidate_id"], "left")
    alone = alone.select("s1_id", last.alias("step"), F.lit(1).cast("long").alias("p"), F.coalesce("hit", F.lit(0)).cast("long").alias("tp"))
    found = tallies.select("s1_id", "step", F.col("n").alias("p"), F.lit(0).cast("long").alias("tp")).unionByName(right).unionByName(alone)
    per = found.filter("step >= 0").groupBy("s1_id", "step").agg(F.sum("p").alias("p"), F.sum("tp").alias("tp"))
    lists = per.groupBy("s1_id").agg(F.collect_list(F.struct("step", "p", "tp")).alias("found"))
    grid = F.broadcast(spark.createDataFrame([(k, t) for k, t in enumerate(steps)], "k int, threshold double"))

    def total(field: str) -> Column:
        counted = F.aggregate("found", F.lit(0).cast("long"), lambda s, x: s + F.when(x["step"] >= F.col("k"), x[field]).otherwise(0))
        return F.coalesce(counted, F.lit(0))

    full = truth.select("s1_id", F.size("truth").alias("t")).join(lists, "s1_id", "left").join(grid, F.lit(True))
    return full.groupBy("threshold").agg(F.avg(f05_of(F.col("t"), total("p"), total("tp"))).alias("macro_f05"))


def optimize_threshold(scored: DataFrame, truth: DataFrame) -> tuple[float, float]:
    """The lowest threshold of the best macro F0.5; (0.5, 0.0) if nothing beats 0."""
    best = threshold_grid(scored, truth).orderBy(F.desc(F.round("macro_f05", 12)), "threshold").first()
    return (0.5, 0.0) if best is None or best.macro_f05 <= 0 else (best.threshold, best.macro_f05)


def blocking_metrics(truth: DataFrame, candidates: DataFrame, n_targets: int, total: DataFrame | None = None) -> DataFrame:
    """Recall of true pairs, candidate counts and the reduction against all pairs.

    total (total_candidates): the number of all candidates, where candidates has only the true ones.
    """
    pairs = truth.select("s1_id", F.explode("truth").alias("candidate_id"))
    found = pairs.join(candidates.select("s1_id", "candidate_id", F.lit(1).alias("hit")).distinct(), ["s1_id", "candidate_id"], "left")
    one = found.agg(F.count("*").alias("true_pairs"), F.count("hit").alias("found_pairs"))
    two = candidates.agg(F.count("*").alias("total_candidates")) if total is None else total
    three = truth.agg((F.count("*") * n_targets).alias("possible_pairs"))
    return one.join(two, F.lit(True)).join(three, F.lit(True)).select(
        "true_pairs", "found_pairs", "total_candidates", "possible_pairs",
        F.when(F.col("true_pairs") == 0, 1.0).otherwise(F.try_divide("found_pairs", "true_pairs")).alias("recall"),
        F.coalesce(1 - F.try_divide("total_candidates", "possible_pairs"), F.lit(0.0)).alias("reduction_ratio"),
    )


def missed_pairs(truth: DataFrame, candidates: DataFrame, most: int = 100) -> DataFrame:
    pairs = truth.select("s1_id", F.explode("truth").alias("candidate_id"))
    return pairs.join(candidates, ["s1_id", "candidate_id"], "left_anti").orderBy("s1_id", "candidate_id").limit(most)


def production_blocking_report(truth: DataFrame, candidates: DataFrame, s1: DataFrame, n_targets: int) -> DataFrame:
    """Pair recall, share of matched records whose every match is a candidate, reduction, mean candidates."""
    keys = s1.select("s1_id").distinct()
    pairs = truth.join(keys, "s1_id", "left_semi").select("s1_id", F.explode("truth").alias("candidate_id"))
    hits = candidates.select("s1_id", "candidate_id").distinct().withColumn("hit", F.lit(1))
    found = pairs.join(hits, ["s1_id", "candidate_id"], "left")
    per = found.groupBy("s1_id").agg(F.count("*").alias("n"), F.count("hit").alias("k"))
    one = per.agg(
        F.coalesce(F.try_divide(F.sum("k"), F.sum("n")), F.lit(1.0)).alias("pair_recall"),
        F.coalesce(F.avg((F.col("n") == F.col("k")).cast("double")), F.lit(1.0)).alias("full_coverage_rate"),
    )
    two = hits.join(keys, "s1_id", "left_semi").agg(F.count("*").alias("candidates"))
    three = keys.agg(F.count("*").alias("entities"))
    return one.join(two, F.lit(True)).join(three, F.lit(True)).select(
        "pair_recall", "full_coverage_rate", "candidates", "entities",
        (F.col("candidates") / F.col("entities")).alias("mean_candidates"),
        (1 - F.col("candidates") / (F.col("entities") * n_targets)).alias("reduction_ratio"),
    )


def pair_metrics(rows: DataFrame, label: Column, predicted: Column) -> DataFrame:
    """Accuracy, precision, recall, F1 and F0.5 of 0/1 labels and predictions."""
    tp, fp = F.count_if((label == 1) & (predicted == 1)), F.count_if((label == 0) & (predicted == 1))
    fn, tn = F.count_if((label == 1) & (predicted == 0)), F.count_if((label == 0) & (predicted == 0))
    return pair_report(rows.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn")))


def pair_report(counts: DataFrame) -> DataFrame:
    """``pair_metrics`` of one row of counts."""

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    t, p, n, z = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    return counts.select(
        "tp", "fp", "fn", "tn",
        ratio(t + z, t + p + n + z).alias("accuracy"),
        ratio(t, t + p).alias("precision"),
        ratio(t, t + n).alias("recall"),
        ratio(2 * t, 2 * t + p + n).alias("f1"),
        ratio(1.25 * t, 1.25 * t + 0.25 * n + p).alias("f05"),
    )


def error_table(truth: DataFrame, predicted: DataFrame, most: int = 15) -> DataFrame:
    """The entities with most false positives, then most misses."""
    return error_rows(per_entity(truth, predicted), most)


def error_rows(rows: DataFrame, most: int = 15) -> DataFrame:
    """``error_table`` of rows per entity."""
    rows = rows.filter("fp > 0 OR fn > 0")
    return rows.select("s1_id", "tp", "fp", "fn").orderBy(F.desc("fp"), F.desc("fn"), "s1_id").limit(most)


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs plus label: 1 if the candidate is in the truth."""
    true = truth.select("s1_id", F.explode("truth").alias("candidate_id"), F.lit(1).alias("label")).distinct()
    return pairs.join(true, ["s1_id", "candidate_id"], "left").na.fill(0, ["label"])


def hard_negatives(featured: DataFrame, truth: DataFrame, seed: int = 42) -> DataFrame:
    """Training pairs: all positives; of the negatives the 2n nearest by name and random others, 3n in all.

    n counts the truth, not what was found; at least one negative is kept.  The draw is by hash.
    """
    labelled = label_pairs(featured, truth).join(truth.select("s1_id", F.size("truth").alias("n_true")), "s1_id")
    limit = F.greatest(F.col("n_true") * 3, F.lit(1))
    near = F.row_number().over(W.partitionBy("s1_id", "label").orderBy(F.desc("name_edit_sim"), "candidate_id"))
    ranked = labelled.withColumn("near", near).withColumn("hard", F.col("near") <= F.col("n_true") * 2)
    place = F.row_number().over(W.partitionBy("s1_id", "label", "hard").orderBy(draw(seed, "s1_id", "candidate_id")))
    ranked = ranked.withColumn("draw", place)
    rest = limit - F.least(F.col("n_true") * 2, limit)
    keep = (F.col("label") == 1) | F.col("hard") & (F.col("near") <= limit) | ~F.col("hard") & (F.col("draw") <= rest)
    return ranked.filter(keep).drop("near", "hard", "draw", "n_true")

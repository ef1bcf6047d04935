"""Sparse TF-IDF vectors in long form: (row, term, weight) instead of matrices.

Weights are (1 + ln tf) * (ln((1 + N) / (1 + df)) + 1), rows scaled to unit length.  The vocabulary
is the max_features terms of highest total count, ties by term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def word_tokens(text: Column) -> Column:
    """Lowered words of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b(\w\w+)\b"), 1)


def word_grams(text: Column, low: int, high: int) -> Column:
    tokens = word_tokens(text)

    def of(n: int) -> Column:
        places = F.sequence(F.lit(1), F.size(tokens) - n + 1)
        joined = F.transform(places, lambda i: F.array_join(F.slice(tokens, i, n), " "))
        return F.when(F.size(tokens) >= n, joined).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of(n) for n in range(low, high + 1)])


def _windows(word: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word) - n + 1), lambda i: F.substring(word, i, n))


def char_wb_grams(text: Column, low: int, high: int) -> Column:
    """Character windows of words with one blank on either side; a word too short for a size gives itself once and ends there."""
    words = F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def of(n: int) -> Column:
        if n == low:
            return F.flatten(F.transform(padded, lambda w: F.when(F.length(w) <= n, F.array(w)).otherwise(_windows(w, n))))
        return F.flatten(F.transform(F.filter(padded, lambda w: F.length(w) >= n), lambda w: _windows(w, n)))

    return F.concat(*[of(n) for n in range(low, high + 1)])


def term_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, term, tf) from rows (keys, terms)."""
    return rows.select(*keys, F.explode("terms").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def fit_idf(counts: DataFrame, totals: DataFrame, parts: list[str], max_features: int) -> DataFrame:
    """(parts, term, idf) of the vocabulary of each part."""
    df = counts.groupBy(*parts, "term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    order = W.partitionBy(*parts).orderBy(F.desc("total"), "term")
    kept = df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max_features)
    idf = F.log((1 + F.col("rows")) / (1 + F.col("df"))) + 1
    joined = kept.join(F.broadcast(totals), parts) if parts else kept.join(F.broadcast(totals), F.lit(True))
    return joined.select(*parts, "term", idf.alias("idf"))


def weigh(counts: DataFrame, idf: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """(keys, parts, term, weight) with unit rows."""
    raw = counts.join(idf, [*parts, "term"] if set(parts) <= set(counts.columns) else ["term"])
    raw = raw.withColumn("w", (1 + F.log("tf")) * F.col("idf"))
    norms = raw.groupBy(*keys, *[p for p in parts if p not in keys]).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    by = [*keys, *[p for p in parts if p not in keys]]
    return raw.join(norms, by).select(*by, "term", (F.col("w") / F.col("norm")).alias("weight"))


def tfidf(rows: DataFrame, key: str, terms: Column, max_features: int = 50_000) -> DataFrame:
    """(key, term, weight) of one text column's terms, fitted on the same rows."""
    lists = rows.select(key, terms.alias("terms"))
    counts = term_counts(lists, [key])
    idf = fit_idf(counts, lists.agg(F.count("*").alias("rows")), [], max_features)
    return weigh(counts, idf, [key], [])


#: Records of a chunk: queries are streamed past targets, which a task holds inverted.
QUERY_ROWS, LEAST_ROWS, TARGET_ROWS = 65_536, 2_048, 65_536


def cosine_top_k(queries: DataFrame, targets: DataFrame, top_k: int, min_score: float, max_features: int) -> DataFrame:
    """queries (query, terms), targets (id, part, terms) -> (query, part, id, score).

    Fitted on the targets of each part; the best top_k of each query and part, then those of
    min_score or more; ties by id.  Pairs without a common term score 0 and never appear.

    The vocabulary (max_features a part) is collected.  Vectors are a product of sparse matrices: records are moved once for each
    chunk of the other side, and of a chunk's pairs only the best top_k of a query leave the task.
    """
    spark = targets.sparkSession
    theirs = targets.groupBy("id", "part").agg(F.flatten(F.collect_list("terms")).alias("terms"))
    mine = queries.groupBy(F.col("query").alias("id")).agg(F.flatten(F.collect_list("terms")).alias("terms"))
    counts = theirs.select("part", F.explode("terms").alias("term")).groupBy("part", "term").agg(F.count("*").alias("total"))
    held = theirs.select("part", F.explode(F.array_distinct("terms")).alias("term")).groupBy("part", "term").agg(F.count("*").alias("df"))
    order = W.partitionBy("part").orderBy(F.desc("total"), "term")
    kept = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max_features).join(held, ["part", "term"])
    totals = targets.groupBy("part").agg(F.count("*").alias("rows"))
    idf = kept.join(F.broadcast(totals), "part").select("part", "term", (F.log((1 + F.col("rows")) / (1 + F.col("df"))) + 1).alias("idf"))
    vocabulary: dict = {}
    for row in idf.collect():
        vocabulary.setdefault(row.part, {})[row.term] = row.idf
    words = {part: (pa.array(list(terms), pa.string()), np.array(list(terms.values()))) for part, terms in vocabulary.items()}

    kind, id_kind, query_kind = (dict(x.dtypes)[c] for x, c in ((targets, "part"), (targets, "id"), (queries, "query")))
    n = queries.count()
    down = max(1, -(-targets.count() // TARGET_ROWS))
    tasks = -(-2 * spark.sparkContext.defaultParallelism // (down * max(1, len(words))))
    across = max(1, -(-n // QUERY_ROWS), min(-(-n // LEAST_ROWS), tasks))
    parts = spark.createDataFrame([(p,) for p in sorted(words)], f"part {kind}")
    a = mine.withColumn("i", F.pmod(F.xxhash64("id"), F.lit(across))).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))).join(F.broadcast(parts), F.lit(True))
    b = theirs.withColumn("j", F.pmod(F.xxhash64("id"), F.lit(down))).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    columns = [F.col("part"), F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"), F.col("terms")]
    none_q, none_t = F.lit(None).cast(query_kind), F.lit(None).cast(id_kind)
    rows = b.select(*columns, none_q.alias("query"), F.col("id"), F.lit(False).alias("late"))
    rows = rows.unionByName(a.select(*columns, F.col("id").alias("query"), none_t.alias("id"), F.lit(True).alias("late")))
    rows = rows.repartition(max(1, across * down * len(words)), "part", "i", "j").sortWithinPartitions("part", "i", "j", "late")
    made = T.StructType([T.StructField("query", queries.schema["query"].dataType), T.StructField("part", targets.schema["part"].dataType), T.StructField("id", targets.schema["id"].dataType), T.StructField("score", T.DoubleType())])
    arrow = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, kept, chunk = None, [], None
        for whole in batches:
            keys = list(zip(*(whole[c].to_pylist() for c in ("part", "i", "j", "late")), strict=True))
            cuts = [k for k in range(1, len(keys)) if keys[k] != keys[k - 1]]
            for start, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if start == end:
                    continue
                if keys[start][:3] != group:
                    group, kept, chunk = keys[start][:3], [], None
                piece = whole.slice(start, end - start)
                if not keys[start][3]:
                    kept.append(piece)
                elif kept or chunk:
                    chunk = chunk or _Chunk(pa.Table.from_batches(kept), *words[group[0]])
                    kept = []
                    found = chunk.best(piece, top_k, min_score)
                    if found is not None:
                        at, ids, scores = found
                        yield pa.RecordBatch.from_arrays([piece["query"].take(at), pa.array([group[0]] * len(at), arrow.field("part").type), ids, pa.array(scores)], schema=arrow)

    found = rows.mapInArrow(run, made)
    best = W.partitionBy("query", "part").orderBy(F.desc(F.round("score", 12)), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_k)
    return ranked.filter(F.col("score") >= min_score).select("query", "part", "id", "score")


def _vectors(terms: pa.Array, words: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, codes, weights) of the known terms, by row; rows are of unit length."""
    terms = terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms
    lengths = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
    codes = pc.fill_null(pc.index_in(terms.flatten(), value_set=words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(terms)), lengths)
    keys, tf = np.unique((rows * len(words) + codes)[codes >= 0], return_counts=True)
    rows, codes = keys // len(words), keys % len(words)
    weights = (1 + np.log(tf)) * idf[codes]
    norms = np.sqrt(np.bincount(rows, weights * weights, minlength=len(terms)))
    return rows, codes, weights / norms[rows]


class _Chunk:
    """The inverted vectors of a chunk of targets."""

    def __init__(self, table: pa.Table, words: pa.Array, idf: np.ndarray) -> None:
        self.words, self.idf, self.ids = words, idf, table["id"].combine_chunks()
        self.places = np.empty(len(table), dtype=np.int64)
        self.places[pc.sort_indices(self.ids).to_numpy(zero_copy_only=False)] = np.arange(len(table))
        rows, codes, weights = _vectors(table["terms"], words, idf)
        order = np.argsort(codes, kind="stable")
        self.rows, self.weights = rows[order], weights[order]
        self.starts = np.searchsorted(codes[order], np.arange(len(words) + 1))

    def best(self, queries: pa.RecordBatch, top_k: int, min_score: float) -> tuple[pa.Array, pa.Array, np.ndarray] | None:
        """Rows of queries, ids and scores of the best top_k targets each, ties by id."""
        rows, codes, weights = _vectors(queries["terms"], self.words, self.idf)
        ends = np.searchsorted(rows, np.arange(len(queries) + 1))
        out = []
        for r in range(len(queries)):
            own = range(ends[r], ends[r + 1])
            if not own:
                continue
            spans = [(self.starts[codes[k]], self.starts[codes[k] + 1], weights[k]) for k in own]
            at = np.concatenate([self.rows[a:b] for a, b, _ in spans])
            if not len(at):
                continue
            scores = np.bincount(at, np.concatenate([self.weights[a:b] * w for a, b, w in spans]), minlength=len(self.places))
            near = np.flatnonzero(scores >= max(min_score - 1e-9, 1e-15))
            rounded = np.round(scores[near], 12)
            if len(near) > top_k:
                least = np.partition(rounded, -top_k)[-top_k]
                over, ties = near[rounded > least], near[rounded == least]
                near = np.concatenate([over, ties[np.argsort(self.places[ties], kind="stable")][: top_k - len(over)]])
            if len(near):
                out.append((np.full(len(near), r), near, scores[near]))
        if not out:
            return None
        at, ids, scores = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.array(at), self.ids.take(pa.array(ids)), scores

"""Registered queries of the tabular operators and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.vectors import tfidf, word_grams
from larkspur.operators import audit, ensemble, metrics, models, splits, submission, tabular
from larkspur.plans import data
from larkspur.plans import oracle as O

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def rounded(rows: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return rows.withColumns({n: F.round(n, digits) for n in names})


# Predictions that both sides can compute: a price guessed from quantity and discount.
GUESS = "(1400 * l_quantity * (1 - l_discount) + 100 * l_linenumber)"
GUESSES = f"""WITH g AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice AS y, {GUESS} AS p, (l_returnflag = 'R')::INT AS c,
         (l_quantity > 25)::INT AS d, round(l_discount * 10 - l_tax, 2) / 1.1 AS s
  FROM lineitem)"""


def guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = data.table(spark, sf_dir, "lineitem")
    return line.select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        F.col("l_extendedprice").alias("y"),
        F.expr(GUESS).alias("p"),
        (F.col("l_returnflag") == "R").cast("int").alias("c"),
        (F.col("l_quantity") > 25).cast("int").alias("d"),
        (F.round(F.col("l_discount") * 10 - F.col("l_tax"), 2) / 1.1).alias("s"),
    )


# ---- metrics ---------------------------------------------------------------------------------

REGRESSION = {
    "m_smape": ("smape", "avg(200 * abs(p - y) / (abs(y) + abs(p) + 1e-8))"),
    "m_mape": ("mape", "avg(100 * abs((y - p) / (abs(y) + 1e-8)))"),
    "m_mae": ("mae", "avg(abs(y - p))"),
    "m_mse": ("mse", "avg((y - p) ** 2)"),
    "m_rmse": ("rmse", "sqrt(avg((y - p) ** 2))"),
    "m_rmsle": ("rmsle", "sqrt(avg((ln(1 + greatest(p, 0)) - ln(1 + greatest(y, 0))) ** 2))"),
    "m_r2": ("r2", "1 - sum((y - p) ** 2) / (var_pop(y) * count(y))"),
}


def _regression(name: str):
    def run(spark, sf_dir):
        digits = 2 if name == "mse" else 6
        return metrics.get_metric(name).run(guesses(spark, sf_dir), "y", "p").select(F.round(name, digits).alias(name))

    return run


for _key, (_name, _sql) in REGRESSION.items():
    QUERIES[_key] = _regression(_name)
    ORACLES[_key] = f"{GUESSES} SELECT round({_sql}, {2 if _name == 'mse' else 6}) AS {_name} FROM g"


@query(
    GUESSES + """, cl AS (SELECT unnest([0, 1]) AS k),
    per AS (SELECT k, count(*) FILTER (WHERE c = k) AS t, count(*) FILTER (WHERE d = k) AS p, count(*) FILTER (WHERE c = k AND d = k) AS hit FROM g, cl GROUP BY k),
    f AS (SELECT *, 2 * hit / (t + p)::DOUBLE AS f1 FROM per), n AS (SELECT count(*)::DOUBLE AS n FROM g)
    SELECT round(sum(hit) / any_value(n), 6) AS accuracy, round(avg(f1), 6) AS f1_macro, round(sum(f1 * t) / any_value(n), 6) AS f1_weighted,
    round((sum(hit) / any_value(n) - sum(t * p / n / n)) / (1 - sum(t * p / n / n)), 6) AS kappa FROM f, n"""
)
def m_class_scores(spark, sf_dir):
    return rounded(metrics.class_scores(guesses(spark, sf_dir), "c", "d"), "accuracy", "f1_macro", "f1_weighted", "kappa")


@query(GUESSES + " SELECT round(2 * count(*) FILTER (WHERE c = 1 AND d = 1) / (sum(c) + sum(d))::DOUBLE, 6) AS f1_binary FROM g")
def m_f1_binary(spark, sf_dir):
    return rounded(metrics.f1_binary(guesses(spark, sf_dir), "c", "d"), "f1_binary")


@query(
    GUESSES + """, s AS (SELECT s, sum(c) AS pos, sum(1 - c) AS neg FROM g GROUP BY s),
    r AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS ap, sum(neg) OVER () AS an FROM s WINDOW w AS (ORDER BY s DESC))
    SELECT round(sum((2 * tp - pos) / 2.0 * neg / (ap * an)::DOUBLE), 6) AS roc_auc,
    round(sum(pos / ap::DOUBLE * (tp / (tp + fp)::DOUBLE + CASE WHEN tp - pos + fp - neg > 0 THEN (tp - pos) / (tp - pos + fp - neg)::DOUBLE ELSE 1 END) / 2), 6) AS pr_auc,
    round(sum(pos / ap::DOUBLE * tp / (tp + fp)::DOUBLE), 6) AS average_precision FROM r"""
)
def m_ranking(spark, sf_dir):
    return rounded(metrics.ranking_scores(guesses(spark, sf_dir), "c", "s"), "roc_auc", "pr_auc", "average_precision")


@query(
    GUESSES + """, q AS (SELECT c, greatest(least(1 / (1 + exp(-s)), 1 - 1e-15), 1e-15) AS q FROM g)
    SELECT round(avg(-(c * ln(q) + (1 - c) * ln(1 - q))), 6) AS log_loss FROM q"""
)
def m_log_loss(spark, sf_dir):
    rows = guesses(spark, sf_dir).withColumn("q", 1 / (1 + F.exp(-F.col("s"))))
    return rounded(metrics.rowwise(rows, ["log_loss"], "c", "q"), "log_loss")


@query(
    GUESSES + """ SELECT l_returnflag, round(round_even(avg(abs(p - y)), 4), 3) AS abs_error, round_even(avg(abs(p - y) / (abs(y) + 1e-8)), 4) AS rel_error,
    round_even(avg(200 * abs(p - y) / (abs(y) + abs(p) + 1e-8)), 4) AS smape_error, round_even(avg(p / (y + 1e-8)), 4) AS pred_ratio FROM g GROUP BY l_returnflag"""
)
def m_error_analysis(spark, sf_dir):
    return rounded(metrics.error_analysis(guesses(spark, sf_dir), "y", "p", "l_returnflag"), "abs_error", digits=3)


# ---- features and encoders -------------------------------------------------------------------


def _flag(pattern: str) -> str:
    # RE2 knows word boundaries in ASCII only: outer ones become classes.
    if pattern.startswith(r"\b") and pattern.endswith(r"\b"):
        pattern = rf"(^|[^\p{{L}}\p{{N}}_]){pattern[2:-2]}([^\p{{L}}\p{{N}}_]|$)"
    return f"regexp_matches(s, {O.text(pattern)})::INT"


def _count(pattern: str) -> str:
    return f"len(regexp_extract_all(s, {O.text(pattern)}))::INT"


# Units are whole words here, for the same reason.
UNIT_WORDS = ", ".join(O.text(u) for u in tabular.UNITS[tabular.UNITS.index(":") + 1 : tabular.UNITS.rindex(")")].split("|"))
TEXT_SQL = f"""WITH x AS (
  SELECT doc_id, coalesce(text, '') AS s, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda w: w <> '') AS w,
    len(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}_]+'), lambda u: u IN ({UNIT_WORDS})))::INT AS units FROM documents
) SELECT doc_id, length(s)::INT AS txt_text__char_count, len(w)::INT AS txt_text__word_count,
  len(list_distinct(list_transform(w, lambda v: lower(v))))::INT AS txt_text__unique_word_count,
  round(coalesce(length(array_to_string(w, '')) / nullif(len(w), 0)::DOUBLE, 0), 6) AS txt_text__avg_word_len,
  {_count(r'\d')} AS txt_text__digit_count, {_count(tabular.NUMBERS)} AS txt_text__number_count,
  round({_count(r'\p{Lu}')} / greatest(length(s), 1)::DOUBLE, 6) AS txt_text__uppercase_ratio, {_count(tabular.SPECIAL)} AS txt_text__special_char_count,
  (units > 0)::INT AS txt_text__has_unit, units AS txt_text__unit_count,
  {_flag(tabular.DIMENSIONS)} AS txt_text__has_dimension, {_flag('(?i)' + tabular.PACK)} AS txt_text__has_pack_size, {_flag(tabular.SKU)} AS txt_text__has_sku_pattern,
  {_flag(tabular.MODEL)} AS txt_text__has_model_number, {_flag(tabular.CAPS)} AS txt_text__has_brand_caps, {_flag(tabular.URL)} AS txt_text__has_url FROM x"""


@query(TEXT_SQL)
def text_structured(spark, sf_dir):
    made = tabular.text_features(data.table(spark, sf_dir, "documents"), ["text"], ["doc_id"])
    return rounded(made, "txt_text__avg_word_len", "txt_text__uppercase_ratio")


@query(
    """SELECT l_orderkey, l_linenumber, round(ln(1 + greatest(l_extendedprice, 0)), 6) AS num_log1p_l_extendedprice,
    round(l_extendedprice / (l_quantity + 1e-8), 4) AS num_ratio_l_extendedprice_l_quantity, round(l_extendedprice * l_discount, 6) AS num_prod_l_extendedprice_l_discount FROM lineitem"""
)
def numeric_features(spark, sf_dir):
    lines = data.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount")
    made = tabular.numeric_features(lines, ["l_extendedprice"], [("l_extendedprice", "l_quantity")], [("l_extendedprice", "l_discount")])
    made = made.drop("l_extendedprice", "l_quantity", "l_discount")
    made = rounded(made, "num_prod_l_extendedprice_l_discount")
    return rounded(rounded(made, "num_log1p_l_extendedprice"), "num_ratio_l_extendedprice_l_quantity", digits=4)


# Train and test parts of the orders, for everything that is fitted on one and applied to the other.
TRAIN = "(SELECT * FROM orders WHERE o_orderkey % 5 <> 0)"


def train_part(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("o_orderkey") % 5 != 0)


@query(
    f"""WITH c AS (SELECT o_orderpriority AS k, count(*) AS n FROM {TRAIN} GROUP BY 1), t AS (SELECT sum(n)::DOUBLE AS total FROM c)
    SELECT o_orderkey, o_orderpriority, round(coalesce(n / total, 0), 6) AS cat_o_orderpriority_freq, coalesce(n, 0) AS cat_o_orderpriority_count
    FROM t, orders LEFT JOIN c ON k = o_orderpriority"""
)
def freq_count_encode(spark, sf_dir):
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return rounded(tabular.category_features(orders, ["o_orderpriority"], train_part(orders)), "cat_o_orderpriority_freq")


@query(
    f"""WITH g AS (SELECT avg(o_totalprice) AS g FROM {TRAIN}), c AS (SELECT o_custkey AS k, count(*) AS n, avg(o_totalprice) AS m FROM {TRAIN} GROUP BY 1)
    SELECT o_orderkey, round(coalesce(m / (1 + exp(-(n - 1) / 1.0)) + g * (1 - 1 / (1 + exp(-(n - 1) / 1.0))), g), 4) AS o_custkey_te FROM g, orders LEFT JOIN c ON k = o_custkey"""
)
def target_encode(spark, sf_dir):
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    made = tabular.target_encode(orders, train_part(orders), "o_custkey", "o_totalprice")
    return rounded(made.select("o_orderkey", "o_custkey_te"), "o_custkey_te", digits=4)


@query(
    """WITH g AS (SELECT avg(o_totalprice) AS g FROM orders), w AS (SELECT *, count(*) OVER c AS n, sum(o_totalprice) OVER c AS s FROM orders WINDOW c AS (PARTITION BY o_custkey))
    SELECT o_orderkey, round(CASE WHEN n > 1 THEN (s - o_totalprice) / (n - 1) ELSE g END / (1 + exp(-(n - 1) / 1.0)) + g * (1 - 1 / (1 + exp(-(n - 1) / 1.0))), 4) AS o_custkey_te FROM w, g"""
)
def target_encode_loo(spark, sf_dir):
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    made = tabular.target_encode_leave_one_out(orders, "o_custkey", "o_totalprice")
    return rounded(made.select("o_orderkey", "o_custkey_te"), "o_custkey_te", digits=4)


# A table with gaps: prices of every seventh order and statuses of every eleventh are unknown.
GAPS = "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS status FROM orders"


def gaps(spark, sf_dir) -> DataFrame:
    return data.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus")).alias("status"),
    )


@query(
    f"""WITH x AS ({GAPS}), tr AS (SELECT * FROM x WHERE o_orderkey % 5 <> 0),
    s AS (SELECT median(price) AS med FROM tr), md AS (SELECT status AS top FROM tr WHERE status IS NOT NULL GROUP BY status ORDER BY count(*) DESC, status LIMIT 1),
    i AS (SELECT o_orderkey, coalesce(price, med) AS price, coalesce(status, top) AS status FROM x, s, md),
    z AS (SELECT avg(price) AS m, stddev_pop(price) AS d FROM i WHERE o_orderkey % 5 <> 0)
    SELECT o_orderkey, round(price, 4) AS price, status, round((price - m) / d, 6) AS price_scaled FROM i, z"""
)
def impute_scale(spark, sf_dir):
    rows = gaps(spark, sf_dir)
    filled = tabular.impute(rows, train_part(rows), {"price": "median", "status": "most_frequent"})
    made = tabular.standard_scale(filled, train_part(filled), ["price"])
    return rounded(rounded(made, "price", digits=4), "price_scaled")


@query(
    f"""WITH x AS ({GAPS}), c AS (SELECT status AS k, row_number() OVER (ORDER BY status) - 1 AS o FROM (SELECT DISTINCT status FROM x WHERE o_orderkey % 5 <> 0 AND status IS NOT NULL))
    SELECT o_orderkey, coalesce(o, -1)::INT AS status_ord FROM x LEFT JOIN c ON status = k"""
)
def ordinal_encode(spark, sf_dir):
    rows = gaps(spark, sf_dir)
    return tabular.ordinal_encode(rows, train_part(rows), "status").select("o_orderkey", "status_ord")


@query(
    """SELECT l_orderkey, l_linenumber, (l_returnflag = 'A')::INT AS flag_a, (l_returnflag = 'N')::INT AS flag_n, (l_returnflag = 'R')::INT AS flag_r FROM lineitem"""
)
def onehot(spark, sf_dir):
    rows = data.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    made = tabular.one_hot(rows, rows, "l_returnflag")
    return made.select("l_orderkey", "l_linenumber", *[F.col(f"`l_returnflag={v}`").alias(f"flag_{v.lower()}") for v in "ANR"])


@query(
    f"""WITH q AS (SELECT quantile_cont(o_totalprice, 0.001) AS lo, quantile_cont(o_totalprice, 0.999) AS hi FROM {TRAIN})
    SELECT o_orderkey, round(least(greatest(o_totalprice, lo), hi), 4) AS o_totalprice_clipped FROM orders, q"""
)
def quantile_clip(spark, sf_dir):
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    made = tabular.quantile_clip(orders, train_part(orders), ["o_totalprice"]).drop("o_totalprice")
    return rounded(made, "o_totalprice_clipped", digits=4)


P_TOKENS = "regexp_extract_all(lower(p_name), '\\w\\w+')"


@query(
    f"""WITH x AS (SELECT p_partkey, unnest({P_TOKENS} || list_transform(range(1, greatest(len({P_TOKENS}), 1)), lambda i: {P_TOKENS}[i] || ' ' || {P_TOKENS}[i + 1])) AS term FROM part),
    t AS (SELECT p_partkey, term, count(*) AS tf FROM x GROUP BY ALL), d AS (SELECT term, ln((1 + (SELECT count(*) FROM part)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM t GROUP BY term),
    w AS (SELECT p_partkey, term, (1 + ln(tf)) * idf AS w FROM t JOIN d USING (term))
    SELECT p_partkey, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY p_partkey)), 6) AS weight FROM w"""
)
def tfidf_features(spark, sf_dir):
    parts = data.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return rounded(tfidf(parts, "p_partkey", word_grams(F.col("p_name"), 1, 2)), "weight")


@query(
    """SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'l_extendedprice']) AS feature,
    round(unnest([corr(l_quantity, l_extendedprice), corr(l_discount, l_extendedprice), corr(l_tax, l_extendedprice), corr(l_extendedprice, l_extendedprice)]), 6) AS correlation,
    unnest([false, false, false, true]) AS is_target, false AS suspicious_name,
    unnest([abs(corr(l_quantity, l_extendedprice)) > 0.98, abs(corr(l_discount, l_extendedprice)) > 0.98, abs(corr(l_tax, l_extendedprice)) > 0.98, true]) AS high_correlation FROM lineitem"""
)
def leakage_check(spark, sf_dir):
    names = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    return rounded(tabular.leakage_report(data.table(spark, sf_dir, "lineitem"), names, "l_extendedprice"), "correlation")


# ---- audits ----------------------------------------------------------------------------------


def _profile_sql(table: str, columns: list[str]) -> str:
    """Doubles as text differ between engines, so only the counts that do not need their text."""
    parts = [
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing,
        round_even(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2)::DOUBLE AS missing_pct, count(DISTINCT {c}) AS n_unique,
        round_even(count(DISTINCT {c}) / count(*)::DOUBLE, 4) AS unique_ratio,
        (SELECT max(n) FROM (SELECT count(*) AS n FROM {table} GROUP BY {c})) / count(*)::DOUBLE > 0.995 AS near_constant, false AS leak_name FROM {table}"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


@query(_profile_sql("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]))
def column_profile(spark, sf_dir):
    return audit.column_profile(data.table(spark, sf_dir, "orders"))


@query(
    """SELECT unnest(['page_id', 'url', 'html']) AS column_name, unnest(['numeric', 'url', 'text']) AS kind UNION ALL
    SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']), unnest(['numeric', 'numeric', 'categorical', 'numeric', 'datetime', 'categorical'])"""
)
def type_inference(spark, sf_dir):
    found = audit.infer_types(data.table(spark, sf_dir, "pages")) | audit.infer_types(data.table(spark, sf_dir, "orders"))
    return spark.createDataFrame(list(found.items()), "column_name string, kind string")


@query(
    """SELECT (SELECT count(*) FROM events) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS duplicate_rows,
    (SELECT count(*) - count(DISTINCT user_id) FROM events) AS duplicate_ids"""
)
def duplicate_rows(spark, sf_dir):
    return audit.duplicates(data.table(spark, sf_dir, "events").select("user_id", "event_type"), "user_id")


@query(
    """WITH tr AS (SELECT * FROM customer WHERE c_custkey % 10 = 0 AND c_nationkey < 20), te AS (SELECT * FROM customer WHERE c_custkey % 10 <> 0),
    n AS (SELECT DISTINCT 'c_nationkey' AS column_name, c_nationkey::VARCHAR AS value FROM te WHERE c_nationkey NOT IN (SELECT c_nationkey FROM tr)
          UNION ALL SELECT DISTINCT 'c_mktsegment', c_mktsegment FROM te WHERE c_mktsegment NOT IN (SELECT c_mktsegment FROM tr))
    SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY value) <= 20"""
)
def train_test_compare(spark, sf_dir):
    rows = data.table(spark, sf_dir, "customer")
    train = rows.filter("c_custkey % 10 = 0 AND c_nationkey < 20")
    return audit.unseen_categories(train, rows.filter("c_custkey % 10 <> 0"), ["c_nationkey", "c_mktsegment"])


@query(
    f"""WITH {O.RAW} SELECT count(*) AS rows, count(*) FILTER (WHERE entity_id NOT LIKE 'S1%') AS wrong_prefix, count(*) FILTER (WHERE trim(entity_id) = '') AS blank_entity_id,
    count(*) FILTER (WHERE trim(business_name) = '') AS blank_business_name, count(*) FILTER (WHERE trim(business_address) = '') AS blank_business_address,
    count(*) FILTER (WHERE trim(country) = '') AS blank_country, count(entity_id) - count(DISTINCT entity_id) AS duplicate_ids FROM raw"""
)
def source_audit(spark, sf_dir):
    return audit.audit_source(data.raw_records(spark, sf_dir), 1)[0]


# ---- splits and ensembles --------------------------------------------------------------------


@query(
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS place, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, (CASE WHEN place < n - (n // 6) * 5 THEN 0 ELSE 1 + (place - (n - (n // 6) * 5)) // (n // 6) END)::INT AS fold FROM r"""
)
def split_timeseries(spark, sf_dir):
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return splits.timeseries(orders, "o_orderdate", "o_orderkey").select("o_orderkey", "fold")


@query("SELECT o_orderkey, ((row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey) - 1) % 5)::INT AS fold FROM orders")
def split_hash_kfold(spark, sf_dir):
    return splits.kfold(data.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", "fold")


@query(
    """WITH g AS (SELECT o_custkey, (row_number() OVER (ORDER BY count(*) DESC, md5('42|' || o_custkey), o_custkey) - 1) % 10 AS turn FROM orders GROUP BY o_custkey)
    SELECT o_orderkey, o_custkey, least(turn, 9 - turn)::INT AS fold FROM orders JOIN g USING (o_custkey)"""
)
def split_group(spark, sf_dir):
    return splits.group(data.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey")


@query(
    """WITH r AS (SELECT o_orderkey, o_orderstatus, (row_number() OVER (ORDER BY o_orderstatus, md5('42|' || o_orderkey), o_orderkey) - 1) % 5 AS fold FROM orders)
    SELECT o_orderkey, fold::INT AS fold FROM r"""
)
def split_stratified(spark, sf_dir):
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return splits.stratified(orders, "o_orderkey", "o_orderstatus").select("o_orderkey", "fold")


@query(
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey) AS place, floor(count(*) OVER () * 0.2) AS k FROM orders)
    SELECT o_orderkey, (place <= greatest(k, 1))::INT AS fold FROM r"""
)
def split_holdout(spark, sf_dir):
    return splits.holdout(data.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", "fold")


@query("SELECT p_partkey, p_name FROM part ORDER BY md5('42|' || p_partkey), p_partkey LIMIT 100")
def debug_sample(spark, sf_dir):
    from larkspur.sources.loaders import sample_rows

    return sample_rows(data.table(spark, sf_dir, "part").select("p_partkey", "p_name"), 100, "p_partkey")


@query(
    """WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
    SELECT o_orderkey, least(greatest(ceil((o_totalprice - lo) / ((hi - lo) / 10)) - 1, 0), 9)::INT::VARCHAR AS stratum FROM orders, e"""
)
def split_stratify_bins(spark, sf_dir):
    return splits.stratum(data.table(spark, sf_dir, "orders"), "o_totalprice").select("o_orderkey", "stratum")


# Three models' predictions of a line's price.
BLEND = """WITH b AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS y, 1400 * l_quantity AS m1, 1300 * l_quantity + 1000 * l_linenumber AS m2,
  30000 + 900 * l_quantity * (1 + l_discount) AS m3 FROM lineitem)"""


def blend(spark, sf_dir) -> DataFrame:
    q, n, d = F.col("l_quantity"), F.col("l_linenumber"), F.col("l_discount")
    return data.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("y"), (1400 * q).alias("m1"), (1300 * q + 1000 * n).alias("m2"),
        (30000 + 900 * q * (1 + d)).alias("m3"),
    )


MODELS = ["m1", "m2", "m3"]


@query(
    BLEND + """ SELECT 'm1' AS a, 'm2' AS b, round(corr(m1, m2), 6) AS correlation FROM b UNION ALL SELECT 'm1', 'm3', round(corr(m1, m3), 6) FROM b
    UNION ALL SELECT 'm2', 'm3', round(corr(m2, m3), 6) FROM b"""
)
def oof_corr(spark, sf_dir):
    return rounded(ensemble.oof_correlation(blend(spark, sf_dir), MODELS), "correlation")


@query(
    BLEND + f""", r AS (SELECT l_orderkey * 100 + l_linenumber AS id, {', '.join(f"(rank() OVER (ORDER BY {m}) + (count(*) OVER (PARTITION BY {m}) - 1) / 2.0) / count(*) OVER () AS r{k}" for k, m in enumerate(MODELS))} FROM b)
    SELECT id, round((r0 + r1 + r2) / 3, 6) AS rank_avg FROM r"""
)
def rank_avg(spark, sf_dir):
    rows = blend(spark, sf_dir).withColumn("id", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    return rounded(ensemble.rank_average(rows, MODELS, "id"), "rank_avg")


@query(BLEND + " SELECT l_orderkey, l_linenumber, round((5 * m1 + 3 * m2 + 2 * m3) / 10, 4) AS weighted, round((m1 + m2 + m3) / 3, 4) AS simple FROM b")
def weighted_avg(spark, sf_dir):
    rows = blend(spark, sf_dir)
    return rows.select(
        "l_orderkey", "l_linenumber", F.round(ensemble.weighted_average(MODELS, [5, 3, 2]), 4).alias("weighted"),
        F.round(ensemble.simple_average(MODELS), 4).alias("simple"),
    )


@query(BLEND + " SELECT l_orderkey, l_linenumber, round(list_median([m1, m2, m3]), 4) AS fold_median FROM b")
def fold_median(spark, sf_dir):
    return blend(spark, sf_dir).select("l_orderkey", "l_linenumber", F.round(ensemble.median_of(MODELS), 4).alias("fold_median"))


@query()
def model_selection(spark, sf_dir):
    chosen = ensemble.select_models(blend(spark, sf_dir), "y", MODELS, "rmse", 0.999)
    return spark.createDataFrame([(k, m) for k, m in enumerate(chosen)], "place int, model string")


# ---- validation and models -------------------------------------------------------------------

SHEET = "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS value FROM orders WHERE o_orderkey % 50 <> 0 UNION ALL SELECT 1, 5.0"


@query(
    f"""WITH s AS ({SHEET}) SELECT count(*) FILTER (WHERE value IS NULL) AS nulls, 0::BIGINT AS nans, 0::BIGINT AS infinite, count(*) - count(DISTINCT id) AS duplicate_ids,
    count(*) FILTER (WHERE value < 1000 OR value > 400000) AS out_of_range, count(*) AS rows,
    (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT id FROM s)) AS missing_ids, (SELECT count(DISTINCT id) FROM s WHERE id NOT IN (SELECT o_orderkey FROM orders)) AS unknown_ids,
    (SELECT count(*) FROM orders) AS expected_rows FROM s"""
)
def validate_tabular(spark, sf_dir):
    orders = data.table(spark, sf_dir, "orders")
    sheet = orders.filter("o_orderkey % 50 <> 0").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 97 != 0, F.col("o_totalprice")).alias("value")
    )
    sheet = sheet.unionByName(spark.createDataFrame([(1, 5.0)], "id long, value double"))
    return submission.submission_checks(sheet, orders.select(F.col("o_orderkey").alias("id")), "id", "value", 1000, 400000)


@query("SELECT l_orderkey, l_linenumber, round_even(least(greatest(exp(l_discount * 20) - 1, 0.5), 4), 2) AS value FROM lineitem")
def postprocess(spark, sf_dir):
    value = submission.postprocess(F.col("l_discount") * 20, "expm1", 0.5, 4, 2)
    return data.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", value.alias("value"))


@query(
    "SELECT count(*) AS rows, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, min(o_totalprice) AS min, max(o_totalprice) AS max, round(median(o_totalprice), 4) AS median FROM orders"
)
def submission_statistics(spark, sf_dir):
    return rounded(submission.submission_statistics(data.table(spark, sf_dir, "orders"), "o_totalprice"), "mean", "std", "median", digits=4)


@query(
    """SELECT round(avg(p_retailprice), 4) AS mean, round(median(p_retailprice), 4) AS median,
    (SELECT p_size FROM part GROUP BY p_size ORDER BY count(*) DESC, p_size LIMIT 1)::DOUBLE AS mode FROM part"""
)
def dummy_model(spark, sf_dir):
    part = data.table(spark, sf_dir, "part")
    stat = {s: models.ConstantModel(s).statistic for s in ("mean", "median", "mode")}
    made = part.agg(stat["mean"]("p_retailprice").alias("mean"), stat["median"]("p_retailprice").alias("median"), stat["mode"]("p_size").cast("double").alias("mode"))
    return rounded(made, "mean", "median", digits=4)


@query()
def cross_validation(spark, sf_dir):
    """Out-of-fold predictions of a linear model with fold-safe frequency features."""
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    rows = splits.kfold(orders, "o_orderkey", 3)
    build = lambda part, train: tabular.category_features(part, ["o_orderpriority"], train)
    features = ["o_custkey", "cat_o_orderpriority_freq", "cat_o_orderpriority_count"]
    made = models.cross_validate(rows, "o_totalprice", features, lambda: models.build_model("linear"), "rmse", "o_orderkey", build)
    return made.oof.select("o_orderkey", "fold", F.round("oof", 2).alias("oof"))


@query()
def gbt_scorer(spark, sf_dir):
    """Match probabilities of candidate pairs by a boosted classifier trained on all of them, counted by cells of their features."""
    from larkspur.operators import blocking
    from larkspur.operators.products import CELL_BITS
    from larkspur.plans.er_queries import BLOCKERS

    similar = ["name_edit_sim", "name_jaro_winkler", "name_token_jaccard", "addr_edit_sim", "addr_token_jaccard", "country_norm_exact"]
    highest = dict.fromkeys(similar, 1.0) | {"block_count": float(len(BLOCKERS))}
    ref, tgt = data.sides(spark, sf_dir)
    counts = blocking.counted(ref, tgt, BLOCKERS, highest, data.truth(spark, sf_dir))
    scores = models.counted_scorer(counts, list(highest), CELL_BITS)
    return blocking.valued(ref, tgt, BLOCKERS, highest, *scores).withColumn("score", F.round("score", 4))

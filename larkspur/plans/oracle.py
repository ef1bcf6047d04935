"""Pieces of DuckDB SQL that the oracles share: the derived records and their normalised columns."""

from __future__ import annotations

from larkspur.functions import normalize as N

BLANK = r"[ \t\n\x0b\f\r]+"
# The accented letters of the test tables and their base letters.
ACCENTED, BASE = "ÄÇÈÉÊÍÑÓÖÜäçèéêíñóöü", "ACEEEINOOUaceeeinoou"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def mapped(token: str, terms: dict[str, str]) -> str:
    entries = ", ".join(f"{text(k)}: {text(v)}" for k, v in terms.items())
    return f"coalesce(MAP {{{entries}}}[{token}], {token})"


def strip_accents(x: str) -> str:
    return f"translate({x}, '{ACCENTED}', '{BASE}')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def expand(x: str, terms: dict[str, str]) -> str:
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda t: {mapped('t', terms)}), ' ')"


def norm_name(x: str) -> str:
    low = f"replace(lower({strip_accents(x)}), '&', ' and ')"
    kept = f"regexp_replace({low}, '[^\\p{{L}}\\p{{N}}_\\s\\-'']', ' ', 'g')"
    return expand(squeeze(kept), N.NAME_TERMS)


def norm_address(x: str) -> str:
    low = f"replace(lower({strip_accents(x)}), '&', ' and ')"
    kept = f"regexp_replace({low}, '[^\\p{{L}}\\p{{N}}_\\s\\-/#]', ' ', 'g')"
    return expand(squeeze(kept), N.ADDRESS_TERMS)


def norm_country(x: str) -> str:
    kept = squeeze(f"regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')")
    return f"(SELECT {mapped('c', N.COUNTRY_TERMS)} FROM (SELECT {kept} AS c))"


def postal(x: str) -> str:
    five = f"regexp_extract({x}, '\\b(\\d{{5}})(-\\d{{4}})?\\b', 1)"
    return f"CASE WHEN {five} <> '' THEN {five} ELSE regexp_extract({x}, '\\b(\\d{{6}})\\b', 1) END"


def plain(x: str) -> str:
    return squeeze(f"regexp_replace({x}, '[^a-z0-9\\s]', ' ', 'g')")


def production_base(x: str) -> str:
    return squeeze(f"replace(replace(lower(replace({strip_accents(x)}, 'ß', 'ss')), '&', ' and '), '/', ' ')")


def production_name(x: str) -> str:
    forms = "|".join(N.LEGAL_FORMS)
    return f"trim(regexp_replace({plain(production_base(x))}, '((^| )({forms}))+$', ''))"


def production_address(x: str) -> str:
    out = production_base(x)
    for term in N.DOTTED_ADDRESS_TERMS:
        out = f"regexp_replace({out}, '\\b{term}\\.\\b', '{N.PRODUCTION_ADDRESS_TERMS[term]}', 'g')"
    parts = f"regexp_extract_all({out}, '[A-Za-z0-9_]+|[^A-Za-z0-9_]+')"
    return plain(f"array_to_string(list_transform({parts}, lambda t: {mapped('t', N.PRODUCTION_ADDRESS_TERMS)}), '')")


RAW = f"""
raw AS (
  SELECT 'S' || (1 + doc_id % 3) || '-' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS entity_id,
         CAST(1 + doc_id % 3 AS TINYINT) AS source, doc_id, text,
         array_to_string(list_slice(w, 1, 4), ' ') AS business_name,
         array_to_string(list_slice(w, 5, 12), ' ') AS business_address,
         lang AS country
  FROM (SELECT *, list_filter(regexp_split_to_array(text, '{BLANK}'), lambda t: t <> '') AS w FROM documents)
)"""

RECORDS = f"""{RAW}, rec0 AS MATERIALIZED (
  SELECT entity_id, source, business_name AS name_raw, {norm_name('business_name')} AS name_norm,
         business_address AS address_raw, {norm_address('business_address')} AS address_norm,
         {postal('lower(business_address)')} AS postal, country AS country_raw, {norm_country('country')} AS country_norm
  FROM raw
), rec AS MATERIALIZED (
  SELECT *, {words('name_norm')} AS name_tokens, regexp_replace(name_norm, '\\s+', '', 'g') AS name_compact,
         {words('address_norm')} AS address_tokens, regexp_extract_all(address_norm, '\\d+') AS numeric_tokens
  FROM rec0
), s1 AS (SELECT * FROM rec WHERE source = 1), tgt AS (SELECT * FROM rec WHERE source > 1),
truth AS MATERIALIZED (
  SELECT a.entity_id AS s1_id, b.entity_id AS candidate_id
  FROM raw a JOIN raw b ON a.text = b.text WHERE a.source = 1 AND b.source > 1
)"""

PRODUCTION = f"""{RAW}, prod0 AS MATERIALIZED (
  SELECT entity_id, source, {production_name('business_name')} AS name_norm, {production_address('business_address')} AS address_norm,
         lower(trim(country)) AS country_norm
  FROM raw
), prod AS MATERIALIZED (
  SELECT *, regexp_replace(name_norm, '[^a-z0-9]', '', 'g') AS name_compact,
         regexp_replace(address_norm, '[^a-z0-9]', '', 'g') AS address_compact,
         coalesce(list_last(list_filter(regexp_extract_all(address_norm, '\\d+'), lambda d: len(d) BETWEEN 4 AND 6)), '') AS postal
  FROM prod0
), q AS (SELECT * FROM prod WHERE source = 1), t AS (SELECT * FROM prod WHERE source > 1),
truth AS MATERIALIZED (
  SELECT a.entity_id AS s1_id, b.entity_id AS target_id
  FROM raw a JOIN raw b ON a.text = b.text WHERE a.source = 1 AND b.source > 1
)"""


def with_records(sql: str) -> str:
    return f"WITH {RECORDS}, {sql}" if not sql.lstrip().upper().startswith("SELECT") else f"WITH {RECORDS} {sql}"


def with_production(sql: str) -> str:
    return f"WITH {PRODUCTION}, {sql}" if not sql.lstrip().upper().startswith("SELECT") else f"WITH {PRODUCTION} {sql}"


def edit_similarity(a: str, b: str) -> str:
    """ASCII only: DuckDB counts bytes."""
    return f"CASE WHEN greatest(length({a}), length({b})) = 0 THEN 1.0 ELSE 1 - levenshtein({a}, {b}) / greatest(length({a}), length({b}))::DOUBLE END"


def jaccard(a: str, b: str) -> str:
    return guarded(a, b, f"len(list_distinct(list_intersect({a}, {b}))) / len(list_distinct({a} || {b}))::DOUBLE")


def guarded(a: str, b: str, value: str) -> str:
    return f"CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0 WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE {value} END"


def overlap(a: str, b: str) -> str:
    common = f"len(list_distinct(list_intersect({a}, {b})))"
    return guarded(a, b, f"{common} / least(len(list_distinct({a})), len(list_distinct({b})))::DOUBLE")


def dice(a: str, b: str) -> str:
    common = f"len(list_distinct(list_intersect({a}, {b})))"
    return guarded(a, b, f"2 * {common} / (len(list_distinct({a})) + len(list_distinct({b})))::DOUBLE")


def containment(a: str, b: str) -> str:
    held = f"len(list_filter({a}, lambda zz: list_contains({b}, zz)))"
    return f"CASE WHEN len({a}) = 0 THEN CASE WHEN len({b}) = 0 THEN 1.0 ELSE 0.0 END ELSE {held} / len({a})::DOUBLE END"


def grams(x: str, n: int) -> str:
    return f"list_transform(range(1, greatest(length({x}) - {n - 2}, 1)), lambda i: substr({x}, i, {n}))"


def char_similarity(a: str, b: str, n: int) -> str:
    inner = jaccard(grams(a, n), grams(b, n))
    return f"CASE WHEN {a} = '' AND {b} = '' THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE {inner} END"


def length_ratio(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} = '' AND {b} = '' THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 "
        f"ELSE least(length({a}), length({b})) / greatest(length({a}), length({b}))::DOUBLE END"
    )

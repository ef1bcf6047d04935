from __future__ import annotations

import difflib
import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspur.functions import normalize as N
from larkspur.functions import similarity as S
from larkspur.functions.vectors import char_wb_grams, word_grams

TEXT = st.text(alphabet="abcd éß", max_size=12)


def one(spark, column, **values):
    rows = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return rows.select(column).first()[0]


@pytest.mark.parametrize(
    "raw,want",
    [
        ("Apollo Pharmacy Pvt. Ltd.", "apollo pharmacy private limited"),
        ("Tata & Sons  Co", "tata and sons company"),
        ("Société Générale", "societe generale"),
        ("O'Neil-Smith Inc", "o'neil-smith incorporated"),
        ("", ""),
        (None, ""),
    ],
)
def test_name(spark, raw, want):
    assert one(spark, N.normalize_name(F.col("x")), x=raw) == want


@pytest.mark.parametrize(
    "raw,want",
    [("New York, NY 10001", "10001"), ("Chennai 600001", "600001"), ("no code", ""), ("10001-1234 and 600001", "10001"), (None, "")],
)
def test_postal(spark, raw, want):
    assert one(spark, N.extract_postal(F.col("x")), x=raw) == want


@pytest.mark.parametrize("raw,want", [("United States", "us"), ("USA", "us"), ("U.S.", "us"), ("India", "in"), ("FR", "fr"), ("Atlantis", "atlantis"), (None, "")])
def test_country(spark, raw, want):
    assert one(spark, N.normalize_country(F.col("x")), x=raw) == want


def test_address(spark):
    assert one(spark, N.normalize_address(F.col("x")), x="12/A, MG Rd #4") == "12/a mahatma gandhi road #4"


@pytest.mark.parametrize("raw,want", [("Acme Corp. Ltd", "acme"), ("Inc", ""), ("Ltd Acme", "ltd acme"), ("Straße & Co", "strasse and")])
def test_production_name(spark, raw, want):
    assert one(spark, N.production_name(F.col("x")), x=raw) == want


@pytest.mark.parametrize("raw,want", [("12 Main St.", "12 main street"), ("rd.x", "roadx"), ("5 Rue bat B", "5 rue batiment b")])
def test_production_address(spark, raw, want):
    assert one(spark, N.production_address(F.col("x")), x=raw) == want


def test_production_postal(spark):
    assert one(spark, N.production_postal(F.col("x")), x="1234 main 1234567 75001 paris") == "75001"
    assert one(spark, N.production_postal(F.col("x")), x="main") == ""


def test_accents_agree_with_the_exact_form(spark):
    text = "".join(chr(c) for c in range(0x20, 0x250))
    single = "".join(c for c in text if len(unicodedata.normalize("NFKD", c).strip()) and len("".join(d for d in unicodedata.normalize("NFKD", c) if unicodedata.category(d) != "Mn")) == 1)
    rows = spark.createDataFrame([(single,)], "x string")
    fast, exact = rows.select(N.normalize_unicode(F.col("x")), N.normalize_unicode_exact("x")).first()
    assert fast == exact


def test_golden_similarities(spark):
    def sim(column, a, b):
        return one(spark, column, a=a, b=b)

    a, b = F.col("a"), F.col("b")
    assert sim(S.length_ratio(a, b), "abc", "abcdef") == 0.5
    assert sim(S.char_ngram_similarity(a, b, 3), "apollo", "xyz") == 0.0
    assert sim(S.char_ngram_similarity(a, b, 3), "ab", "cd") == 1.0
    assert sim(S.edit_similarity(a, b), "", "") == 1.0
    assert sim(S.token_overlap(F.split(a, " "), F.split(b, " ")), "a b", "a b c") == 1.0
    assert sim(S.edit_similarity(a, b), "apollo pharmacy", "apollo pharmacy private limited") == pytest.approx(0.4839, abs=1e-4)
    assert sim(S.jaro_winkler_similarity(a, b), "tata motors limited", "tata motors") == pytest.approx(0.9158, abs=1e-4)
    assert sim(S.production_char_jaccard(a, b, 3), "ab", "ab") == 0.0


def test_jaro_variants():
    assert S.jaro("deadbddbc", "cadeabedc") == pytest.approx(0.7222, abs=1e-4)
    assert S.jaro("deadbddbc", "cadeabedc", floor=False) == pytest.approx(0.6944, abs=1e-4)
    assert S.jaro_winkler("abcd", "abxy") == pytest.approx(0.6667, abs=1e-4)
    assert S.jaro_winkler("abcd", "abxy", boost=-1.0) == pytest.approx(0.7333, abs=1e-4)


@given(TEXT, TEXT)
def test_kernels_hold_bounds_and_symmetry(a, b):
    for kernel in (S.jaro, S.jaro_winkler, S.indel_ratio, S.token_sort_ratio, S.token_set_ratio, S.partial_ratio, S.weighted_ratio):
        assert 0 <= kernel(a, b) <= 1 + 1e-12
    assert S.indel_ratio(a, b) == S.indel_ratio(b, a)
    assert S.indel_ratio(a, a) == 1
    plain = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            plain[i + 1][j + 1] = plain[i][j] + 1 if a[i] == b[j] else max(plain[i][j + 1], plain[i + 1][j])
    assert S.lcs_length(a, b) == plain[-1][-1]


@given(st.text(alphabet="abc", min_size=1, max_size=7), st.text(alphabet="abc", min_size=1, max_size=7))
def test_partial_ratio_is_the_best_window(a, b):
    short, long = sorted((a, b), key=len)

    def best(s, t):
        return max(S.indel_ratio(s, t[max(0, k) : k + len(s)]) for k in range(1 - len(s), len(t)) if t[max(0, k) : k + len(s)])

    want = best(short, long) if len(a) != len(b) else max(best(a, b), best(b, a))
    assert S.partial_ratio(a, b) == pytest.approx(want)


def test_sequence_ratio():
    assert S.sequence_ratio("abcd", "bcde") == difflib.SequenceMatcher(None, "abcd", "bcde").ratio()


def test_grams(spark):
    assert one(spark, word_grams(F.col("x"), 1, 2), x="The big a red Fox") == ["the", "big", "red", "fox", "the big", "big red", "red fox"]
    assert one(spark, word_grams(F.col("x"), 1, 2), x="") == []
    assert one(spark, char_wb_grams(F.col("x"), 3, 4), x="ab c") == [" ab", "ab ", " c ", " ab "]

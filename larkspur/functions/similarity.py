"""String and token similarity.

What Catalyst can say is a Column expression; only edit kernels that it lacks (Jaro, Jaro-Winkler
and the insertion/deletion family) are pandas functions over Arrow batches, each distinct pair of a
batch computed once.  Library convention: two empty sides are alike (1.0).  The ``production_``
functions follow the other one: any empty side gives 0.0.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.normalize import grams


def _double(flag: Column) -> Column:
    return flag.cast("double")


def _guarded(a_empty: Column, b_empty: Column, value: Column) -> Column:
    """1 if both are empty, 0 if one is, else value."""
    return F.when(a_empty & b_empty, 1.0).when(a_empty | b_empty, 0.0).otherwise(value)


def edit_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)


def exact_match(a: Column, b: Column) -> Column:
    return _double(a == b)


def prefix_match(a: Column, b: Column, min_len: int = 3) -> Column:
    short = F.least(F.length(a), F.length(b))
    return _double((short >= min_len) & (a.startswith(b) | b.startswith(a)))


def containment_match(a: Column, b: Column) -> Column:
    return _double((a != "") & (b != "") & (a.contains(b) | b.contains(a)))


def length_ratio(a: Column, b: Column) -> Column:
    la, lb = F.length(a), F.length(b)
    return _guarded(la == 0, lb == 0, F.least(la, lb) / F.greatest(la, lb))


def length_diff(a: Column, b: Column) -> Column:
    return F.abs(F.length(a) - F.length(b)).cast("double")


def token_count_diff(a: Column, b: Column) -> Column:
    return F.abs(F.size(a) - F.size(b)).cast("double")


def _common(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def token_jaccard(a: Column, b: Column) -> Column:
    return _guarded(F.size(a) == 0, F.size(b) == 0, _common(a, b) / F.size(F.array_union(a, b)))


def token_overlap(a: Column, b: Column) -> Column:
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return _guarded(F.size(a) == 0, F.size(b) == 0, _common(a, b) / least)


def token_dice(a: Column, b: Column) -> Column:
    both = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return _guarded(F.size(a) == 0, F.size(b) == 0, 2 * _common(a, b) / both)


def token_containment(a: Column, b: Column) -> Column:
    """Share of a's tokens, repeats counted, that b has."""
    held = F.size(F.filter(a, lambda t: F.array_contains(b, t)))
    return F.when(F.size(a) == 0, _double(F.size(b) == 0)).otherwise(held / F.size(a))


def weighted_token_jaccard(a: Column, b: Column, weights: Column | None = None) -> Column:
    """Jaccard over summed weights (a map column; 1 for unknown tokens); plain without weights."""
    if weights is None:
        return token_jaccard(a, b)

    def total(tokens: Column) -> Column:
        return F.aggregate(tokens, F.lit(0.0), lambda acc, t: acc + F.coalesce(F.element_at(weights, t), F.lit(1.0)))

    union = total(F.array_union(a, b))
    return _guarded(
        F.size(a) == 0, F.size(b) == 0, F.when(union > 0, total(F.array_intersect(a, b)) / union).otherwise(0.0)
    )


def gram_similarity(a: Column, b: Column, grams_a: Column, grams_b: Column) -> Column:
    """Jaccard of n-gram sets; two non-empty strings without any n-gram count as alike.

    The grams are arguments so that a plan can make them in a projection of their own, once.
    """
    inner = _guarded(F.size(grams_a) == 0, F.size(grams_b) == 0, _common(grams_a, grams_b) / F.size(F.array_union(grams_a, grams_b)))
    return _guarded(a == "", b == "", inner)


def char_ngram_similarity(a: Column, b: Column, n: int) -> Column:
    return gram_similarity(a, b, grams(a, n), grams(b, n))


numeric_token_overlap = token_jaccard
numeric_containment = token_containment


def production_jaccard(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(_common(a, b) / F.size(F.array_union(a, b)))


def production_overlap(a: Column, b: Column) -> Column:
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(least == 0, 0.0).otherwise(_common(a, b) / F.when(least > 0, least))


def production_length_ratio(a: Column, b: Column) -> Column:
    la, lb = F.length(a), F.length(b)
    return F.when((la == 0) | (lb == 0), 0.0).otherwise(F.least(la, lb) / F.greatest(la, lb))


def production_char_jaccard(a: Column, b: Column, n: int) -> Column:
    return production_jaccard(grams(a, n), grams(b, n))


# ---- kernels that Catalyst lacks ------------------------------------------------------------


def jaro(a: str, b: str, floor: bool = True) -> float:
    """Jaro similarity.  floor: odd transpositions are halved with rounding down."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    reach = max(reach, 0)
    used = [False] * len(b)
    mine = []
    for i, char in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == char:
                used[j] = True
                mine.append(char)
                break
    m = len(mine)
    if not m:
        return 0.0
    theirs = [b[j] for j in range(len(b)) if used[j]]
    moved = sum(x != y for x, y in zip(mine, theirs, strict=True))
    t = moved // 2 if floor else moved / 2
    return (m / len(a) + m / len(b) + (m - t) / m) / 3


def jaro_winkler(a: str, b: str, weight: float = 0.1, boost: float = 0.7, floor: bool = True) -> float:
    """Jaro plus a bonus for up to four equal first characters, if it is over boost."""
    score = jaro(a, b, floor)
    if score <= boost:
        return score
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return score + prefix * weight * (1 - score)


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, bit-parallel over the characters of a."""
    masks: dict[str, int] = {}
    for k, char in enumerate(a):
        masks[char] = masks.get(char, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for char in b:
        hit = row & masks.get(char, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 2 * lcs_length(a, b) / total if total else 1.0


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common, only_a, only_b = x & y, sorted(x - y), sorted(y - x)
    if common and (not only_a or not only_b):
        return 1.0
    left, right, shared = " ".join(only_a), " ".join(only_b), len(" ".join(common))
    gap = int(bool(shared))
    la, lb = shared + gap + len(left), shared + gap + len(right)
    apart = len(left) + len(right) - 2 * lcs_length(left, right)
    best = 1 - apart / (la + lb) if la + lb else 0.0
    if shared:
        best = max(best, 1 - (gap + len(left)) / (shared + la), 1 - (gap + len(right)) / (shared + lb))
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string and any window of the longer one, windows cut by its ends too."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    if a in b:
        return 1.0
    best = _best_window(a, b)
    return max(best, _best_window(b, a)) if len(a) == len(b) else best


def _best_window(short: str, long: str) -> float:
    m, n, letters, best = len(short), len(long), set(short), 0.0
    for start in range(1 - m, n):
        piece = long[max(0, start) : start + m]
        # an optimal window starts or ends on a character of the shorter string
        if piece and (piece[-1] in letters if start <= 0 else piece[0] in letters or piece[-1] in letters):
            best = max(best, indel_ratio(short, piece))
    return best


def partial_token_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if x & y:
        return 1.0
    by_order = partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    return max(by_order, partial_ratio(" ".join(sorted(x - y)), " ".join(sorted(y - x))))


def weighted_ratio(a: str, b: str) -> float:
    """The best of plain, token and partial ratios, each with its usual discount."""
    if not a or not b:
        return 0.0
    share = max(len(a), len(b)) / min(len(a), len(b))
    best = indel_ratio(a, b)
    if share < 1.5:
        return max(best, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if share < 8 else 0.6
    return max(best, scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def sequence_ratio(a: str, b: str) -> float:
    """The standard library's matching-blocks ratio."""
    return difflib.SequenceMatcher(None, a, b).ratio()


def _pairwise(kernel, empty_is_zero: bool = False):
    """A pandas function of two string columns that computes each distinct pair of a batch once."""

    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        seen: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(a.fillna(""), b.fillna(""), strict=True):
            if pair not in seen:
                seen[pair] = 0.0 if empty_is_zero and not (pair[0] and pair[1]) else kernel(*pair)
            out.append(seen[pair])
        return pd.Series(out, dtype="float64")

    return run


def _fallback_jaro(a: str, b: str) -> float:
    return jaro(a, b, floor=False)


def _fallback_jaro_winkler(a: str, b: str) -> float:
    return jaro_winkler(a, b, boost=-1.0, floor=False)


def jaro_similarity(a: Column, b: Column, variant: str = "installed") -> Column:
    return _pairwise(_fallback_jaro if variant == "fallback" else jaro)(a, b)


def jaro_winkler_similarity(a: Column, b: Column, variant: str = "installed") -> Column:
    return _pairwise(_fallback_jaro_winkler if variant == "fallback" else jaro_winkler)(a, b)


RATIOS = {
    "ratio": indel_ratio,
    "token_set_ratio": token_set_ratio,
    "token_sort_ratio": token_sort_ratio,
    "partial_ratio": partial_ratio,
    "weighted_ratio": weighted_ratio,
    "sequence_ratio": sequence_ratio,
}


def fuzzy_ratio(kind: str, a: Column, b: Column) -> Column:
    """One of RATIOS in 0..1; 0 if either side is empty."""
    return _pairwise(RATIOS[kind], empty_is_zero=True)(a, b)

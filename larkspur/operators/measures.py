"""The 58 pair features within a product: of places in two record tables, without a join for either side.

Each value is that of ``pairs.pair_features``: the same divisions in the same order, over counts that are made
reference by reference.  Strings and sets that are too long for their tables are compared one by one.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.operators.bounds import Records, _column, edits_of, equal, jaro_winklers, sketch

#: Distinct members of a set that are held side by side.
WIDE = 64
RAW = ("name_raw", "address_raw", "country_raw")
GRAMS = (("name", 3), ("name", 4), ("address", 3))
EXACT = {
    "name_exact": "name_raw", "name_norm_exact": "name", "name_compact_exact": "compact", "addr_exact": "address_raw",
    "addr_norm_exact": "address", "country_exact": "country_raw", "country_norm_exact": "country", "addr_postal_match": "postal",
}
MISSING = {"name_missing": "name", "addr_missing": "address", "country_missing": "country"}
#: Features of a field's two texts that may be asked for alone, and all those that are whole numbers.
TEXTS = {"name": ("name_edit_sim", "name_jaro_winkler", "name_token_jaccard"), "address": ("addr_edit_sim", "addr_token_jaccard")}
WHOLE = {
    *[f"{side}_{short}_token_count" for side in ("s1", "cand") for short in ("name", "addr")],
    *[f"{short}_{what}_diff" for short in ("name", "addr") for what in ("token_count", "length")], "name_prefix_match", "name_containment",
}


def columns() -> dict[str, Column]:
    """The columns of a record that all features are made from."""
    bags = {"name_bag": F.col("name_tokens"), "address_bag": F.col("address_tokens"), "number_bag": F.col("numeric_tokens")}
    return sketch() | {c: F.col(c) for c in RAW} | bags


def rounded(values: np.ndarray, digits: int) -> np.ndarray:
    """Half up by the shortest decimal form, as Spark's round does it."""
    scaled = values * 10.0**digits
    low = np.floor(scaled)
    out = np.floor(scaled + 0.5) / 10.0**digits
    for k in np.flatnonzero(np.abs(scaled - low - 0.5) < 1e-6):
        out[k] = float(Decimal(repr(float(values[k]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
    return out


class Bags:
    """The members of each row with their repeats; a reference's are coded by the targets' words."""

    def __init__(self, values: pa.Array, targets: Bags | None = None) -> None:
        self.total = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = values.flatten().dictionary_encode()
        width = max(1, len(coded.dictionary))
        rows = np.repeat(np.arange(len(values)), self.total)
        keys, self.times = np.unique(rows * width + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        rows, codes = keys // width, keys % width
        self.words = coded.dictionary if targets is None else targets.words
        if targets is not None:
            known = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.words), -1).to_numpy(zero_copy_only=False)
            codes = known[codes] if len(codes) else codes
        self.codes, self.size = codes, np.bincount(rows, minlength=len(values))
        self.starts = np.concatenate([[0], np.cumsum(self.size)])
        self.width = min(WIDE, int(self.size.max(initial=1)))
        if targets is None:
            self.held = np.full((len(values), self.width), len(self.words), dtype=np.int32)
            place = np.arange(len(rows)) - self.starts[rows]
            fits = place < self.width
            self.held[rows[fits], place[fits]] = codes[fits]

    def shared(self, rows: np.ndarray, other: Bags, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct members that pairs share, and how many of the first side's members those are, repeats counted."""
        marks = np.zeros(len(other.words) + 1, dtype=np.int32)
        common, held = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        for start, end in zip(starts, np.append(starts[1:], len(rows)), strict=True):
            mine = slice(self.starts[rows[start]], self.starts[rows[start] + 1])
            codes = self.codes[mine]
            known = codes >= 0
            if not known.any():
                continue
            marks[codes[known]] = self.times[mine][known]
            got = marks[other.held[at[start:end]]]
            common[start:end], held[start:end] = np.count_nonzero(got, axis=1), got.sum(axis=1)
            for k in np.flatnonzero(other.size[at[start:end]] > other.width):
                t = at[start + k]
                rest = marks[other.codes[other.starts[t] + other.width : other.starts[t + 1]]]
                common[start + k] += np.count_nonzero(rest)
                held[start + k] += rest.sum()
            marks[codes[known]] = 0
        return common, held


def _ratio(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _guarded(n: np.ndarray, m: np.ndarray, value: np.ndarray) -> np.ndarray:
    """1 if both are empty, 0 if one is, else value."""
    return np.where((n == 0) & (m == 0), 1.0, np.where((n == 0) | (m == 0), 0.0, value))


def _windows(texts: list[str], n: int) -> pa.Array:
    sizes = np.maximum(np.fromiter(map(len, texts), np.int64, len(texts)) - n + 1, 0)
    parts = [texts[k : k + 2_048] for k in range(0, len(texts), 2_048)]  # few of the windows are Python strings at once
    flat = pa.concat_arrays([pa.array([], pa.string()), *[pa.array([t[i : i + n] for t in part for i in range(len(t) - n + 1)], pa.string()) for part in parts]])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)


class Wide(Records):
    """``bounds.Records`` with what the other features need, made when it is asked for."""

    def __init__(self, table: pa.Table | pa.RecordBatch, targets: Wide | None = None) -> None:
        super().__init__(table, targets)
        self.table, self.targets = table, targets
        for f in RAW:
            if f in table.schema.names:
                values = _column(table, f)
                self.words[f] = targets.words[f] if targets else values.unique()
                self.codes[f] = pc.fill_null(pc.index_in(values, value_set=self.words[f]), -1).to_numpy(zero_copy_only=False)
        self.missing = {f: pc.equal(_column(table, f), "").to_numpy(zero_copy_only=False) for f in MISSING.values()}

    @cached_property
    def bags(self) -> dict[str, Bags]:
        return {f: Bags(_column(self.table, f"{f}_bag"), self.targets and self.targets.bags[f]) for f in ("name", "address", "number")}

    @cached_property
    def grams(self) -> dict[tuple[str, int], Bags]:
        return {(f, n): Bags(_windows(self.text[f].text, n), self.targets and self.targets.grams[f, n]) for f, n in GRAMS}


def measures(
    a: Wide, rows: np.ndarray, b: Wide, at: np.ndarray, blockers: dict[str, np.ndarray], provenance: dict[str, str], names: tuple[str, ...] | None, digits: int | None = None,
) -> dict[str, np.ndarray]:
    """The features by name, of pairs that come reference by reference; blockers: whether each of them found a pair.

    What two texts alone decide is made once for each distinct pair of them.
    """
    every, size = names is None, len(rows)
    near = (lambda x: x) if digits is None else (lambda x: rounded(x, digits))
    out = {n: equal(a, rows, b, at, f) * 1.0 for n, f in EXACT.items() if every or n in names}
    sims = {}
    for f, short in (("name", "name"), ("address", "addr")):
        asked = [n for n in TEXTS[f] if every or n in names]
        if not asked:
            continue
        r, c, back = a.once(rows, b, at, f)
        if f"{short}_edit_sim" in asked:
            edit = edits_of(a, r, b, c, f)
            out[f"{short}_edit_sim"], sims[f] = near(edit)[back], edit[back]
        if "name_jaro_winkler" in asked:
            out["name_jaro_winkler"] = near(jaro_winklers(a.text[f], r, b.text[f], c, equal(a, r, b, c, f)))[back]
        if every:
            out |= {n: (v if n in WHOLE else near(v))[back] for n, v in _texts(a, r, b, c, f, short).items()}
        elif f"{short}_token_jaccard" in asked:
            out[f"{short}_token_jaccard"] = near(_sets(a, r, b, c, f))[back]
    out["block_count"] = np.sum([x for x in blockers.values()], axis=0) * 1.0 if blockers else np.zeros(size)
    if not every:
        return {n: out[n] for n in names}

    for what, f in MISSING.items():
        out[f"s1_{what}"], out[f"cand_{what}"] = a.missing[f][rows] * 1.0, b.missing[f][at] * 1.0
    out["country_either_missing"] = np.maximum(out["s1_country_missing"], out["cand_country_missing"])
    for flag, blocker in provenance.items():
        out[flag] = blockers[blocker] * 1.0 if blocker in blockers else np.zeros(size)
    one, two = sims["name"], sims["address"]
    out["name_strong_addr_weak"] = ((one > 0.8) & (two < 0.3)) * 1.0
    out["name_weak_addr_strong"] = ((one < 0.5) & (two > 0.7)) * 1.0
    out["name_strong_addr_strong"] = ((one > 0.7) & (two > 0.5)) * 1.0
    out["name_addr_consistency"] = near((one + two) / 2)
    out["postal_name_agreement"] = ((out["addr_postal_match"] == 1) & (one > 0.5)) * 1.0
    # the greatest of rounded values is the rounded greatest one
    out["evidence_strength"] = np.max([out[n] for n in ("name_edit_sim", "addr_edit_sim", "name_token_jaccard", "addr_token_jaccard")], axis=0)
    return out


def _texts(a: Wide, rows: np.ndarray, b: Wide, at: np.ndarray, field: str, short: str) -> dict[str, np.ndarray]:
    """The other features of two texts."""
    out = {}
    for f, what in ((field, short), *([("number", "addr_numeric")] if field == "address" else [])):
        x, y = a.bags[f], b.bags[f]
        common, held = x.shared(rows, y, at)
        n, m, total = x.size[rows], y.size[at], x.total[rows]
        part = "_" if f == "number" else "_token_"
        out[f"{what}{part}{'overlap' if f == 'number' else 'jaccard'}"] = _guarded(n, m, _ratio(common, n + m - common))
        if f != "number":
            out[f"{what}_token_overlap"] = _guarded(n, m, _ratio(common, np.minimum(n, m)))
            out[f"{what}_token_count_diff"] = np.abs(total - y.total[at]) * 1.0
            out[f"s1_{what}_token_count"], out[f"cand_{what}_token_count"] = total * 1.0, y.total[at] * 1.0
        if f == "name":
            out["name_token_dice"] = _guarded(n, m, _ratio(2 * common, n + m))
        out[f"{what}{part}containment"] = np.where(total == 0, (y.total[at] == 0) * 1.0, _ratio(held, total))
    x, y = a.text[field], b.text[field]
    n, m = x.length[rows], y.length[at]
    for f, width in GRAMS:
        if f == field:
            mine, theirs = a.grams[f, width], b.grams[f, width]
            common, _ = mine.shared(rows, theirs, at)
            inner = _guarded(mine.size[rows], theirs.size[at], _ratio(common, mine.size[rows] + theirs.size[at] - common))
            out[f"{short}_char{width}_sim"] = _guarded(n, m, inner)
    least = np.minimum(n, m)
    out[f"{short}_length_ratio"] = _guarded(n, m, _ratio(least, np.maximum(n, m)))
    out[f"{short}_length_diff"] = np.abs(n - m) * 1.0
    if field == "name":
        out["name_prefix_match"], out["name_containment"] = np.zeros(len(rows)), np.zeros(len(rows))
        for k in np.flatnonzero((least > 0) & (x.common(rows, y, at) >= least)):
            p, q = x.text[rows[k]], y.text[at[k]]
            p, q = (p, q) if len(p) <= len(q) else (q, p)
            out["name_containment"][k] = p in q
            out["name_prefix_match"][k] = len(p) >= 3 and q.startswith(p)
    return out


def _sets(a: Wide, rows: np.ndarray, b: Wide, at: np.ndarray, field: str) -> np.ndarray:
    value = a.sets[field].jaccard(rows, b.sets[field], at)
    return _guarded(a.sets[field].size[rows], b.sets[field].size[at], value)



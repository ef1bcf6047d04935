"""Rule scores within a product: pairs that cannot reach a floor are dropped by bounds, the others are scored exactly.

A pair's bound is the rule's weighted sum with every part at its most: exact flags, token overlaps from
64-bit sets, edit similarities from common letters and then from edit distances, Jaro-Winkler from common
letters and the first four.  No bound is under its part, so that a pair which is dropped cannot reach the
floor.  Scores are the sums of ``pairs.rule_score`` in its order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.similarity import jaro_winkler

#: Characters that are held of a string; longer ones are bounded by their letters and compared one by one.
HELD, WORD = 128, 64
#: Pairs that are compared at once, so that their bit vectors stay in a core's cache.
LANES = 8_192
#: Code points with a place of their own in patterns; strings with others are compared one by one.
POINTS = 256
#: Distinct tokens that are held of a record.
TOKENS = 16
#: For sums of floats and scores that are rounded to six digits.
SLACK = 1e-5
LEVELS = {"name": 4, "address": 8}
FLAGS = {"compact": "name_compact_exact", "country": "country_norm_exact", "postal": "addr_postal_match"}


def sketch() -> dict[str, Column]:
    """The columns of a record that scores are made from."""
    return {
        "name": F.col("name_norm"), "address": F.col("address_norm"), "compact": F.col("name_compact"), "country": F.col("country_norm"),
        "postal": F.col("postal"), "name_tokens": F.array_distinct("name_tokens"), "address_tokens": F.array_distinct("address_tokens"),
    }


def _column(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    column = table[name]
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def distance(a: str, b: str) -> int:
    """Edit distance, bit-parallel over the characters of a."""
    if not a or not b:
        return len(a) + len(b)
    masks: dict[str, int] = {}
    for k, char in enumerate(a):
        masks[char] = masks.get(char, 0) | 1 << k
    full, top, score = (1 << len(a)) - 1, 1 << len(a) - 1, len(a)
    up, down = full, 0
    for char in b:
        eq = masks.get(char, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph, mh = down | ~(xh | up) & full, up & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = ph << 1 | 1, mh << 1
        up, down = (mh | ~(xv | ph)) & full, ph & xv & full
    return score


class Strings:
    """The first characters of a column, and unary sets of their counts."""

    def __init__(self, values: pa.Array, levels: int) -> None:
        self.text = values.to_pylist()
        # a zero character would end a text: it counts as another that has no place
        texts = np.array([v[:HELD].replace("\0", chr(POINTS)) for v in self.text], dtype=f"U{HELD}")
        self.points = np.ascontiguousarray(texts).view(np.uint32).reshape(len(texts), HELD) if len(texts) else np.zeros((0, HELD), np.uint32)
        self.length = np.fromiter(map(len, self.text), np.int32, len(self.text))
        self.odd = (self.length > HELD) | (self.points >= POINTS).any(axis=1)
        self.points = np.ascontiguousarray(np.minimum(self.points, POINTS).astype(np.int16).T)  # place by place
        held, places = self.points > 0, self.points % 32
        counts = np.stack([((places == k) & held).sum(axis=0, dtype=np.uint8) for k in range(32)], axis=1)
        words = [np.packbits(counts > t, axis=1, bitorder="little").view(np.uint32)[:, 0].astype(np.uint64) for t in range(levels)]
        self.sets = [words[t] | words[t + 1] << np.uint64(32) for t in range(0, levels, 2)]
        self.rest = self.length - sum(np.bitwise_count(s).astype(np.int32) for s in self.sets)  # characters that are not in the sets
        self._patterns = self._places = None

    def common(self, rows: np.ndarray, other: Strings, at: np.ndarray) -> np.ndarray:
        """At least the number of characters that pairs of rows share."""
        out = np.minimum(self.rest[rows], other.rest[at])
        for mine, theirs in zip(self.sets, other.sets, strict=True):
            out += np.bitwise_count(theirs[at] & mine[rows])
        short = np.minimum(self.length[rows], other.length[at])
        # characters beyond the held ones may equal any
        return np.where((self.length[rows] > HELD) | (other.length[at] > HELD), short, np.minimum(out, short))

    @property
    def patterns(self) -> list[np.ndarray]:
        """For each word of places, flat: (row, code point) -> the point's places, as bits."""
        if self._patterns is None:
            self._patterns, rows = [], np.arange(self.points.shape[1])
            for start in range(0, HELD, WORD):
                one = np.zeros((len(rows), POINTS + 1), dtype=np.uint64)
                for k in range(WORD):
                    one[rows, self.points[start + k]] |= np.uint64(1 << k)
                one[:, [0, POINTS]] = 0
                self._patterns.append(one.ravel())
        return self._patterns

    @property
    def places(self) -> tuple[np.ndarray, np.ndarray, int]:
        """For the first word of places: code point -> letter, (row, letter) -> the letter's places, as bits, flat, and its letters."""
        if self._places is None:
            points = self.points[:WORD]
            known = np.flatnonzero(np.bincount(points.ravel(), minlength=POINTS + 1)[:POINTS])
            known = known[known > 0]
            letters = np.zeros(POINTS + 1, dtype=np.int64)
            letters[known] = np.arange(1, len(known) + 1)
            table, rows = np.zeros((points.shape[1], len(known) + 1), dtype=np.uint64), np.arange(points.shape[1])
            for k in range(WORD):
                table[rows, letters[points[k]]] |= np.uint64(1 << k)
            table[:, 0] = 0
            self._places = letters, table.ravel(), len(known) + 1
        return self._places


def distances(a: Strings, rows: np.ndarray, b: Strings, at: np.ndarray) -> np.ndarray:
    """Edit distances of pairs of rows."""
    out = np.zeros(len(rows), dtype=np.int32)
    odd = a.odd[rows] | b.odd[at]
    for wide in (False, True):
        left = np.flatnonzero(~odd & ((a.length[rows] > WORD) == wide))
        for part in _longest_first(left, b.length[at[left]]):
            out[part] = _lanes(a, rows[part], b, at[part], 2 if wide else 1)
    seen: dict[tuple[str, str], int] = {}
    for k in np.flatnonzero(odd):
        pair = a.text[rows[k]], b.text[at[k]]
        if pair not in seen:
            seen[pair] = 0 if pair[0] == pair[1] else distance(*pair)
        out[k] = seen[pair]
    return out


def _longest_first(places: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """LANES places at a time, of falling lengths: those of one step are always the first ones."""
    places = places[np.argsort((HELD - length).astype(np.uint8), kind="stable")]
    return [places[start : start + LANES] for start in range(0, len(places), LANES)]


def _live(length: np.ndarray) -> np.ndarray:
    """For each step the number of lanes that it reaches; lengths fall."""
    steps = np.arange(int(length[0]) if len(length) else 0)
    return len(length) - np.searchsorted(length[::-1], steps, side="right")


def _lanes(a: Strings, rows: np.ndarray, b: Strings, at: np.ndarray, words: int) -> np.ndarray:
    """Myers' bit vectors, one pair a lane, targets' lengths falling; patterns of several words hand their carries on.

    A lane stays as its last step left it: its vertical differences add up to the distance.
    """
    m, n, size = a.length[rows], b.length[at], len(rows)
    one, last = np.uint64(1), np.uint64(WORD - 1)
    up, down = [np.full(size, ~np.uint64(0)) for _ in range(words)], [np.zeros(size, dtype=np.uint64) for _ in range(words)]
    base, place_, (eq_, xv_, xh_, ph_) = rows * (POINTS + 1), np.empty(size, dtype=np.int64), np.empty((4, size), dtype=np.uint64)
    for k, live in enumerate(_live(n)):
        place, eq, xv, xh, ph = place_[:live], eq_[:live], xv_[:live], xh_[:live], ph_[:live]
        np.add(base[:live], b.points[k].take(at[:live]), out=place)
        more, less = one, None
        for w in range(words):
            vp, vm = up[w][:live], down[w][:live]
            a.patterns[w].take(place, out=eq, mode="clip")
            np.bitwise_or(eq, vm, out=xv)
            if less is not None:
                np.bitwise_or(eq, less, out=eq)
            np.bitwise_and(eq, vp, out=xh)
            np.add(xh, vp, out=xh)
            np.bitwise_xor(xh, vp, out=xh)
            np.bitwise_or(xh, eq, out=xh)
            np.bitwise_or(xh, vp, out=ph)
            np.invert(ph, out=ph)
            np.bitwise_or(ph, vm, out=ph)
            mh = np.bitwise_and(xh, vp, out=xh)
            carry = (ph >> last, mh >> last) if w < words - 1 else (None, None)
            np.left_shift(ph, one, out=ph)
            np.bitwise_or(ph, more, out=ph)
            np.left_shift(mh, one, out=mh)
            if less is not None:
                np.bitwise_or(mh, less, out=mh)
            np.bitwise_and(ph, xv, out=vm)
            np.bitwise_or(xv, ph, out=xv)
            np.invert(xv, out=xv)
            np.bitwise_or(xv, mh, out=vp)
            more, less = carry
    out = n.copy()
    for w in range(words):
        held = np.clip(m - WORD * w, 0, WORD).astype(np.uint64)
        full = np.where(held > 0, ~np.uint64(0) >> (np.uint64(WORD) - np.maximum(held, one)), np.uint64(0))
        out += np.bitwise_count(up[w] & full).astype(np.int32) - np.bitwise_count(down[w] & full).astype(np.int32)
    return out


class Sets:
    """Distinct tokens of each row: 64 bits for bounds, codes for exact counts."""

    def __init__(self, values: pa.Array, known: pa.Array | None) -> None:
        flat = values.flatten()
        self.size = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int32)
        if known is None:
            coded = flat.dictionary_encode()
            known, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        else:
            codes = pc.fill_null(pc.index_in(flat, value_set=known), -1).to_numpy(zero_copy_only=False)
        self.words, self.codes = known, codes.astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.size)])
        rows = np.repeat(np.arange(len(values)), self.size)
        self.bits = np.zeros(len(values), dtype=np.uint64)
        hit = self.codes >= 0  # a reference's token that no target has is in no overlap
        np.bitwise_or.at(self.bits, rows[hit], np.uint64(1) << (self.codes[hit] % 64).astype(np.uint64))
        inside = np.bincount(rows[hit], minlength=len(values)).astype(np.int32)
        self.spare = inside - np.bitwise_count(self.bits).astype(np.int32)
        place = np.arange(len(rows)) - self.starts[rows]
        self.held = np.full((max(1, min(TOKENS, int(self.size.max(initial=0)))), len(values)), -1, dtype=np.int32)
        fits = place < TOKENS
        self.held[place[fits], rows[fits]] = self.codes[fits]

    def most(self, rows: np.ndarray, other: Sets, at: np.ndarray) -> np.ndarray:
        """At least the Jaccard similarities of pairs of rows."""
        n, m = self.size[rows], other.size[at]
        common = np.minimum(np.bitwise_count(other.bits[at] & self.bits[rows]) + np.minimum(self.spare[rows], other.spare[at]), np.minimum(n, m))
        return _share(common, n + m - common)

    def jaccard(self, rows: np.ndarray, other: Sets, at: np.ndarray) -> np.ndarray:
        common = np.zeros(len(rows), dtype=np.int32)
        for start in range(0, len(rows), LANES):
            part = slice(start, start + LANES)
            theirs = [column[at[part]] for column in other.held]
            for column in self.held:
                mine = column[rows[part]]
                mine[mine < 0] = -2
                for one in theirs:
                    common[part] += one == mine
        n, m = self.size[rows], other.size[at]
        for k in np.flatnonzero((n > TOKENS) | (m > TOKENS)):
            mine, theirs = (s.codes[s.starts[x] : s.starts[x + 1]] for s, x in ((self, rows[k]), (other, at[k])))
            common[k] = len(np.intersect1d(mine[mine >= 0], theirs))
        return _share(common, n + m - common)


#: Cells of a table that pairs of codes are looked up in; more of them are sorted.
TABLE = 1 << 22


def distinct(x: np.ndarray, y: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct pair of codes, rising, and which of these each pair is; width: over every y."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = (x - x.min()) * np.int64(width) + y
    size = int(keys.max()) + 1
    if size <= TABLE:
        table = np.empty(size, dtype=np.int32)  # read where it was written only
        table[keys] = np.arange(len(keys), dtype=np.int32)
        mine = table[keys]
    else:
        _, first, back = np.unique(keys, return_index=True, return_inverse=True)
        mine = first[back]
    own = mine == np.arange(len(keys))
    return np.flatnonzero(own), (np.cumsum(own) - 1)[mine]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """part / whole; 1 where both sides are empty."""
    return np.where(whole > 0, part / np.maximum(whole, 1), 1.0)


class Records:
    """One side's sketches; references are coded by the targets' words."""

    def __init__(self, table: pa.Table | pa.RecordBatch, targets: Records | None = None) -> None:
        self.text = {f: Strings(_column(table, f), LEVELS[f]) for f in LEVELS}
        self.sets = {f: Sets(_column(table, f"{f}_tokens"), targets and targets.sets[f].words) for f in LEVELS}
        self.codes, self.words, self.own, self.count = {}, {}, {}, {}
        for f in (*FLAGS, *LEVELS):
            values = _column(table, f)
            self.words[f] = targets.words[f] if targets else values.unique()
            self.codes[f] = pc.fill_null(pc.index_in(values, value_set=self.words[f]), -1).to_numpy(zero_copy_only=False)
            if f in LEVELS:
                coded = values.dictionary_encode()
                self.own[f], self.count[f] = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
            if f == "postal":
                self.codes[f] = np.where(pc.equal(values, "").to_numpy(zero_copy_only=False), -1, self.codes[f])

    def once(self, rows: np.ndarray, other: Records, at: np.ndarray, field: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of each side for every distinct pair of texts, and which of these each pair has."""
        first, back = distinct(self.own[field][rows], other.own[field][at], other.count[field])
        return rows[first], at[first], back


@dataclass(frozen=True)
class Floor:
    """Pairs whose rule score is floor or more, by the rule's weights."""

    least: float
    weights: tuple[tuple[str, float], ...]

    def likely(self, a: Records, rows: np.ndarray, b: Records, at: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Places of the pairs that stay by what is known without an edit distance, and the parts of their bounds."""
        w = dict(self.weights)
        name, other = a.text["name"], b.text["name"]
        n, m = name.length[rows], other.length[at]
        common = name.common(rows, other, at)
        tokens, places = a.sets["name"].most(rows, b.sets["name"], at), a.sets["address"].most(rows, b.sets["address"], at)
        fixed = w["name_token_jaccard"] * tokens + w["addr_token_jaccard"] * places
        for f, weight in FLAGS.items():
            fixed += w[weight] * equal(a, rows, b, at, f)
        # Jaro counts at most the common characters; up to four first ones add
        jaro = np.where(common > 0, (common / np.maximum(n, 1) + common / np.maximum(m, 1) + 1) / 3, (n + m == 0) * 1.0)
        address, far = a.text["address"], b.text["address"]
        longest = np.maximum(address.length[rows], far.length[at])
        parts = {"fixed": fixed, "jaro": jaro + 0.4 * (1 - jaro), "most": np.maximum(tokens, places), "name": _share(common, np.maximum(n, m))}
        parts["address"] = _share(np.minimum(address.length[rows], far.length[at]), longest)
        left = np.flatnonzero(self.total(parts) >= self.least - SLACK)
        rows, at, parts = rows[left], at[left], {k: v[left] for k, v in parts.items()}
        parts["address"] = _share(address.common(rows, far, at), longest[left])
        start, prefix = np.ones(len(at), dtype=bool), np.zeros(len(at), dtype=np.int32)
        for k in range(4):
            start &= other.points[k][at] == name.points[k][rows]
            prefix += start
        jaro = jaro[left]
        parts["jaro"] = np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)
        keep = np.flatnonzero(self.total(parts) >= self.least - SLACK)
        return left[keep], {k: v[keep] for k, v in parts.items()}

    def total(self, parts: dict[str, np.ndarray]) -> np.ndarray:
        w = dict(self.weights)
        most = np.maximum(np.maximum(parts["name"], parts["address"]), parts["most"])
        out = parts["fixed"] + w["name_jaro_winkler"] * parts["jaro"]
        return out + w["name_edit_sim"] * parts["name"] + w["addr_edit_sim"] * parts["address"] + w["evidence_strength"] * most

    def scores(self, a: Records, rows: np.ndarray, b: Records, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs that reach the floor, and their scores."""
        left, edits = np.arange(len(rows)), {}
        if self.least > SLACK:
            left, parts = self.likely(a, rows, b, at)
            for field in LEVELS:
                r, c, back = a.once(rows[left], b, at[left], field)
                parts = parts | {field: edits_of(a, r, b, c, field)[back]}
                keep = np.flatnonzero(self.total(parts) >= self.least - SLACK)
                left, parts = left[keep], {k: v[keep] for k, v in parts.items()}
            edits = {f: parts[f] for f in LEVELS}
        rows, at = rows[left], at[left]
        made = {}
        for field, short in (("name", "name"), ("address", "addr")):
            r, c, back = a.once(rows, b, at, field)
            edit = edits_of(a, r, b, c, field)[back] if field not in edits else edits[field]
            made[f"{short}_edit_sim"], made[f"{short}_token_jaccard"] = edit, a.sets[field].jaccard(r, b.sets[field], c)[back]
            if field == "name":
                made["name_jaro_winkler"] = jaro_winklers(a.text[field], r, b.text[field], c, equal(a, r, b, c, field))[back]
        for f, column in FLAGS.items():
            made[column] = equal(a, rows, b, at, f) * 1.0
        made["evidence_strength"] = np.max([made[f] for f in ("name_edit_sim", "addr_edit_sim", "name_token_jaccard", "addr_token_jaccard")], axis=0)
        score = np.zeros(len(rows))
        for feature, weight in self.weights:
            score = score + weight * made[feature]
        score = np.minimum(np.maximum(score, 0.0), 1.0)
        keep = np.flatnonzero(score >= self.least - SLACK)
        return left[keep], score[keep]


def equal(a: Records, rows: np.ndarray, b: Records, at: np.ndarray, field: str) -> np.ndarray:
    mine = a.codes[field][rows]
    return (mine >= 0) & (mine == b.codes[field][at])


def edits_of(a: Records, rows: np.ndarray, b: Records, at: np.ndarray, field: str) -> np.ndarray:
    """Edit similarities of a field."""
    x, y = a.text[field], b.text[field]
    longest, apart = np.maximum(x.length[rows], y.length[at]), np.zeros(len(rows), dtype=np.int32)
    other = np.flatnonzero(~equal(a, rows, b, at, field))
    apart[other] = distances(x, rows[other], y, at[other])
    return np.where(longest > 0, 1 - apart / np.maximum(longest, 1), 1.0)


def jaro_winklers(a: Strings, rows: np.ndarray, b: Strings, at: np.ndarray, same: np.ndarray) -> np.ndarray:
    """``similarity.jaro_winkler`` of pairs of rows, 1 where same; strings without a table one by one, each distinct pair once."""
    out, seen = np.ones(len(rows)), {}
    odd = a.odd[rows] | b.odd[at] | (a.length[rows] > WORD) | (b.length[at] > WORD)
    left = np.flatnonzero(~same & ~odd)
    for part in _longest_first(left, a.length[rows[left]]):
        out[part] = _jaro_lanes(a, rows[part], b, at[part])
    for k in np.flatnonzero(~same & odd):
        pair = a.text[rows[k]], b.text[at[k]]
        if pair not in seen:
            seen[pair] = jaro_winkler(*pair)
        out[k] = seen[pair]
    return out


def _jaro_lanes(a: Strings, rows: np.ndarray, b: Strings, at: np.ndarray) -> np.ndarray:
    """One pair a lane, references' lengths falling: each character takes the first free place of its window, as ``similarity.jaro`` does."""
    n, m = a.length[rows], b.length[at]
    letters, table, width = b.places
    base, one, zero = at * width, np.uint64(1), np.uint64(0)
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
    window_ = (one << (reach + 1).astype(np.uint64)) - one
    used_, lives, mine, found = np.zeros(len(rows), dtype=np.uint64), _live(n), [], []
    for k, live in enumerate(lives):
        window, used = window_[:live], used_[:live]
        at_k = table.take(base[:live] + letters[a.points[k].take(rows[:live])])
        free = at_k & window
        free &= ~used
        bit = free & (~free + one)
        used |= bit
        mine.append(bit != zero)
        found.append(at_k)
        np.left_shift(window, one, out=window)
        window |= k < reach[:live]
    count, rest_ = np.bitwise_count(used_).astype(np.int64), used_.copy()
    moved = np.zeros(len(rows), dtype=np.int64)
    for live, at_k, hit in zip(lives, found, mine, strict=True):
        rest = rest_[:live]
        bit = (rest & (~rest + one)) * hit
        moved[:live] += hit & ((at_k & bit) == zero)
        rest ^= bit
    some = np.maximum(count, 1)
    score = (count / np.maximum(n, 1) + count / np.maximum(m, 1) + (count - moved // 2) / some) / 3
    score = np.where(count > 0, score, (n + m == 0) * 1.0)
    start, prefix = np.ones(len(rows), dtype=bool), np.zeros(len(rows), dtype=np.int32)
    for k in range(4):
        x, y = a.points[k][rows], b.points[k][at]
        start &= (x == y) & (x > 0)
        prefix += start
    return np.where(score > 0.7, score + prefix * 0.1 * (1 - score), score)

"""Best names by weighted ratio, for all pairs of names, as a product of chunks.

Each pair of chunks is one group, as in ``operators.products``.  A task reads a group's target names into blocks and streams its
reference names past them; of a group's pairs only the best of each reference leave the task.  Within a block the ratios of one
reference with all names are made at once: a name is one row of bits for each letter, and longest common subsequences are
bit-parallel over whole blocks.  Pairs that cannot reach the best found so far are dropped by bounds first (letters in common, then
common subsequences, before windows, which are combed for many pairs at once); the others get the very value of ``similarity.weighted_ratio``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from larkspur.functions.similarity import lcs_length, weighted_ratio

#: Names of a chunk on either side, groups for each core, and references of a small chunk.
REF_NAMES, TARGET_NAMES, GROUPS, LEAST_NAMES = 16_384, 65_536, 4, 256
#: References that pass a block together.
STREAM = 1_024
#: Names of a block, letters with a plane of bits (others are looked up), most words of 64 bits of a name, most distinct tokens.
BLOCK, LETTERS, WORDS, TOKENS = 16_384, 64, 4, 60
#: Pairs of a reference whose windows are tried first, and pairs that are combed together.
HOPEFUL, PAIRS = 32, 8_192
#: What rounding may take from a bound.
SLACK = 1e-9
NEVER = 2**62
ONES = np.uint64(2**64 - 1)


class Name:
    """A name with its tokens; sorted texts end in a blank, which adds one to any common subsequence of two of them."""

    def __init__(self, text: str) -> None:
        self.text, tokens = text, text.split()
        self.tokens = sorted(set(tokens))
        self.sorted, self.unique = (" ".join(x) + " " for x in (sorted(tokens), self.tokens))
        self.repeats = len(self.tokens) < len(tokens)
        self.plain = not tokens or " ".join(tokens) != text or len(text) >= 64 * WORDS or len(self.tokens) > TOKENS


class _Planes:
    """For each letter the bits of its places in every text, ``words`` rows of 64."""

    def __init__(self, texts: list[str], words: int) -> None:
        self.words, self.size = words, len(texts)
        sizes = np.array([len(t) for t in texts])
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        rows = np.repeat(np.arange(len(texts)), sizes)
        places = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        letters, codes, counts = np.unique(codes, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        codes, letters = rank[codes], letters[order]
        bits = np.left_shift(np.uint64(1), (places % 64).astype(np.uint64))
        self.code = {chr(c): k for k, c in enumerate(letters)}
        self.sizes = sizes
        self.texts = np.full((sizes.max(), len(texts)), len(letters), dtype=np.uint8 if len(letters) < 254 else np.uint32)
        self.texts[places, rows] = codes
        self.dense = np.zeros((min(LETTERS, len(letters)), words, len(texts)), dtype=np.uint64)
        own = codes < LETTERS
        np.bitwise_or.at(self.dense, (codes[own], places[own] // 64, rows[own]), bits[own])
        order = np.flatnonzero(~own)[np.argsort(codes[~own], kind="stable")]
        self.rare = (places[order] // 64, rows[order], bits[order])
        self.starts = np.searchsorted(codes[order], np.arange(len(letters) + 1))
        self.counts = np.zeros((len(self.dense) + 1, len(texts)), dtype=np.uint8)  # the last: all rare letters
        np.add.at(self.counts, (np.minimum(codes, len(self.dense)), rows), 1)

    def of(self, letter: str, at: np.ndarray | None) -> np.ndarray | None:
        k = self.code.get(letter)
        if k is None:
            return None
        if k < len(self.dense):
            return self.dense[k] if at is None else self.dense[k][:, at]
        held = np.zeros((self.words, self.size), dtype=np.uint64)
        np.bitwise_or.at(held, tuple(x[self.starts[k] : self.starts[k + 1]] for x in self.rare[:2]), self.rare[2][self.starts[k] : self.starts[k + 1]])
        return held if at is None else held[:, at]

    def letters(self, text: str) -> np.ndarray:
        """At most so many letters can text and each of the texts have in common."""
        most, rare = np.zeros(self.size, dtype=np.uint8), 0
        part = np.empty_like(most)
        for letter, n in Counter(text).items():
            k = self.code.get(letter)
            if k is not None and k < len(self.dense):
                most += np.minimum(self.counts[k], np.uint8(min(n, 255)), out=part)
            elif k is not None:
                rare += n
        return most + np.minimum(self.counts[-1], np.uint8(min(rare, 255))) if rare else most

    def coded(self, text: str) -> np.ndarray:
        """Letters as in texts; those that none of them has are equal to nothing."""
        return np.array([self.code.get(c, len(self.code) + 1) for c in text], dtype=self.texts.dtype)

    def masks(self, text: str, at: np.ndarray | None, without: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """The planes of text's letters, less some bits."""
        planes = {letter: self.of(letter, at) for letter in set(text)}
        return {letter: p if without is None else p & ~without for letter, p in planes.items() if p is not None}

    def common(self, text: str, at: np.ndarray | None, without: np.ndarray | None = None) -> np.ndarray:
        """The longest common subsequence of text and each of the texts (at: of these)."""
        return subsequences(text, self.masks(text, at, without), (self.words, self.size if at is None else len(at)))


def subsequences(text: str, masks: dict[str, np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Longest common subsequences of text and what masks are of, bit-parallel with carries from word to word."""
    rows = np.full(shape, ONES)
    hit, total = np.empty(shape[1], dtype=np.uint64), np.empty(shape[1], dtype=np.uint64)
    for letter in text:
        mask = masks.get(letter)
        if mask is None:
            continue
        carry = None
        for k, row in enumerate(rows):
            np.bitwise_and(row, mask[k], out=hit)
            np.add(row, hit, out=total)
            over = total < row if shape[0] > 1 else None
            if carry is not None:
                total += carry
                over |= total < carry
            np.bitwise_xor(row, hit, out=row)
            np.bitwise_or(row, total, out=row)
            carry = over.astype(np.uint64) if over is not None else None
    return np.bitwise_count(~rows).sum(axis=0, dtype=np.int64)


class Block:
    """Target names of like length.  first: the order of their first records, many: their records."""

    def __init__(self, names: list[Name], places: np.ndarray, first: np.ndarray, many: np.ndarray, words: int) -> None:
        self.places, self.first, self.many = places, first, many
        self.made: dict[int, tuple] = {}
        self.raw, self.sorted, self.unique = (_Planes([getattr(n, k) for n in names], words) for k in ("text", "sorted", "unique"))
        self.size = np.array([len(n.text) for n in names])
        self.short = np.array([len(n.unique) - 1 for n in names])
        self.repeats = np.array([n.repeats for n in names])
        self.again = np.flatnonzero(self.repeats)
        held: dict[str, list[tuple[int, int]]] = {}
        for row, name in enumerate(names):
            place = 0
            for token in name.tokens:
                held.setdefault(token, []).append((row, ((1 << len(token) + 1) - 1) << place))
                place += len(token) + 1
        self.tokens = {}
        for token, found in held.items():
            bits = np.array([[b >> 64 * w & 2**64 - 1 for _, b in found] for w in range(words)], dtype=np.uint64)
            self.tokens[token] = (np.array([r for r, _ in found]), bits)

    def _floor(self, at: np.ndarray, score: np.ndarray, top_k: int, floor: float) -> float:
        """The score that top_k records have reached, if it is over the floor."""
        over = np.flatnonzero(score >= floor)
        if len(over) > top_k:
            over = over[np.argpartition(-score[over], top_k - 1)[:top_k]]
        over = over[np.argsort(-score[over])]
        n = int(np.searchsorted(np.cumsum(self.many[at[over]]), top_k))
        return float(score[over[n]]) if n < len(over) else floor

    def _lengths(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What depends on a reference's length alone: near ones, rows of the others, partial ratios' discounts, what a common letter adds."""
        if length not in self.made:
            share = np.maximum(self.size, length) / np.minimum(self.size, length)
            self.made[length] = (share < 1.5, np.flatnonzero(share >= 1.5), np.where(share < 8, 0.9, 0.6), 2 / (self.size + length))
        return self.made[length]

    def scores(self, a: Name, floor: float, last: int, top_k: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray] | None]:
        """Rows and scores of all names that may be among the best top_k records, with the floor or more.

        Names of the floor itself may be left out if their first record is after the last; scores are without partial ratios below 1; where these may add to them, there are also kinds, rows, factors, bounds and scores.
        """
        la, ua, words = len(a.text), len(a.unique) - 1, self.raw.words
        near, far, scale, over = self._lengths(la)
        code, shared = np.zeros(len(self.size), dtype=np.int64), np.zeros(len(self.size), dtype=np.int64)
        for k, token in enumerate(a.tokens):
            if token in self.tokens:
                rows = self.tokens[token][0]
                code[rows] |= 1 << k
                shared[rows] += len(token) + 1
        some = code > 0
        most = self.raw.letters(a.text).astype(np.int64)

        bound = most * over
        again = np.flatnonzero(near) if a.repeats else self.again[near[self.again]]
        if len(again):
            bound[again] = np.maximum(bound[again], 0.95 * 2 * np.minimum(most[again], np.minimum(self.short[again], ua)) / (self.short[again] + ua))
        at = np.flatnonzero(some & near)
        if len(at):  # those of the part that is not shared, or of the shared part and a whole
            rest = np.minimum(np.maximum(most[at] - shared[at], 0), np.minimum(self.short[at], ua) - shared[at]) + 1
            bound[at] = np.maximum(bound[at], 0.95 * self._set(ua, at, shared[at], rest))
        if len(far):
            held, least = most[far], np.minimum(self.size[far], la)
            inner = _window(least, held)
            if a.repeats or len(self.again):
                inner = np.maximum(inner, 0.95 * _window(np.minimum(self.short[far], ua), held))
            bound[far] = np.maximum(bound[far], scale[far] * inner)
            # a shared token gives a score that is known at once: of those that can reach no other, only the first ones count
            alike = far[some[far]]
            known = 0.95 * scale[alike] * 1.0
            order = np.argsort(self.first[alike], kind="stable")
            for value in np.unique(known)[::-1]:
                own = alike[order][known[order] == value]
                if value > floor and self.many[own].sum() >= top_k:
                    floor, last = float(value), NEVER
                stuck = bound[own] < value - SLACK
                bound[own] = np.maximum(bound[own], value)
                out = own[stuck]
                bound[out[top_k:] if value > floor else out if value < floor else np.concatenate([out[self.first[out] > last], out[top_k:]])] = 0.0
        at, hopes = np.flatnonzero(bound >= floor - SLACK), []
        if not len(at):
            return at, np.empty(0), None

        every = None if len(at) * 2 > len(self.size) else at
        own = at if every is None else slice(None)

        def common(planes: _Planes, text: str) -> np.ndarray:
            return planes.common(text, every)[own]

        size, near, some, code, scale = self.size[at], near[at], some[at], code[at], scale[at]
        alike = common(self.raw, a.text)
        score = 2 * alike / (size + la)
        in_order = alike
        loose = np.flatnonzero(near | ~some)
        if len(loose):
            in_order = np.zeros(len(at), dtype=np.int64)
            in_order[loose] = common(self.sorted, a.sorted)[loose] - 1 if every is None else self.sorted.common(a.sorted, at[loose]) - 1
        once = in_order.copy()
        apart = np.flatnonzero((self.repeats[at] | a.repeats) & ~some)
        if len(apart):
            once[apart] = self.unique.common(a.unique, at[apart]) - 1

        short = self.short[at]
        tokens = np.maximum(2 * in_order / (size + la), np.where(some, 0.0, 1 - (short + ua - 2 * once) / (short + ua)))
        score = np.where(near, np.maximum(score, 0.95 * tokens), score)
        both = np.flatnonzero(near & some)
        for one in np.unique(code[both]):
            mine = both[code[both] == one]
            left = [t for k, t in enumerate(a.tokens) if not one >> k & 1]
            held = [t for k, t in enumerate(a.tokens) if one >> k & 1]
            length = sum(len(t) + 1 for t in held)
            hope = self._set(ua, at[mine], np.full(len(mine), length), np.minimum(short[mine], ua) - length + 1)
            mine = mine[(0.95 * hope >= floor - SLACK) & (0.95 * hope >= score[mine] - SLACK)]
            if not len(mine):
                continue
            without = np.zeros((words, len(at)), dtype=np.uint64)
            place = np.full(len(self.size), -1)
            place[at[mine]] = mine
            for token in held:
                rows, bits = self.tokens[token]
                seen = place[rows] >= 0
                without[:, place[rows[seen]]] |= bits[:, seen]
            rest = " ".join(left) + " "
            kept = self.unique.common(rest, at[mine], without[:, mine]) if left else np.zeros(len(mine), dtype=np.int64)
            score[mine] = np.maximum(score[mine], 0.95 * self._set(ua, at[mine], np.full(len(mine), length), kept))

        far = np.flatnonzero(~near)
        if len(far):
            score[far] = np.where(some[far], np.maximum(score[far], 0.95 * scale[far] * 1.0), score[far])
        floor = self._floor(at, score, top_k, floor)
        if len(far):
            for kind, (length, sizes, found, factor, which) in enumerate((
                (la, size, alike, scale, ~near),
                (la, size, in_order, 0.95 * scale, ~near & ~some),
                (ua, short, once, 0.95 * scale, ~near & ~some & (self.repeats[at] | a.repeats)),
            )):
                hope = factor * _window(np.minimum(sizes, length), found)
                left = np.flatnonzero(which & (hope >= floor - SLACK) & (hope > score - SLACK))
                hopes.append((np.full(len(left), kind), at[left], factor[left], hope[left], score[left]))
        good = score >= floor - SLACK
        return at[good], score[good], [np.concatenate(x) for x in zip(*hopes, strict=True)] if hopes else None

    def partial(self, refs: list[Name], own: np.ndarray, kinds: np.ndarray, at: np.ndarray) -> np.ndarray:
        """``similarity.partial_ratio`` of pairs; kinds: of which texts."""
        best = np.zeros(len(own))
        for kind, (planes, text) in enumerate(((self.raw, "text"), (self.sorted, "sorted"), (self.unique, "unique"))):
            pairs = np.flatnonzero(kinds == kind)
            if not len(pairs):
                continue
            used, mine = np.unique(own[pairs], return_inverse=True)
            texts = [planes.coded(getattr(refs[r], text)[: -1 if kind else None]) for r in used]
            sizes = np.array([len(x) for x in texts])
            wide = np.full((sizes.max(), len(texts)), len(planes.code) + 2, dtype=planes.texts.dtype)
            for k, x in enumerate(texts):
                wide[: len(x), k] = x
            left, right = sizes[mine], planes.sizes[at[pairs]] - (kind > 0)
            for theirs in (True, False):  # whose windows: those of the names or of the references
                inner = np.flatnonzero(right >= left if theirs else left >= right)
                short, long = (left[inner], right[inner]) if theirs else (right[inner], left[inner])
                inner = inner[order := np.lexsort((long, short))]
                short, long = short[order], long[order]
                cuts = np.flatnonzero(np.diff(short)) + 1
                for start, end in zip([0, *cuts], [*cuts, len(inner)], strict=True):
                    for k in range(start, end, PAIRS):
                        part = inner[k : min(k + PAIRS, end)]
                        m, size = int(short[k]), long[k : min(k + PAIRS, end)]
                        a, b = wide[:, mine[part]], planes.texts[:, at[pairs[part]]]
                        s, t = (a, b) if theirs else (b, a)
                        t = t[: size.max()]
                        best[pairs[part]] = np.maximum(best[pairs[part]], windows(s[:m], t, size))
        return best

    def _set(self, ua: int, at: np.ndarray, shared: np.ndarray, kept: np.ndarray) -> np.ndarray:
        """``similarity.token_set_ratio`` for names with common tokens; shared: their length with a blank after each, kept: the common subsequence of the rest and its blank."""
        joined = shared - 1
        left, right = np.maximum(ua - shared, 0), np.maximum(self.short[at] - shared, 0)
        la, lb = joined + 1 + left, joined + 1 + right
        best = 1 - (left + right - 2 * (kept - 1)) / (la + lb)
        best = np.maximum(best, np.maximum(1 - (1 + left) / (joined + la), 1 - (1 + right) / (joined + lb)))
        return np.where((left == 0) | (right == 0), 1.0, best)


def windows(short: np.ndarray, long: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The best ratio of short and any window of long as long as it, windows cut by long's ends too, for each column of letters.

    Sizes are those of long; what follows is equal to no letter.  By semi-local combing: of the strands that enter at the top, those
    that neither a window's start nor its end cuts off are the letters that its common subsequence lacks.
    """
    m, (n, many) = len(short), long.shape
    kind = np.uint8 if n < 255 else np.uint16
    down = np.repeat(np.arange(1, n + 1, dtype=kind)[:, None], many, axis=1)
    across, short = np.zeros((m, many), dtype=kind), short[::-1]
    for step in range(m + n - 1):  # cells of one diagonal are independent of each other
        start, end = max(0, step - m + 1), min(n, step + 1)
        rows = slice(m - 1 - step + start, m - 1 - step + end)
        v, h = down[start:end], across[rows]
        bounced = np.negative(np.equal(short[rows], long[start:end]).view(np.uint8))
        bounced = bounced if kind is np.uint8 else bounced * kind(257)
        np.bitwise_or(bounced, h, out=bounced)
        np.minimum(bounced, v, out=bounced)
        v ^= h
        v ^= bounced
        h[:] = bounced
    down[np.arange(n)[:, None] >= sizes] = 0
    best = np.zeros(many)
    for start in range(1 - m, n):
        low, high = max(0, start), min(start + m, n)
        width = np.maximum(np.minimum(sizes, high) - low, 0)
        lacking = np.add.reduce((down[low:high] > low).view(np.uint8), axis=0, dtype=np.uint8)
        np.maximum(best, 2 * (width - lacking) / (m + width), out=best)
    return best


def _window(shorter: np.ndarray, common: np.ndarray) -> np.ndarray:
    """No window has a better ratio than one of the common letters alone."""
    least = np.minimum(shorter, common)
    return 2 * least / (shorter + least)


def _plainly(a: str, b: str, floor: float) -> float:
    """``weighted_ratio``, or less where it is below the floor."""
    short, long = sorted((a, b), key=len)
    if len(long) / len(short) < 1.5 or set(a.split()) & set(b.split()):
        return weighted_ratio(a, b) if len(long) / len(short) < 8 or floor < 0.6 or short in long else 0.0
    scale, best = 0.9 if len(long) / len(short) < 8 else 0.6, 0.0
    if scale == 0.6 and floor >= 0.6:
        return 0.6 if short in long else 0.0
    for x, y in ((a, b), *((" ".join(sorted(k(a.split()))), " ".join(sorted(k(b.split())))) for k in (list, set))):
        least, found = min(len(x), len(y)), lcs_length(x, y)
        best = max(best, 2 * found / (least + found) if least + found else 1.0)
    return weighted_ratio(a, b) if max(scale * best, 2 / (1 + len(long) / len(short))) >= floor - SLACK else 0.0


class Names:
    """The target names of one group.  first: the order of their first records, many: their records."""

    def __init__(self, names: list[str], first: np.ndarray, many: np.ndarray, kernel: Callable[[str, str], float] | None = None) -> None:
        self.names, self.first, self.many, self.kernel = names, first, many, kernel
        made = [Name(n) for n in names]
        words = np.array([0 if kernel or n.plain else len(n.text) // 64 + 1 for n in made])
        self.blocks, self.plain = [], np.flatnonzero(words == 0)
        for w in np.unique(words[words > 0]):
            own = np.flatnonzero(words == w)
            for k in range(0, len(own), BLOCK):
                at = own[k : k + BLOCK]
                self.blocks.append(Block([made[i] for i in at], at, first[at], many[at], int(w)))

    def _trim(self, at: np.ndarray, scores: np.ndarray, top_k: int) -> tuple[np.ndarray, np.ndarray, float]:
        """The names that may have one of the best top_k records, by score and first record, and the score that top_k records reach (0: none).

        Of names of one score any may hold the next id, whatever the first one's records are: as many names as records are kept.
        """
        if len(at) > top_k:
            least = np.partition(scores, -top_k)[-top_k]
            at, scores = at[scores >= least], scores[scores >= least]
        order = np.lexsort((self.first[at], -scores))[:top_k]
        at, scores = at[order], scores[order]
        total = np.cumsum(self.many[at])
        n = int(np.searchsorted(total, top_k))
        least = float(scores[n]) if n < len(at) else 0.0
        return at[scores >= least], scores[scores >= least], least

    def best(self, texts: list[str], top_k: int, min_score: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and scores of each text's best names, enough for its top_k records."""
        refs = [Name(t) for t in texts]
        kept = [(np.empty(0, dtype=np.int64), np.empty(0), min_score / 100, NEVER) for _ in refs]

        def add(r: int, at: np.ndarray, scores: np.ndarray) -> None:
            good = scores * 100 >= min_score
            if good.any():
                at, scores = np.concatenate([kept[r][0], at[good]]), np.concatenate([kept[r][1], scores[good]])
                order = np.lexsort((-scores, at))
                order = order[np.diff(at[order], prepend=-1) > 0]
                at, scores, least = self._trim(at[order], scores[order], top_k)
                last = int(self.first[at[-1]]) if len(at) == top_k and scores[-1] == least else NEVER
                kept[r] = (at, scores, max(min_score / 100, least), last)

        for block in self.blocks:
            hopes = []
            for r, a in enumerate(refs):
                if not a.plain:
                    at, scores, more = block.scores(a, kept[r][2], kept[r][3], top_k)
                    add(r, block.places[at], scores)
                    if more is not None and len(more[0]):
                        hopes.append((np.full(len(more[0]), r), *more))
            if not hopes:
                continue
            own, kinds, at, factor, hope, base = (np.concatenate(x) for x in zip(*hopes, strict=True))
            order = np.lexsort((-hope, own))
            own, kinds, at, factor, hope, base = (x[order] for x in (own, kinds, at, factor, hope, base))
            rank = np.arange(len(own)) - np.searchsorted(own, own)
            for turn in (rank < HOPEFUL, rank >= HOPEFUL):  # the most hopeful ones first: they raise the floor
                floors = np.array([k[2] for k in kept])
                left = np.flatnonzero(turn & (hope >= floors[own] - SLACK))
                if len(left):
                    scores = np.maximum(base[left], factor[left] * block.partial(refs, own[left], kinds[left], at[left]))
                    cuts = np.flatnonzero(np.diff(own[left])) + 1
                    for start, end in zip([0, *cuts], [*cuts, len(left)], strict=True):
                        add(int(own[left[start]]), block.places[at[left[start:end]]], scores[start:end])
        for r, a in enumerate(refs):
            left = range(len(self.names)) if a.plain or self.kernel else self.plain
            for k in left:
                score = self.kernel(a.text, self.names[k]) if self.kernel else _plainly(a.text, self.names[k], kept[r][2])
                if score >= kept[r][2] - SLACK:
                    add(r, np.array([k]), np.array([score]))
        for at, scores, *_ in kept:
            yield at, scores


def best_names(
    ref: DataFrame, tgt: DataFrame, top_k: int, min_score: float, kernel: Callable[[str, str], float] | None = None,
    ref_names: int = REF_NAMES, target_names: int = TARGET_NAMES,
) -> DataFrame:
    """ref (a), tgt (id, part, b) -> (a, part, b, score): names enough for the top_k records of each name and part, best first, ties by id.

    kernel: scores pairs one by one instead of the weighted ratio.  Names are not empty.
    """
    spark = ref.sparkSession
    names = ref.select("a").distinct()
    others = tgt.groupBy("part", "b").agg(F.min(F.struct("id")).alias("first"), F.count("*").alias("many"))
    sizes = {r.part: r["count"] for r in others.groupBy("part").count().orderBy("part").collect()}
    n, parts, down = names.count(), list(sizes), max(1, -(-max(sizes.values(), default=0) // target_names))
    kinds = T.StructType([T.StructField("part", tgt.schema["part"].dataType), T.StructField("p", T.IntegerType())])
    numbers = F.broadcast(spark.createDataFrame([(p, k) for k, p in enumerate(parts)], kinds).withColumnRenamed("part", "known"))
    pairs = max(1, len(parts) * down)
    across = max(1, -(-n // ref_names), min(-(-n // LEAST_NAMES), -(-GROUPS * spark.sparkContext.defaultParallelism // pairs)))
    groups = pairs * across

    mine, theirs = F.pmod(F.xxhash64("a"), F.lit(across)).cast("int"), F.pmod(F.xxhash64("b"), F.lit(down)).cast("int")
    a = names.withColumn("i", mine).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(pairs - 1))))
    a = a.select((F.col("i") * pairs + F.col("q")).alias("g"), F.lit(True).alias("late"), F.col("a").alias("name"))
    b = others.join(numbers, F.col("part").eqNullSafe(F.col("known"))).withColumn("q", F.col("p") * down + theirs)
    b = b.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    b = b.select((F.col("i") * pairs + F.col("q")).alias("g"), F.lit(False).alias("late"), F.col("b").alias("name"), "part", F.col("first.id").alias("id"), F.least("many", F.lit(top_k)).cast("int").alias("many"))
    rows = b.unionByName(a, allowMissingColumns=True).repartitionById(groups, F.col("g")).sortWithinPartitions("g", "late")
    made = T.StructType([T.StructField("a", T.StringType()), kinds["part"], T.StructField("b", T.StringType()), T.StructField("score", T.DoubleType())])
    arrow = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, part, targets = None, [], None, None
        for whole in batches:
            keys, late = whole["g"].to_numpy(), whole["late"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (late[1:] != late[:-1])) + 1
            for start, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if start == end:
                    continue
                if keys[start] != group:
                    group, held, targets = keys[start], [], None
                piece = whole.slice(start, end - start)
                if not late[start]:
                    held.append(piece)
                elif held or targets:
                    if held:
                        table = pa.Table.from_batches(held)
                        part, held = table["part"][0].as_py(), []
                        first = np.empty(len(table), dtype=np.int64)
                        order = pc.sort_indices(table, sort_keys=[("id", "ascending")], null_placement="at_start")
                        first[order.to_numpy()] = np.arange(len(table))
                        targets = Names(table["name"].to_pylist(), first, table["many"].to_numpy(), kernel)
                    texts = piece["name"].to_pylist()
                    found = [x for k in range(0, len(texts), STREAM) for x in targets.best(texts[k : k + STREAM], top_k, min_score)]
                    size = [len(at) for at, _ in found]
                    if sum(size):
                        at, scores = (np.concatenate(x) for x in zip(*found, strict=True))
                        mine = pa.array(texts, pa.string()).take(pa.array(np.repeat(np.arange(len(texts)), size)))
                        yield pa.RecordBatch.from_arrays(
                            [mine, pa.array([part] * len(at), arrow.field("part").type), pa.array([targets.names[k] for k in at], pa.string()), pa.array(scores)], schema=arrow
                        )

    return rows.mapInArrow(run, made)

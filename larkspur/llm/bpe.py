"""Byte-level BPE encoding and decoding with padded numpy matrices.

A text is cut by the tokenizer's pattern; each match is encoded separately by the ranks, without
special tokens.  Matches not seen before are put into buckets by byte length, one padded matrix
each.  Every round, every row merges its leftmost pair of least rank: ranks come from an
open-addressing hash table of id pairs, the merged row is compacted by one cell, and rows without
a further merge leave the matrix.  A match over ``MATRIX_BYTES`` is a row of its own, whose rounds
take every occurrence of the least rank at once, from the left: where no pair with the new token has
a rank below it, that is the same order.  Of tokens that are part of one of lower rank, such a row
too takes one merge a round.

Matches are cached per worker, up to ``CACHE_ENTRIES`` (then the cache starts afresh).
Very long texts are read in runs of matches, so memory follows the run and not the text.
Null text counts as empty: no tokens, and the digests of nothing.  Rows repeat as they are.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm.worker import held

CACHE_ENTRIES = 160_000
MATRIX_BYTES = 256
MATRIX_CELLS = 1 << 17
LONG_TEXT = 1_000_000
RUN_MATCHES = 100_000
#: A rank file larger than this is refused: it is broadcast to every worker.
MAX_RANK_FILE = 64 << 20
NO_RANK = np.int64(1) << 60


class PairTable:
    """(left id, right id) -> rank of the merged token, by open addressing in numpy."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray):
        bits = max(4, int(len(pairs) * 2 + 1).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, dtype=np.int64)
        self._ranks = np.full(1 << bits, NO_RANK, dtype=np.int64)
        slots = self._slots(pairs)
        left = np.arange(len(pairs))
        self._probes = 0
        while len(left):
            free = self._keys[slots[left]] < 0
            taken = np.unique(slots[left[free]], return_index=True)[1]
            put = left[free][taken]
            self._keys[slots[put]], self._ranks[slots[put]] = pairs[put], ranks[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            slots[left] = (slots[left] + 1) & self._mask
            self._probes += 1

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self._shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NO_RANK where there is none or either id is negative."""
        out = np.full(left.shape, NO_RANK, dtype=np.int64)
        at = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        pairs = (left.ravel()[at] << 32) | right.ravel()[at]
        slots, flat = self._slots(pairs), out.reshape(-1)
        for _ in range(self._probes):
            keys = self._keys[slots]
            hit = keys == pairs
            flat[at[hit]] = self._ranks[slots[hit]]
            go = ~hit & (keys >= 0)
            if not go.any():
                break
            at, pairs, slots = at[go], pairs[go], (slots[go] + 1) & self._mask
        return flat.reshape(left.shape)


class ByteBpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, rank_lines: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_lines.splitlines() if line)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self._byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs, ranks = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    ranks.append(rank)
        known, merged = np.array(pairs, dtype=np.int64), np.array(ranks, dtype=np.int64)
        self.pairs = PairTable(known, merged)
        self._learnt = bool((merged > np.maximum(known >> 32, known & 0xFFFFFFFF)).all())
        early = merged < np.maximum(known >> 32, known & 0xFFFFFFFF)
        parts = np.concatenate((known[early] >> 32, known[early] & 0xFFFFFFFF))
        self._early = frozenset(parts[parts > np.tile(merged[early], 2)].tolist())
        self._cache: dict[str, tuple[int, bytes, bytes]] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece; a piece that is a token itself is that token."""
        out: list[list[int]] = [[] for _ in pieces]
        buckets: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = [whole]
            elif len(piece) > MATRIX_BYTES:
                out[k] = self._merge_long(piece)
            elif piece:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append(k)
        for rows in buckets.values():
            width = max(len(pieces[k]) for k in rows)
            step = max(1, MATRIX_CELLS // width)
            for at in range(0, len(rows), step):
                self._merge_matrix([pieces[k] for k in rows[at : at + step]], rows[at : at + step], out)
        return out

    def _merge_matrix(self, pieces: list[bytes], rows: list[int], out: list[list[int]]) -> None:
        width = max(map(len, pieces))
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(-1, width)
        lengths = np.array([len(p) for p in pieces])
        ids = np.where(np.arange(width)[None, :] < lengths[:, None], self._byte_ids[raw], -1)
        ranks = self.pairs.find(ids[:, :-1], ids[:, 1:])
        names = np.array(rows)
        while len(ids):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(ids), dtype=np.int64)
            best = ranks[np.arange(len(ids)), at] if ranks.shape[1] else np.full(len(ids), NO_RANK)
            done = best >= NO_RANK
            if done.any():
                for name, row in zip(names[done].tolist(), ids[done].tolist(), strict=True):
                    out[name] = [i for i in row if i >= 0]
                ids, ranks, names, at, best = ids[~done], ranks[~done], names[~done], at[~done], best[~done]
                if not len(ids):
                    return
            n, w = ids.shape
            line = np.arange(n)
            ids[line, at] = best
            keep = np.arange(w)[None, :] != (at + 1)[:, None]
            ids = ids[keep].reshape(n, w - 1)
            ranks = ranks[np.arange(w - 1)[None, :] != at[:, None]].reshape(n, w - 2)
            if w > 2:  # only the pairs beside the merged cell change
                inner = at < w - 2
                ranks[line[inner], at[inner]] = self.pairs.find(ids[line[inner], at[inner]], ids[line[inner], at[inner] + 1])
                inner = at > 0
                ranks[line[inner], at[inner] - 1] = self.pairs.find(ids[line[inner], at[inner] - 1], ids[line[inner], at[inner]])

    def _merge_long(self, piece: bytes) -> list[int]:
        """A row of its own: linked cells, and the places of the pairs of each rank."""
        ids = self._byte_ids[np.frombuffer(piece, dtype=np.uint8)].astype(np.int32)
        n = len(ids)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        ranks = np.full(n, NO_RANK, dtype=np.int64)
        places: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []
        queues: dict[int, list[int]] = {}

        def look(at: np.ndarray) -> None:
            """Rank the pairs that begin at these cells."""
            right = after[at]
            found = self.pairs.find(ids[at].astype(np.int64), np.where(right < n, ids[np.minimum(right, n - 1)], -1).astype(np.int64))
            ranks[at] = found
            at, found = at[found < NO_RANK], found[found < NO_RANK]
            if not len(at):
                return
            order = np.argsort(found, kind="stable")
            at, found = at[order], found[order]
            starts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
            for rank, part in zip(found[starts].tolist(), np.split(at, starts[1:]), strict=True):
                if rank not in places:
                    places[rank] = []
                    heapq.heappush(waiting, rank)
                places[rank].append(part)

        for at in range(0, n, 1 << 20):
            look(np.arange(at, min(n, at + (1 << 20)), dtype=np.int32))
        while waiting:
            rank = heapq.heappop(waiting)
            if self._learnt or rank not in self._early:
                at = np.unique(np.concatenate(places.pop(rank)))
                at = at[ranks[at] == rank]
                if not len(at):
                    continue
                # of pairs that overlap in a row, every second one from the left
                fresh = np.concatenate(([True], after[at[:-1]] != at[1:]))
                line = np.arange(len(at))
                at = at[(line - np.maximum.accumulate(np.where(fresh, line, 0))) % 2 == 0]
            else:
                queue = queues.setdefault(rank, [])
                for part in places.pop(rank):
                    if queue:
                        for place in part.tolist():
                            heapq.heappush(queue, place)
                    else:
                        queue.extend(part.tolist())  # in order, and so a heap
                while queue and ranks[queue[0]] != rank:
                    heapq.heappop(queue)
                if not queue:
                    continue
                at = np.array([heapq.heappop(queue)])
                if queue:
                    places[rank] = []
                    heapq.heappush(waiting, rank)
            gone = after[at]
            ranks[gone] = NO_RANK
            ids[at], ids[gone], after[at] = rank, -1, after[gone]
            inner = after[at] < n
            before[after[at][inner]] = at[inner]
            left = before[at]
            look(np.unique(np.concatenate((at, left[left >= 0]))))
        return ids[ids >= 0].tolist()

    def decode(self, ids) -> bytes:
        """The bytes of a sequence of ids."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def _runs(self, text: str) -> Iterator[list[str]]:
        if len(text) <= LONG_TEXT:
            yield self.pattern.findall(text)
            return
        matches = self.pattern.finditer(text)
        while run := [m.group() for m in islice(matches, RUN_MATCHES)]:
            yield run

    def _learn(self, runs: list[list[str]]) -> None:
        """Put the ids of all matches of these runs into the cache, new ones in one go."""
        cache = self._cache
        new = {piece for run in runs for piece in run if piece not in cache}
        if not new:
            return
        if len(cache) + len(new) > CACHE_ENTRIES:  # what these runs use stays
            used = {piece: cache[piece] for run in runs for piece in run if piece in cache}
            cache.clear()
            cache.update(used)
        names = list(new)
        raw = [piece.encode("utf-8", "surrogatepass") for piece in names]
        for piece, ids in zip(names, self.encode_pieces(raw), strict=True):
            cache[piece] = (len(ids), " ".join(map(str, ids)).encode(), self.decode(ids))

    def _groups(self, texts: list[str | None]) -> Iterator[tuple[list[int], Iterator[list[list[str]]]]]:
        """Neighbouring texts of LONG_TEXT characters in all, or one longer text; each with its runs."""
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end] or "") <= LONG_TEXT):
                chars += len(texts[end] or "")
                end += 1
            if end == at + 1:
                yield [at], ([run] for run in self._runs(texts[at] or ""))
            else:
                yield list(range(at, end)), iter([[self.pattern.findall(t or "") for t in texts[at:end]]])
            at = end

    def encode_many(self, texts: list[str | None], with_ids: bool = True) -> list[tuple[int, np.ndarray, str, str]]:
        """For each text: number of ids, the ids, SHA-256 of the ids in decimal and of the decoded bytes."""
        out = []
        for names, blocks in self._groups(texts):
            state = [[0, [], hashlib.sha256(), hashlib.sha256()] for _ in names]
            for runs in blocks:
                self._learn(runs)
                for mine, run in zip(state, runs, strict=True):
                    if not run:
                        continue
                    known = list(map(self._cache.__getitem__, run))
                    if mine[0]:
                        mine[2].update(b" ")
                    mine[0] += sum([k[0] for k in known])
                    told = b" ".join([k[1] for k in known])
                    if with_ids:
                        mine[1].append(np.fromstring(told, dtype=np.int32, sep=" "))
                    mine[2].update(told)
                    mine[3].update(b"".join([k[2] for k in known]))
            for n, ids, a, b in state:
                whole = np.concatenate([np.zeros(0, dtype=np.int32), *ids])
                out.append((n, whole, a.hexdigest(), b.hexdigest()))
        return out

    def encode(self, text: str | None) -> list[int]:
        return self.encode_many([text])[0][1].tolist()


def _shared(spark: SparkSession, path: str, pattern: str):
    with open(path, "rb") as file:
        lines = file.read(MAX_RANK_FILE + 1)
    if len(lines) > MAX_RANK_FILE:
        raise ValueError(f"{path} has over {MAX_RANK_FILE} bytes")
    shared = spark.sparkContext.broadcast((hashlib.sha1(lines).hexdigest(), lines, pattern))

    def coder() -> ByteBpe:
        key, data, cut = shared.value
        return held(("bpe", key, cut), lambda: ByteBpe(data, cut))

    return coder


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encoder(spark: SparkSession, path: str, pattern: str):
    """Column function text -> struct(n_tokens, ids, ids_sha256, decoded_sha256)."""
    coder = _shared(spark, path, pattern)

    @F.pandas_udf("n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")
    def encode(texts: pd.Series) -> pd.DataFrame:
        rows = coder().encode_many(texts.tolist())
        return pd.DataFrame(rows, columns=["n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    return encode


def digester(spark: SparkSession, path: str, pattern: str):
    """Column function text -> struct(n_tokens, ids_sha256, decoded_sha256), without the ids."""
    coder = _shared(spark, path, pattern)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        rows = [(n, a, b) for n, _, a, b in coder().encode_many(texts.tolist(), with_ids=False)]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest


def decoder(spark: SparkSession, path: str, pattern: str):
    """Column function array<int> -> binary."""
    coder = _shared(spark, path, pattern)

    @F.pandas_udf(T.BinaryType())
    def decode(ids: pd.Series) -> pd.Series:
        bpe = coder()
        return pd.Series([bpe.decode(i) if i is not None else b"" for i in ids])

    return decode


def _digest_columns(docs: DataFrame, encoded: Column) -> DataFrame:
    found = docs.select("doc_id", encoded.alias("e"))
    return found.select("doc_id", "e.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return _digest_columns(docs, digester(spark, *default_vocabulary())("text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the ids of every document and the digests of the round trip."""
    return _digest_columns(docs, encoder(spark, *default_vocabulary())("text"))

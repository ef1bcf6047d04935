"""Shared token occurrences of all record pairs, as a product of two sparse matrices.

A join by token makes a row for every shared token and has to move all of them once more to add them up: as many rows as pairs,
or more.  Here records are moved instead, a bounded number of times: references are dealt into chunks, targets into others, and
each pair of chunks is one group.  A task reads a group's targets first, inverts them, then streams its references past them;
counts of one reference are one dense row.  Pairs leave the task as they are found and are never moved.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from larkspur.operators.bounds import SLACK, Floor, Records, sketch
from larkspur.operators.measures import Wide, columns, measures, rounded

#: Records of a chunk: references of one are streamed, targets of one are held by a task.
REF_ROWS, TARGET_ROWS, OUT_ROWS = 16_384, 65_536, 100_000
#: Rows of all features that are handed over at once.
SLICE_ROWS = 10_000
#: References of a chunk whose whole lists are held.
LIST_ROWS = 4_096
#: Groups that a small product is dealt into nevertheless, of that many references or more each.
GROUPS, LEAST_ROWS = 12, 1_024


@dataclass(frozen=True)
class Bag:
    """One way to pair records: tokens (array) of either side, and the occurrences that a pair has to share."""

    ref: Column
    tgt: Column
    least: int = 1


def _side(records: DataFrame, names: dict[str, str], bags: list[Column], more: dict[str, Column] | None = None) -> DataFrame:
    """(ids, t0, t1, ...), one row for each id: tokens of repeated records add up.  With more columns, a row for each record, with its id's tokens."""
    none = F.array().cast("array<string>")
    rows = records.select(
        *[F.col(c).alias(n) for n, c in names.items()], *[F.coalesce(b, none).alias(f"t{k}") for k, b in enumerate(bags)],
        *([F.struct(*[c.alias(n) for n, c in more.items()]).alias("record")] if more else []),
    )
    held = [F.collect_list("record").alias("records")] if more else []
    made = rows.groupBy(*names).agg(*[F.flatten(F.collect_list(f"t{k}")).alias(f"t{k}") for k in range(len(bags))], *held)
    return made.withColumn("record", F.explode("records")).select(*[c for c in made.columns if c != "records"], "record.*") if more else made


def _flat(column: pa.ChunkedArray | pa.Array) -> tuple[pa.Array, np.ndarray]:
    """A list column's values and the row of each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return column.flatten(), np.repeat(np.arange(len(column)), lengths)


class _Targets:
    """The inverted targets of one group."""

    def __init__(self, table: pa.Table, bags: int) -> None:
        self.table, self.records = table, None
        self.ids, self.source = table["id"].combine_chunks(), table["source"].combine_chunks()
        self.size, self.postings = len(table), []
        for k in range(bags):
            values, rows = _flat(table[f"t{k}"])
            coded = values.dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            starts = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
            self.postings.append((coded.dictionary, rows[order], starts))

    def held(self, k: int, tokens: pa.Array, rows: np.ndarray, refs: int) -> Iterator[list[np.ndarray]]:
        """The targets of each token occurrence, reference by reference."""
        words, held, starts = self.postings[k]
        codes = pc.fill_null(pc.index_in(tokens, value_set=words), -1).to_numpy(zero_copy_only=False)
        rows, codes = rows[codes >= 0], codes[codes >= 0]
        ends = np.searchsorted(rows, np.arange(refs + 1))
        for r in range(refs):
            yield [held[starts[c] : starts[c + 1]] for c in codes[ends[r] : ends[r + 1]]]

    def counts(self, k: int, tokens: pa.Array, rows: np.ndarray, refs: int) -> Iterator[np.ndarray | None]:
        """Shared occurrences with every target, reference by reference; None where there are none."""
        for parts in self.held(k, tokens, rows, refs):
            yield np.bincount(np.concatenate(parts), minlength=self.size) if parts else None


def _pairs(refs: pa.RecordBatch, targets: _Targets, least: tuple[int, ...], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    kept: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        ref = pa.array(np.concatenate([np.full(len(x[1]), x[0]) for x in kept]))
        tgt = pa.array(np.concatenate([x[1] for x in kept]))
        shared = [pa.array(np.concatenate([x[2][k] for x in kept]).astype(np.int32)) for k in range(len(least))]
        ids = [refs["id"].take(ref), targets.ids.take(tgt), targets.source.take(tgt)]
        return pa.RecordBatch.from_arrays([*ids, *shared, *[n.take(ref) for n in totals]], schema=schema)

    totals = [pc.list_value_length(refs[f"t{k}"]) for k in range(len(least))]
    streams = [targets.counts(k, *_flat(refs[f"t{k}"]), len(refs)) for k in range(len(least))]
    for r, found in enumerate(zip(*streams, strict=True)):
        any_ = None
        for n, counts in zip(least, found, strict=True):
            if counts is not None:
                any_ = counts >= n if any_ is None else any_ | (counts >= n)
        at = np.flatnonzero(any_) if any_ is not None else ()
        if len(at):
            kept.append((r, at, [np.zeros(len(at), dtype=np.int32) if c is None else c[at] for c in found]))
            size += len(at)
        if size >= OUT_ROWS:
            yield batch()
            kept, size = [], 0
    if kept:
        yield batch()


def _found(refs: pa.RecordBatch, targets: _Targets, least: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs alone, as places in refs and targets, some OUT_ROWS or more at a time."""
    streams = [targets.held(k, *_flat(refs[f"t{k}"]), len(refs)) for k in range(len(least))]
    kept, size, seen = [], 0, np.zeros(targets.size, dtype=bool)
    for r, found in enumerate(zip(*streams, strict=True)):
        for n, parts in zip(least, found, strict=True):
            if n <= 1:
                for part in parts:
                    seen[part] = True
            elif parts:
                seen |= np.bincount(np.concatenate(parts), minlength=targets.size) >= n
        at = np.flatnonzero(seen)
        if len(at):
            seen[at] = False
            kept.append((np.full(len(at), r), at))
            size += len(at)
        if size >= OUT_ROWS:
            yield tuple(np.concatenate(x) for x in zip(*kept, strict=True))
            kept, size = [], 0
    if kept:
        yield tuple(np.concatenate(x) for x in zip(*kept, strict=True))


def _flagged(refs: pa.RecordBatch, targets: _Targets, least: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """``_found`` with whether each bag found a pair."""
    streams = [targets.held(k, *_flat(refs[f"t{k}"]), len(refs)) for k in range(len(least))]
    kept, size, seen, some = [], 0, [np.zeros(targets.size, dtype=bool) for _ in least], np.zeros(targets.size, dtype=bool)

    def batch() -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        rows, at, flags = zip(*kept, strict=True)
        return np.concatenate(rows), np.concatenate(at), [np.concatenate(x) for x in zip(*flags, strict=True)]

    for r, found in enumerate(zip(*streams, strict=True)):
        for n, parts, own in zip(least, found, seen, strict=True):
            for part in parts if n <= 1 else ():
                own[part] = some[part] = True
            if n > 1 and parts:
                hit = np.flatnonzero(np.bincount(np.concatenate(parts), minlength=targets.size) >= n)
                own[hit] = some[hit] = True
        at = np.flatnonzero(some)
        if len(at):
            kept.append((np.full(len(at), r), at, [own[at] for own in seen]))
            size += len(at)
            for own in (*seen, some):
                own[at] = False
        if size >= OUT_ROWS:
            yield batch()
            kept, size = [], 0
    if kept:
        yield batch()


def _scored(refs: pa.RecordBatch, targets: _Targets, least: tuple[int, ...], floor: Floor) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    targets.records = targets.records or Records(targets.table)
    records = Records(refs, targets.records)
    for rows, at in _found(refs, targets, least):
        left, scores = floor.scores(records, rows, targets.records, at)
        if len(left):
            yield rows[left], at[left], scores


def shared_counts(ref: DataFrame, tgt: DataFrame, bags: list[Bag], ref_rows: int = REF_ROWS, target_rows: int = TARGET_ROWS) -> DataFrame:
    """(s1_id, candidate_id, candidate_source, shared_0, ..., total_0, ...) of the pairs that share enough occurrences in one bag at least.

    shared_k counts the occurrences of bag k that a pair shares (repeats multiply), total_k those of the reference.
    """
    kind, source = dict(tgt.dtypes)["source"], to_arrow_type(tgt.schema["source"].dataType)
    numbers = [f"{what}_{k}" for what in ("shared", "total") for k in range(len(bags))]
    schema = f"s1_id string, candidate_id string, candidate_source {kind}, " + ", ".join(f"{n} int" for n in numbers)
    arrow = pa.schema([("s1_id", pa.string()), ("candidate_id", pa.string()), ("candidate_source", source), *[(n, pa.int32()) for n in numbers]])
    least = tuple(x.least for x in bags)
    return _product(ref, tgt, bags, {}, lambda refs, targets: _pairs(refs, targets, least, arrow), schema, ref_rows, target_rows)


def pair_scores(
    ref: DataFrame, tgt: DataFrame, bags: list[Bag], floor: Floor, digits: int | None = None, ref_rows: int = REF_ROWS, target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """(s1_id, candidate_id, score) of those pairs whose rule score is the floor or more (or less by a slack of rounding), once for each pair of records."""
    arrow = pa.schema([("s1_id", pa.string()), ("candidate_id", pa.string()), ("score", pa.float64())])
    least = tuple(x.least for x in bags)

    def run(refs: pa.RecordBatch, targets: _Targets) -> Iterator[pa.RecordBatch]:
        for rows, at, scores in _scored(refs, targets, least, floor):
            scores = scores if digits is None else rounded(scores, digits)
            yield pa.RecordBatch.from_arrays([refs["id"].take(pa.array(rows)), targets.ids.take(pa.array(at)), pa.array(scores)], schema=arrow)

    return _product(ref, tgt, bags, sketch(), run, "s1_id string, candidate_id string, score double", ref_rows, target_rows)


def _measured(
    refs: pa.RecordBatch, targets: _Targets, least: tuple[int, ...], blockers: tuple[str, ...], provenance: dict[str, str], names: tuple[str, ...] | None,
    digits: int | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]]:
    targets.records = targets.records or Wide(targets.table)
    records = Wide(refs, targets.records)
    for rows, at, flags in _flagged(refs, targets, least):
        yield rows, at, measures(records, rows, targets.records, at, dict(zip(blockers, flags, strict=True)), provenance, names, digits)


def pair_features(
    ref: DataFrame, tgt: DataFrame, bags: list[Bag], blockers: tuple[str, ...], provenance: dict[str, str], names: tuple[str, ...], every: bool = False,
    digits: int | None = None, ref_rows: int = REF_ROWS, target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """(s1_id, candidate_id, *names), once for each pair of records; blockers are the names of bags.  every: names are all of the features."""
    arrow = pa.schema([("s1_id", pa.string()), ("candidate_id", pa.string()), *[(n, pa.float64()) for n in names]])
    least, asked = tuple(x.least for x in bags), None if every else names

    def run(refs: pa.RecordBatch, targets: _Targets) -> Iterator[pa.RecordBatch]:
        for rows, at, made in _measured(refs, targets, least, blockers, provenance, asked, digits):
            values = [pa.array(made[n]) for n in names]
            batch = pa.RecordBatch.from_arrays([refs["id"].take(pa.array(rows)), targets.ids.take(pa.array(at)), *values], schema=arrow)
            yield from (batch.slice(k, SLICE_ROWS) for k in range(0, len(rows), SLICE_ROWS))

    more = columns() if every else sketch()
    return _product(ref, tgt, bags, more, run, "s1_id string, candidate_id string, " + ", ".join(f"{n} double" for n in names), ref_rows, target_rows)


#: Cells that a feature's range is cut into for counts, and the bits of a cell.
CELLS, CELL_BITS = 128, 7
#: Counts that a task holds before it adds up those of equal cells.
COUNT_ROWS = 1_000_000


def cells(made: dict[str, np.ndarray], highest: dict[str, float]) -> np.ndarray:
    """One number for each pair, of the cells of its features in their order; highest: each feature's most."""
    code = np.zeros(len(next(iter(made.values()))), dtype=np.int64)
    for k, (name, most) in enumerate(highest.items()):
        cell = np.clip(np.floor(made[name] / most * CELLS), 0, CELLS - 1).astype(np.int64)
        code |= cell << (CELL_BITS * k)
    return code


def _true(refs: pa.RecordBatch, targets: _Targets) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of distinct target ids, the id of each target, and the true pairs as reference * number + id, sorted."""
    ids = targets.ids.unique()
    owner = pc.index_in(targets.ids, value_set=ids).to_numpy(zero_copy_only=False).astype(np.int64)
    theirs, mine = _flat(refs["truth"])
    known = pc.fill_null(pc.index_in(theirs, value_set=ids), -1).to_numpy(zero_copy_only=False)
    return len(ids), owner, np.sort((mine * len(ids) + known)[known >= 0])


def _among(keys: np.ndarray, true: np.ndarray) -> np.ndarray:
    """Which keys are true ones, which are sorted."""
    if not len(true):
        return np.zeros(len(keys), dtype=bool)
    return true[np.minimum(np.searchsorted(true, keys), len(true) - 1)] == keys


def _with_truth(ref: DataFrame, tgt: DataFrame, truth: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, Column]]:
    """Both sides with the true ids of each reference, and the columns that a product moves."""
    a = ref.join(truth.select(F.col("s1_id").alias("entity_id"), "truth"), "entity_id", "left")
    more = sketch() | {"truth": F.coalesce("truth", F.array().cast("array<string>"))}
    return a, tgt.withColumn("truth", F.lit(None).cast("array<string>")), more


def pair_negatives(
    ref: DataFrame, tgt: DataFrame, bags: list[Bag], blockers: tuple[str, ...], truth: DataFrame, seed: int, ref_rows: int = REF_ROWS, target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """(s1_id, candidate_id): of the untrue pairs of a record with n true ones the 2n nearest by name and the 3n or 1 first drawn, from each chunk of targets.

    Whatever ``pairs.hard_negatives`` keeps of all pairs is among them: what it draws are n or 1 of the others than those 2n.
    """
    arrow = pa.schema([("s1_id", pa.string()), ("candidate_id", pa.string())])
    least = tuple(x.least for x in bags)

    def run(refs: pa.RecordBatch, targets: _Targets) -> Iterator[pa.RecordBatch]:
        place = np.empty(targets.size, dtype=np.int64)
        place[pc.sort_indices(targets.ids).to_numpy()] = np.arange(targets.size)
        ids, owner, true = _true(refs, targets)
        many = pc.list_value_length(refs["truth"]).to_numpy(zero_copy_only=False)
        names, others = refs["id"].to_pylist(), [x.encode() for x in targets.ids.to_pylist()]
        targets.records = targets.records or Wide(targets.table)
        records = Wide(refs, targets.records)
        for rows, at in _found(refs, targets, least):
            other = np.flatnonzero(~_among(rows * ids + owner[at], true))
            rows, at = rows[other], at[other]
            near, kept = np.flatnonzero(many[rows] > 0), []
            sims = np.zeros(len(rows))
            sims[near] = measures(records, rows[near], targets.records, at[near], {}, {}, ("name_edit_sim",))["name_edit_sim"]
            starts = np.flatnonzero(np.diff(rows, prepend=-1))
            for start, end in zip(starts, np.append(starts[1:], len(rows)), strict=True):
                r = rows[start]
                n = int(many[r])
                if n:
                    kept.append(start + np.lexsort((place[at[start:end]], -sims[start:end]))[: 2 * n])
                head = hashlib.md5(f"{seed}|{names[r]}|".encode(), usedforsecurity=False)
                drawn = []
                for k in range(start, end):
                    one = head.copy()
                    one.update(others[at[k]])
                    drawn.append((one.digest(), k))
                kept.append(np.array([k for _, k in heapq.nsmallest(max(1, 3 * n), drawn)]))
            if kept:
                left = np.unique(np.concatenate(kept))
                pairs = refs["id"].take(pa.array(rows[left])), targets.ids.take(pa.array(at[left]))
                yield pa.RecordBatch.from_arrays([*pairs], schema=arrow)

    a, b, more = _with_truth(ref, tgt, truth)
    return _product(a, b, bags, more, run, "s1_id string, candidate_id string", ref_rows, target_rows)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with the sum of its counts."""
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(n[order].astype(np.int64), starts)


def pair_cells(
    ref: DataFrame, tgt: DataFrame, bags: list[Bag], blockers: tuple[str, ...], highest: dict[str, float], truth: DataFrame,
    ref_rows: int = REF_ROWS, target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """(code, label, n): all pairs, counted by ``cells`` and by whether truth (s1_id, truth) holds them."""
    arrow = pa.schema([("code", pa.int64()), ("label", pa.int32()), ("n", pa.int64())])
    least, names = tuple(x.least for x in bags), tuple(highest)

    def batch(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys >> 1), pa.array((keys & 1).astype(np.int32)), pa.array(n)], schema=arrow)

    def run(refs: pa.RecordBatch, targets: _Targets) -> Iterator[pa.RecordBatch]:
        ids, owner, true = _true(refs, targets)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for rows, at, made in _measured(refs, targets, least, blockers, {}, names):
            label = _among(rows * ids + owner[at], true)
            held.append(np.unique(cells(made, highest) << 1 | label, return_counts=True))
            if sum(len(keys) for keys, _ in held) >= COUNT_ROWS:
                held = [_summed(held)]
                if len(held[0][0]) >= COUNT_ROWS // 2:
                    yield batch(*held.pop())
        if held:
            yield batch(*_summed(held))

    a, b, more = _with_truth(ref, tgt, truth)
    found = _product(a, b, bags, more, run, "code long, label int, n long", ref_rows, target_rows)
    return found.groupBy("code", "label").agg(F.sum("n").alias("n"))


def pair_values(
    ref: DataFrame, tgt: DataFrame, bags: list[Bag], blockers: tuple[str, ...], highest: dict[str, float], bins: np.ndarray, known: np.ndarray, values: np.ndarray,
    ref_rows: int = REF_ROWS, target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """(s1_id, candidate_id, score): of all pairs the value of their ``cells``' bins (one row for each feature); known is sorted."""
    arrow = pa.schema([("s1_id", pa.string()), ("candidate_id", pa.string()), ("score", pa.float64())])
    least, names = tuple(x.least for x in bags), tuple(highest)
    table = ref.sparkSession.sparkContext.broadcast((bins, known, values))

    def run(refs: pa.RecordBatch, targets: _Targets) -> Iterator[pa.RecordBatch]:
        bins, known, values = table.value
        for rows, at, made in _measured(refs, targets, least, blockers, {}, names):
            code, key = cells(made, highest), np.zeros(len(rows), dtype=np.int64)
            for k, own in enumerate(bins):
                key |= own[(code >> (CELL_BITS * k)) & (CELLS - 1)] << (CELL_BITS * k)
            score = values[np.searchsorted(known, key)]
            yield pa.RecordBatch.from_arrays([refs["id"].take(pa.array(rows)), targets.ids.take(pa.array(at)), pa.array(score)], schema=arrow)

    return _product(ref, tgt, bags, sketch(), run, "s1_id string, candidate_id string, score double", ref_rows, target_rows)


def pair_lists(
    ref: DataFrame, tgt: DataFrame, bags: list[Bag], floor: Floor, sure: float, ids: bool = True, ref_rows: int = REF_ROWS, target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """(s1_id, n, ids, candidate_id, score): of pairs surely over sure the number and (if ids) the candidates of each reference and chunk, other pairs one by one."""
    arrow = pa.schema([("s1_id", pa.string()), ("n", pa.int64()), ("ids", pa.list_(pa.string())), ("candidate_id", pa.string()), ("score", pa.float64())])
    least = tuple(x.least for x in bags)

    def run(refs: pa.RecordBatch, targets: _Targets) -> Iterator[pa.RecordBatch]:
        for rows, at, scores in _scored(refs, targets, least, floor):
            over = scores >= sure + SLACK
            mine, theirs, open_ = rows[over], at[over], np.flatnonzero(~over)
            starts = np.flatnonzero(np.diff(mine, prepend=-1))  # rows come reference by reference
            ends = np.append(starts, len(mine))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), targets.ids.take(pa.array(theirs))) if ids else pa.nulls(len(starts), arrow.field("ids").type)
            many, one = pa.nulls(len(starts), pa.string()), refs["id"].take(pa.array(mine[starts]))
            if len(starts):
                yield pa.RecordBatch.from_arrays([one, pa.array(np.diff(ends), pa.int64()), lists, many, pa.nulls(len(starts), pa.float64())], schema=arrow)
            if len(open_):
                none = pa.nulls(len(open_), arrow.field("ids").type)
                pairs = refs["id"].take(pa.array(rows[open_])), targets.ids.take(pa.array(at[open_]))
                yield pa.RecordBatch.from_arrays([pairs[0], pa.array(np.zeros(len(open_), np.int64)), none, pairs[1], pa.array(scores[open_])], schema=arrow)

    schema = "s1_id string, n long, ids array<string>, candidate_id string, score double"
    return _product(ref, tgt, bags, sketch(), run, schema, ref_rows, target_rows)


def pair_tallies(
    ref: DataFrame, tgt: DataFrame, bags: list[Bag], floor: Floor, steps: tuple[float, ...], digits: int, ref_rows: int = REF_ROWS, target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """(s1_id, step, n): how many pairs of a reference reach each of steps (rising) and not the next one, by rounded scores; several rows for each."""
    arrow = pa.schema([("s1_id", pa.string()), ("step", pa.int32()), ("n", pa.int64())])
    least = tuple(x.least for x in bags)

    def run(refs: pa.RecordBatch, targets: _Targets) -> Iterator[pa.RecordBatch]:
        for rows, _, scores in _scored(refs, targets, least, floor):
            step = np.searchsorted(steps, rounded(scores, digits), side="right") - 1
            keys, n = np.unique((rows * len(steps) + step)[step >= 0], return_counts=True)
            one = refs["id"].take(pa.array(keys // len(steps)))
            yield pa.RecordBatch.from_arrays([one, pa.array((keys % len(steps)).astype(np.int32)), pa.array(n.astype(np.int64))], schema=arrow)

    return _product(ref, tgt, bags, sketch(), run, "s1_id string, step int, n long", ref_rows, target_rows)


def pair_best(ref: DataFrame, tgt: DataFrame, bags: list[Bag], floor: Floor, digits: int, ref_rows: int = REF_ROWS, target_rows: int = TARGET_ROWS) -> DataFrame:
    """(s1_id, candidate_id, score): the best pair of each reference by rounded score, then by id; one row for each chunk of targets."""
    arrow = pa.schema([("s1_id", pa.string()), ("candidate_id", pa.string()), ("score", pa.float64())])
    least = tuple(x.least for x in bags)

    def run(refs: pa.RecordBatch, targets: _Targets) -> Iterator[pa.RecordBatch]:
        place = np.empty(targets.size, dtype=np.int64)
        place[pc.sort_indices(targets.ids).to_numpy()] = np.arange(targets.size)
        for rows, at, scores in _scored(refs, targets, least, floor):
            scores = rounded(scores, digits)
            order = np.lexsort((place[at], -scores, rows))
            first = order[np.flatnonzero(np.diff(rows[order], prepend=-1))]
            ids = refs["id"].take(pa.array(rows[first])), targets.ids.take(pa.array(at[first]))
            yield pa.RecordBatch.from_arrays([*ids, pa.array(scores[first])], schema=arrow)

    return _product(ref, tgt, bags, sketch(), run, "s1_id string, candidate_id string, score double", ref_rows, target_rows)


def id_lists(ref: DataFrame, tgt: DataFrame, bags: list[Bag], ref_rows: int = LIST_ROWS, block_rows: int = TARGET_ROWS) -> DataFrame:
    """(s1_id, ids): the sorted ids that each reference is paired with, joined by commas; empty where there are none.

    A group is a chunk of references with all targets, which stream past it by their ids, so that no pair is moved.  Pairs are
    held as two bytes each within their block of targets, or as one bit for each pair of records where that is less.
    """
    source, kind = F.lit(None).cast(dict(tgt.dtypes)["source"]), pa.schema([("s1_id", pa.string()), ("ids", pa.string())])
    a = _side(ref, {"id": "entity_id"}, [b.ref for b in bags]).withColumn("source", source)
    b = _side(tgt, {"id": "entity_id"}, [b.tgt for b in bags]).withColumn("source", source)
    refs = ref.count()
    across, least = max(1, -(-refs // ref_rows), min(GROUPS, refs // LEAST_ROWS)), tuple(x.least for x in bags)
    a = a.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(across)).cast("int")).withColumn("late", F.lit(False))
    b = b.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))).withColumn("late", F.lit(True))
    rows = a.unionByName(b).repartition(across, "g").sortWithinPartitions("g", "late", "id")
    count = len(bags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, mine = None, None
        for whole in batches:
            groups, late = whole["g"].to_numpy(), whole["late"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((groups[1:] != groups[:-1]) | (late[1:] != late[:-1])) + 1
            for start, end in zip([0, *cuts], [*cuts, len(groups)], strict=True):
                if start == end:
                    continue
                if groups[start] != group:
                    if mine:
                        yield from mine.lists(kind)
                    group, mine = groups[start], _Lists(count, least, block_rows)
                mine.add(whole.slice(start, end - start), bool(late[start]))
        if mine:
            yield from mine.lists(kind)

    return rows.mapInArrow(run, "s1_id string, ids string")


class _Lists:
    """The references of a group, and which targets each of them is paired with, block by block."""

    def __init__(self, bags: int, least: tuple[int, ...], block_rows: int) -> None:
        self.bags, self.least, self.block_rows = bags, least, block_rows
        self.held, self.refs, self.blocks = [], None, []

    def add(self, part: pa.RecordBatch, late: bool) -> None:
        if not late:
            self.held.append(part)
            return
        if self.refs is None and self.held:
            self.refs = _Targets(pa.Table.from_batches(self.held), self.bags)
        for start in range(0, len(part) if self.refs else 0, self.block_rows):
            self._block(part.slice(start, self.block_rows))

    def _block(self, part: pa.RecordBatch) -> None:
        size, n = self.refs.size, len(part)
        found = [(at, rows) for rows, at in _found(part, self.refs, self.least)]
        refs, rows = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.argsort(refs, kind="stable")  # targets stay in the order of their ids
        ends, rows = np.cumsum(np.bincount(refs, minlength=size)), rows[order].astype(np.uint16)
        if 2 * len(rows) > size * n // 8:
            bits = np.zeros((size, -(-n // 8)), dtype=np.uint8)
            for r, (start, end) in enumerate(zip(np.append(0, ends[:-1]), ends, strict=True)):
                flags = np.zeros(n, dtype=bool)
                flags[rows[start:end]] = True
                bits[r] = np.packbits(flags)
            self.blocks.append((part["id"], None, bits))
        elif len(rows):
            self.blocks.append((part["id"], ends, rows))

    def lists(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if self.refs is None:
            ids = pa.concat_arrays([p["id"] for p in self.held]) if self.held else pa.array([], pa.string())
            yield pa.RecordBatch.from_arrays([ids, pa.array([""] * len(ids), pa.string())], schema=schema)
            return
        made, size, start = [], 0, 0
        for r in range(self.refs.size):
            parts = []
            for ids, ends, rows in self.blocks:
                own = np.flatnonzero(np.unpackbits(rows[r], count=len(ids))) if ends is None else rows[ends[r - 1] if r else 0 : ends[r]]
                if len(own):
                    parts.extend(ids.take(pa.array(own)).to_pylist())
            made.append(",".join(parts))
            size += len(parts)
            if size >= OUT_ROWS or r == self.refs.size - 1:
                yield pa.RecordBatch.from_arrays([self.refs.ids.slice(start, len(made)), pa.array(made, pa.string())], schema=schema)
                made, size, start = [], 0, r + 1


def pair_count(ref: DataFrame, tgt: DataFrame, bags: list[Bag], records: bool = False, ref_rows: int = REF_ROWS, target_rows: int = TARGET_ROWS) -> DataFrame:
    """(pairs): one row with the number of those pairs, of ids or of records."""
    arrow, least = pa.schema([("pairs", pa.int64())]), tuple(x.least for x in bags)

    def run(refs: pa.RecordBatch, targets: _Targets) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([sum(len(at) for _, at in _found(refs, targets, least))], pa.int64())], schema=arrow)

    return _product(ref, tgt, bags, {"one": F.lit(1)} if records else {}, run, "pairs long", ref_rows, target_rows).agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"))


def _product(
    ref: DataFrame, tgt: DataFrame, bags: list[Bag], more: dict[str, Column], made: Callable[[pa.RecordBatch, _Targets], Iterator[pa.RecordBatch]],
    schema: str, ref_rows: int, target_rows: int,
) -> DataFrame:
    """made of each batch of references and each chunk of targets; more: columns that records have besides."""
    a = _side(ref, {"id": "entity_id"}, [b.ref for b in bags], more)
    b = _side(tgt, {"id": "entity_id", "source": "source"}, [b.tgt for b in bags], more)
    kind = dict(tgt.dtypes)["source"]
    refs, down = ref.count(), max(1, -(-tgt.count() // target_rows))
    across = max(1, -(-refs // ref_rows), min(-(-GROUPS // down), refs // LEAST_ROWS))
    mine, theirs = F.pmod(F.xxhash64("id"), F.lit(across)), F.pmod(F.xxhash64("id"), F.lit(down))
    a = a.withColumns({"source": F.lit(None).cast(kind), "i": mine, "j": F.explode(F.sequence(F.lit(0), F.lit(down - 1)))})
    b = b.withColumns({"j": theirs, "i": F.explode(F.sequence(F.lit(0), F.lit(across - 1)))})
    rows = b.withColumn("late", F.lit(False)).unionByName(a.withColumn("late", F.lit(True)))
    rows = rows.withColumn("g", F.col("i").cast("int") * down + F.col("j").cast("int")).drop("i", "j")
    # equal names come one after another: pairs of them are compared once
    rows = rows.repartitionById(across * down, "g").sortWithinPartitions("g", "late", *[c for c in ("name", "address") if c in more])
    count = len(bags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, targets = None, [], None
        for whole in batches:
            groups, late = whole["g"].to_numpy(), whole["late"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((groups[1:] != groups[:-1]) | (late[1:] != late[:-1])) + 1
            for start, end in zip([0, *cuts], [*cuts, len(groups)], strict=True):
                if start == end:
                    continue
                if groups[start] != group:
                    group, held, targets = groups[start], [], None
                part = whole.slice(start, end - start)
                if not late[start]:
                    held.append(part)
                elif held or targets:
                    targets = targets or _Targets(pa.Table.from_batches(held), count)
                    held = []
                    yield from made(part, targets)

    return rows.mapInArrow(run, schema)

"""What must be decided in order, group by group: greedy suppression, greedy matching and
optimal assignment. The JVM makes, filters and sorts the pairs; one Arrow pass over the
sorted pairs decides, and holds one group at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that rows of one key (the first columns) are never in two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i) for i in range(keys)]
        last = [c[-1] for c in columns]
        same = batch.num_rows
        while same and all(c[same - 1] == x for c, x in zip(columns, last, strict=True)):
            same -= 1
        if held and not same and all(held[0].column(i)[0] == last[i] for i in range(keys)):
            held.append(batch)
            continue
        if held and same:
            first = 0
            while first < same and all(held[0].column(i)[0] == columns[i][first] for i in range(keys)):
                first += 1
            yield pa.concat_batches([*held, batch.slice(0, first)])
            if same > first:
                yield batch.slice(first, same - first)
        elif held:
            yield pa.concat_batches(held)
        elif same:
            yield batch.slice(0, same)
        held = [batch.slice(same)]
    if held:
        yield pa.concat_batches(held)


def pass_over(rows: DataFrame, keys: list[str], order: list[Column | str], names: list[str], decide: Callable, schema: str) -> DataFrame:
    """Run decide over batches of whole groups of the columns `names`, which begin with the keys;
    rows of a group follow order. The window brings a group together, and shuffles nothing where
    the rows lie by a part of the keys already; its number goes no further than the batches."""
    numbered = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    placed = numbered.sortWithinPartitions(*keys, *order).select(*names, "_nth")
    return placed.mapInArrow(lambda batches: (decide(b) for b in whole_groups((b.select(names) for b in batches), len(keys))), schema)


def in_order(rows: DataFrame, keys: list[str], order: list[Column | str], decide: Callable, schema: str) -> DataFrame:
    """pass_over with all columns of the rows."""
    return pass_over(rows, keys, order, rows.columns, decide, schema)


def _typed(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def suppressed(conflicts: DataFrame, group: list[str], better: str, worse: str, order: list[Column | str]) -> DataFrame:
    """group and worse of the items that greedy suppression drops. conflicts: pairs of a group
    in which `better` goes first in the order of the group; a dropped item drops none."""

    def decide(batch: pa.RecordBatch) -> pa.RecordBatch:
        named = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        gone: dict[tuple, None] = {}
        for row in named:
            key = row[: len(group)]
            if (*key, row[-2]) not in gone:
                gone[*key, row[-1]] = None
        out = list(zip(*gone, strict=True)) or [[] for _ in range(len(group) + 1)]
        kinds = [batch.schema.field(i).type for i in range(len(group))] + [batch.schema.field(batch.num_columns - 1).type]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=[*group, worse])

    # a pass needs the order alone, so that its columns do not go to Python
    return pass_over(conflicts, group, order, [*group, better, worse], decide, _typed(conflicts, [*group, worse]))


def first_free(pairs: DataFrame, group: list[str], taker: str, taken: str, reusable: str, order: list[Column | str], carry: list[str] | None = None) -> DataFrame:
    """Greedy matching: in the order given, each taker takes the first item of its pairs that
    is free; an item whose `reusable` is true stays free. Pairs of one taker stand together.
    The columns `carry` of the pairs come along."""
    more = list(carry or [])

    def decide(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, busy, served = [], set(), set()
        for i, row in enumerate(zip(*(c.to_pylist() for c in batch.columns[: len(group) + 3]), strict=True)):
            key, a, b, again = row[:-3], row[-3], row[-2], row[-1]
            if (key, a) in served or (key, b) in busy:
                continue
            served.add((key, a))
            if not again:
                busy.add((key, b))
            keep.append(i)
        return batch.select([*group, taker, taken, *more]).take(pa.array(keep, pa.int64()))

    return pass_over(pairs, group, order, [*group, taker, taken, reusable, *more], decide, _typed(pairs, [*group, taker, taken, *more]))


def free_by_level(pairs: DataFrame, group: list[str], taker: str, taken: str, order: list[Column | str]) -> DataFrame:
    """first_free at many levels at once, which are the bits of whole numbers. pairs: group, taker,
    taken and, as bits, the levels at which the pair is `met` and the taken is `ignored`, and
    whether it stays `free`. At each level what is not ignored goes first, then the order. Returns
    group, taker and the levels at which it `took` an item and `took_ignored` one."""

    def decide(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [c.to_pylist() for c in batch.columns]
        owner = list(zip(*columns[: len(group) + 1], strict=True))
        items, met, ignored, free = columns[len(group) + 1 :]
        busy: dict[tuple, int] = {}
        keep, took, took_ignored = [], [], []
        first, last = 0, 0
        while first < len(owner):
            while last < len(owner) and owner[last] == owner[first]:
                last += 1
            key, done = owner[first][:-1], [0, 0]
            for turn in (0, 1):
                for i in range(first, last):
                    here = met[i] & (ignored[i] if turn else ~ignored[i]) & ~(done[0] | done[1])
                    if here and not free[i]:
                        here &= ~busy.get((key, items[i]), 0)
                    if here:
                        done[turn] |= here
                        if not free[i]:
                            busy[key, items[i]] = busy.get((key, items[i]), 0) | here
            keep.append(first)
            took.append(done[0])
            took_ignored.append(done[1])
            first = last
        out = batch.select([*group, taker]).take(pa.array(keep, pa.int64()))
        return pa.RecordBatch.from_arrays([*out.columns, pa.array(took, pa.int64()), pa.array(took_ignored, pa.int64())], names=[*group, taker, "took", "took_ignored"])

    return pass_over(pairs, group, order, [*group, taker, taken, "met", "ignored", "free"], decide, _typed(pairs, [*group, taker]) + ", took long, took_ignored long")


def assign(score: np.ndarray) -> list[tuple[int, int]]:
    """Row and column of each pair of the 1:1 assignment of greatest total score, by
    shortest augmenting paths (Jonker and Volgenant, 1987)."""
    if score.shape[0] > score.shape[1]:
        return [(i, j) for j, i in assign(score.T)]
    n, m = score.shape
    cost = -score
    row_price, col_price = np.zeros(n), np.zeros(m)
    row_of = np.full(m, -1)
    for start in range(n):
        reach, came, done = np.full(m, np.inf), np.full(m, -1), np.zeros(m, bool)
        tree, col, row, low = [], -1, start, 0.0
        while True:
            path = low + cost[row] - row_price[row] - col_price
            better = ~done & (path < reach)
            reach[better], came[better] = path[better], col
            col = int(np.argmin(np.where(done, np.inf, reach)))
            low, done[col] = reach[col], True
            if row_of[col] < 0:
                break
            tree.append(col)
            row = row_of[col]
        row_price[start] += low
        for j in tree:
            row_price[row_of[j]] += low - reach[j]
            col_price[j] -= low - reach[j]
        while col >= 0:
            before = came[col]
            row_of[col] = row_of[before] if before >= 0 else start
            col = before
    return sorted((int(i), j) for j, i in enumerate(row_of) if i >= 0)


def parts(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least node of the connected part of each of n nodes, by hooking and jumping. a, b: edges."""
    part = np.arange(n)
    while True:
        x, y = part[a], part[b]
        open_ = x != y
        if not open_.any():
            return part
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        # the greater of two parts' least nodes is hooked to the smaller, and chains are cut short
        np.minimum.at(part, np.maximum(x, y), np.minimum(x, y))
        while True:
            after = part[part]
            if (after == part).all():
                break
            part = after


#: Columns of an assignment from which on numpy calls cost less than plain loops.
FEW = 32


def assign_few(score: list[list[float]]) -> list[tuple[int, int]]:
    """assign, step by step the same, without arrays."""
    n, m = len(score), len(score[0])
    if n > m:
        return [(i, j) for j, i in assign_few([list(c) for c in zip(*score, strict=True)])]
    row_price, col_price, row_of = [0.0] * n, [0.0] * m, [-1] * m
    for start in range(n):
        reach, came, open_ = [float("inf")] * m, [-1] * m, list(range(m))
        tree, col, row, low = [], -1, start, 0.0
        while True:
            gains, price = score[row], row_price[row]
            for j in open_:
                path = low - gains[j] - price - col_price[j]
                if path < reach[j]:
                    reach[j], came[j] = path, col
            col = min(open_, key=reach.__getitem__)
            low = reach[col]
            open_.remove(col)
            if row_of[col] < 0:
                break
            tree.append(col)
            row = row_of[col]
        row_price[start] += low
        for j in tree:
            row_price[row_of[j]] += low - reach[j]
            col_price[j] -= low - reach[j]
        while col >= 0:
            before = came[col]
            row_of[col] = row_of[before] if before >= 0 else start
            col = before
    return sorted((i, j) for j, i in enumerate(row_of) if i >= 0)


def places(group: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Numbers from 0, in order, of the distinct items of each group."""
    order = np.lexsort((item, group))
    new = np.r_[False, (group[order][1:] != group[order][:-1]) | (item[order][1:] != item[order][:-1])]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def best_pairs(group: np.ndarray, left: np.ndarray, right: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Positions of the chosen pairs of all groups. Pairs fall into connected parts, which are
    assigned apart; a part with one item on a side takes its best pair (the first of equals)."""
    a, b = places(group, left), places(group, right)
    n = a.max() + 1
    of = parts(a, b + n, n + b.max() + 1)[a]
    order = np.lexsort((np.where(np.isnan(score), -np.inf, -score), of))
    cuts = np.flatnonzero(np.r_[True, np.diff(of[order]) > 0])
    ends = np.r_[cuts[1:], len(order)]
    one = (np.minimum.reduceat(a[order], cuts) == np.maximum.reduceat(a[order], cuts)) | (np.minimum.reduceat(b[order], cuts) == np.maximum.reduceat(b[order], cuts))
    chosen = [order[cuts[one]]]
    for i, j in zip(cuts[~one].tolist(), ends[~one].tolist(), strict=True):
        rows = np.sort(order[i:j])
        pa_, pb, gain = a[rows].tolist(), b[rows].tolist(), score[rows].tolist()
        ra, rb = ({x: k for k, x in enumerate(sorted(set(side)))} for side in (pa_, pb))
        at = {(ra[x], rb[y]): k for k, (x, y) in enumerate(zip(pa_, pb, strict=True))}
        table = [[0.0] * len(rb) for _ in ra]
        for (x, y), k in at.items():
            table[x][y] = gain[k]
        found = assign_few(table) if max(len(ra), len(rb)) <= FEW else assign(np.array(table))
        chosen.append(rows[[at[p] for p in found if p in at]])
    return np.sort(np.concatenate(chosen)).astype(np.int64)


def optimal_pairs(pairs: DataFrame, group: list[str], left: str, right: str, score: str, carry: list[str] | None = None) -> DataFrame:
    """The pairs of the 1:1 assignment of greatest total score within each group; pairs
    without a positive score add nothing and are left out. Of equal best assignments the
    one that the search meets first in the order of ids is taken, on every run. The
    columns `carry` of the pairs come along."""
    names = [*group, left, right, score, *(carry or [])]
    rows = pairs.select(*names).filter(F.col(score) > 0)

    def decide(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.take(pa.array(_chosen(batch, len(group))))

    return in_order(rows, group, [left, right], decide, _typed(pairs, names))


def _chosen(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """Positions that best_pairs chooses of the columns: keys of the groups, left, right, score."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for i in range(keys):
        c = batch.column(i).to_numpy(zero_copy_only=False)
        new[1:] |= c[1:] != c[:-1]
    a, b, s = (batch.column(keys + i).to_numpy(zero_copy_only=False) for i in range(3))
    return best_pairs(np.cumsum(new) - 1, a, b, s.astype(float))


def unchosen_pairs(pairs: DataFrame, group: list[str], left: str, right: str, score: str) -> DataFrame:
    """The pairs (group, left, right) that optimal_pairs leaves out: where most pairs are chosen,
    these are the few, and the others stay where they lie."""
    names = [*group, left, right]

    def decide(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = np.ones(batch.num_rows, bool)
        able = np.flatnonzero(batch.column(len(names)).to_numpy(zero_copy_only=False).astype(float) > 0)
        if len(able):
            out[able[_chosen(batch.take(pa.array(able)), len(group))]] = False
        return batch.select(names).filter(pa.array(out))

    return pass_over(pairs, group, [left, right], [*names, score], decide, _typed(pairs, names))

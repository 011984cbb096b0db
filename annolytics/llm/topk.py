"""Exact top-k by inner product, with Fagin's threshold algorithm (Fagin, Lotem and Naor, 2001).

Queries and candidates meet in a grid of cells of bounded size, each a task's group. A
cell's candidates stand in blocks, longest vectors first; each block has a sorted list
for each dimension, read from the top where a query's component is positive and from the
bottom where it is negative. Depth by depth a query reads its lists, scores the rows it
has not met before, and updates its k-th score. No row below depth d of all lists can
score above the inner product of the query with the values at depth d: once that bound is
below the k-th score the query leaves the block. A bound that equals the k-th score does
not stop it, since ties go to the smaller id. Depths double, and the random accesses of
one depth are made together for the queries that still read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import settle
from .vectors import matrix, packed, sorted_groups

K, QUERY_EVERY, SCALE = 5, 50, 256
QUERY_ROWS, CELL_ROWS, BLOCK_ROWS = 4096, 16384, 2048
#: Queries that read a block together.
TOGETHER = 128


def _best(rows: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query (rows: its number), ties to the smaller id, and who has k."""
    order = np.lexsort((ids, -score, rows))
    rows, ids, score = rows[order], ids[order], score[order]
    heads = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, np.int64)
    place = np.arange(len(rows)) - np.repeat(heads, np.diff(np.append(heads, len(rows))))
    return rows[place < k], ids[place < k], score[place < k]


def threshold_search(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, block_rows: int = BLOCK_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query number, row id and score of the k best rows of each query, without its own id, and
    for each query the number of rows that it scored."""
    exact = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1]) < 2**53
    kind = np.float64 if exact else np.int64
    order = np.argsort(-(rows * rows).sum(1), kind="stable")
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    kth, scored = np.full(len(queries), -np.inf), np.zeros(len(queries), np.int64)
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)) for _ in range(0, len(queries), TOGETHER)]
    for at in range(0, len(rows), block_rows):
        block, block_ids = rows[order[at : at + block_rows]], ids[order[at : at + block_rows]]
        n = len(block)
        lists = np.argsort(block, axis=0, kind="stable")
        values = np.take_along_axis(block, lists, 0)
        for g in range(len(best)):
            who = np.arange(g * TOGETHER, min((g + 1) * TOGETHER, len(queries)))
            met = np.zeros((len(who), n), bool)
            depth = 0
            while True:
                if depth < n:
                    bound = up[who] @ values[n - 1 - depth] + down[who] @ values[depth]
                    if not exact:
                        bound = bound + 1e-12 * np.abs(bound) + 1e-9
                    going = bound >= kth[who]
                    who, met = who[going], met[going]
                if depth >= n or not len(who):
                    break
                below = min(n, max(1, 2 * depth))
                high, low = lists[n - below : n - depth], lists[depth:below]
                seen = met.copy()
                for j in range(block.shape[1]):
                    seen[np.ix_(queries[who, j] > 0, high[:, j])] = True
                    seen[np.ix_(queries[who, j] < 0, low[:, j])] = True
                if below == n:  # a query of zeros has no list to read; all rows score 0
                    seen[:] = True
                new = seen & ~met & (query_ids[who][:, None] != block_ids[None, :])
                some = np.flatnonzero(new.any(0))
                score = queries[who].astype(kind) @ block[some].T.astype(kind)
                good = new[:, some] & (score >= kth[who][:, None])
                scored[who] += new.sum(1)
                q, r = np.nonzero(good)
                held = best[g]
                best[g] = _best(np.concatenate([held[0], who[q]]), np.concatenate([held[1], block_ids[some[r]]]), np.concatenate([held[2], score[q, r]]), k)
                of, count = np.unique(best[g][0], return_counts=True)
                ends = np.cumsum(count)
                kth[of[count == k]] = best[g][2][ends[count == k] - 1]
                met, depth = seen, below
    found = [np.concatenate(x) for x in zip(*best, strict=True)] if best else [np.zeros(0, np.int64)] * 3
    return found[0], found[1], found[2].astype(np.int64), scored


def search_cells(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """dim, query chunk, candidate chunk, is_query, vec_id, key, vec -> query_id, query_key, vec_id, score."""
    for _, (is_query, ids, keys, vecs) in sorted_groups(batches, 3):
        is_query, ids, keys = np.array(is_query, bool), np.array(ids, np.int64), np.array(keys, np.int64)
        if is_query.all() or not is_query.any():
            continue
        values = np.floor(SCALE * matrix(vecs))
        q, row, score, _ = threshold_search(values[is_query], ids[is_query], values[~is_query], ids[~is_query], k)
        of, key = ids[is_query][q], keys[is_query][q]
        yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(key), pa.array(row), pa.array(score)], names=["query_id", "query_key", "vec_id", "score"])


def top_k(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, query_rows: int = QUERY_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The k rows of highest inner product of floor(256 * x) for each query row.

    vectors: vec_id long, embedding array; other columns are left out. Queries are the
    ids divisible by `query_every`, each against all rows of other ids and of its own
    number of components. Returns query_id, rank, vec_id, score; ties go to the smaller
    vec_id. Rows with a null id, and vectors null or with null or non-finite components,
    take no part; a repeated row counts once for each repeat as a candidate and once as a
    query; an id that stands on different vectors gives a query, with ranks of its own, for
    each; an empty table gives an empty result. Scores must fit 64 bits.
    """
    rows = settle(packed(vectors).filter("vec_id is not null"))
    queries = rows.filter(F.pmod("vec_id", F.lit(query_every)) == 0).distinct()
    n_rows, n_queries = rows.count(), queries.count()
    wide, high = max(1, -(-n_rows // cell_rows)), max(1, -(-n_queries // query_rows))
    own = F.row_number().over(Window.partitionBy("vec_id", "dim", "vec").orderBy("vec_id"))
    spread = F.pmod(F.xxhash64("vec_id", "no"), F.lit(wide)).cast("int")
    key = F.xxhash64("vec").alias("key")
    candidates = rows.withColumn("no", own).select("dim", F.explode(F.sequence(F.lit(0), F.lit(high - 1))).alias("qc"), spread.alias("cc"), F.lit(False).alias("is_query"), "vec_id", key, "vec")
    asked = queries.select("dim", F.pmod(F.xxhash64("vec_id"), F.lit(high)).cast("int").alias("qc"), F.explode(F.sequence(F.lit(0), F.lit(wide - 1))).alias("cc"), F.lit(True).alias("is_query"), "vec_id", key, "vec")
    cells = candidates.unionByName(asked).repartition("dim", "qc", "cc").sortWithinPartitions("dim", "qc", "cc", "vec_id")
    found = cells.mapInArrow(lambda it: search_cells(it, k), "query_id long, query_key long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

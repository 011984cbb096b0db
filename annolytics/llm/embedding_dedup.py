"""Near copies among embeddings, by iterative quantisation (Gong and Lazebnik, 2011) and
multi-index Hamming tables (Norouzi, Punjani and Fleet, 2012).

Centred vectors are turned by learned rotations whose signs are balanced binary codes;
substrings of these are the keys of as many tables. The angle that is left of a link after
centring sets their numbers: pairs at the least cosine are planted in the sample, and of
all widths of a substring with the tables that show LEAST_RECALL of these pairs the
cheapest is taken, at width 0 all vectors of a label. Vectors of one label that
share a substring meet in its bucket, where the original vectors decide. Equal vectors
are one class throughout. A bucket above CELL classes is a grid of cells; a cell counts
the links whose first common table is its own, and gives one edge for each vector to the
least vector of its local component, so that what it gives grows with the bucket and not
with its pairs. The rotations come from SAMPLE vectors at most, the least by hash; all
vectors are indexed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import connected_components, settle
from .vectors import matrix, packed, sorted_groups

LEAST_COSINE = 0.93
SAMPLE, ROUNDS = 20_000, 30
CELL = 1024
#: Share of planted pairs at the least cosine that the tables must show, and how many are planted.
LEAST_RECALL, PLANTED = 0.96, 2000
#: Bits of a vector and of a substring, at most.
MOST_BITS, MOST_WIDTH = 384, 16
#: Comparisons that cost as much as to ship a vector to a table.
SHIPPED = 256


def learn_rotation(unit: np.ndarray, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """A rotation under which the signs of centred rows lose least of them."""
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(unit.shape[1],) * 2))[0]
    for _ in range(rounds if len(unit) > 1 else 0):
        u, _, v = np.linalg.svd(np.where(unit @ turn >= 0, 1.0, -1.0).T @ unit)
        turn = (u @ v).T
    return turn


def planted(unit: np.ndarray, cosine: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs at this cosine, that part in any direction and in those of the sample."""
    rng = np.random.default_rng(7)
    one = unit[rng.integers(0, len(unit), PLANTED)]
    out = []
    for away in (rng.normal(size=one.shape), unit[rng.integers(0, len(unit), PLANTED)] - unit[rng.integers(0, len(unit), PLANTED)]):
        away = away - (away * one).sum(1, keepdims=True) * one
        size = np.sqrt((away * away).sum(1, keepdims=True))
        some = size[:, 0] > 1e-9
        out.append((one[some], cosine * one[some] + np.sqrt(1 - cosine**2) * (away / np.maximum(size, 1e-9))[some]))
    return [x for x in out if len(x[0])]


class Coder:
    """Codes of unit vectors of `dim` components: `tables` integers of `width` bits each.
    `rows` is the number of vectors of a label that a vector would meet without tables;
    without a sample all meet."""

    def __init__(self, dim: int, sample: np.ndarray, least: float, rows: float):
        self.mean, self.turn, self.tables, self.width = np.zeros(dim), np.zeros((dim, 0)), 1, 0
        if len(sample) < 2 or dim < 2 or rows <= SHIPPED:
            return
        self.mean = sample.mean(0)
        turn = np.concatenate([learn_rotation(sample - self.mean, seed) for seed in range(-(-MOST_BITS // dim))], axis=1)[:, :MOST_BITS]
        same = [((a - self.mean) @ turn >= 0) == ((b - self.mean) @ turn >= 0) for a, b in planted(sample, min(least, 1.0))]
        signs = (sample[:PLANTED] - self.mean) @ turn >= 0
        cheapest = rows + SHIPPED
        for width in range(1, MOST_WIDTH + 1):
            most = turn.shape[1] // width
            shown = [x[:, : most * width].reshape(len(x), most, width).all(2) for x in same]
            recall = np.min([np.logical_or.accumulate(x, 1).mean(0) for x in shown], 0)
            if recall[-1] < LEAST_RECALL:
                continue
            tables = int(np.argmax(recall >= LEAST_RECALL)) + 1
            codes, met = signs[:, : tables * width].reshape(len(signs), tables, width) @ (1 << np.arange(width)), 0.0
            for code in codes.T:
                sizes = np.unique(code, return_counts=True)[1].astype(float)
                met += (sizes * (sizes - 1)).sum() / (len(signs) * (len(signs) - 1))
            cost = met * rows + tables * SHIPPED
            if cost < cheapest:
                cheapest, self.tables, self.width, self.turn = cost, tables, width, turn[:, : tables * width]

    def codes(self, unit: np.ndarray) -> np.ndarray:
        bits = (unit - self.mean) @ self.turn >= 0
        return (bits.reshape(len(unit), self.tables, self.width) @ (1 << np.arange(self.width))).astype(np.uint16)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(1, keepdims=True)  # no square overflows
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def give_codes(batches: Iterator[pa.RecordBatch], coders: dict[int, Coder]) -> Iterator[pa.RecordBatch]:
    """class_id, dim, vec -> class_id, codes."""
    for batch in batches:
        dims, out = np.array(batch.column(1).to_pylist()), [b""] * len(batch)
        vecs = batch.column(2).to_pylist()
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            coder = coders.get(dim) or coders.setdefault(dim, Coder(dim, np.zeros((0, dim)), 1.0, 0.0))
            for i, row in zip(at.tolist(), coder.codes(unit_rows(matrix([vecs[i] for i in at.tolist()]))), strict=True):
                out[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([list(np.frombuffer(x, np.uint16).tolist()) for x in out], pa.list_(pa.int32()))], names=["class_id", "codes"])


def link_cells(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """bucket, cell a, cell b, then table, side, class_id, copies, codes, vec -> class_id, links, root."""
    for (_, a, b), (table, side, ids, copies, codes, vecs) in sorted_groups(batches, 3):
        t, ids, copies, side = table[0], np.array(ids), np.array(copies), np.array(side)
        unit, codes = unit_rows(matrix(vecs)), np.array(codes)
        left, right = (np.arange(len(ids)),) * 2 if a == b else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        linked = unit[left] @ unit[right].T >= least
        if a == b:
            np.fill_diagonal(linked, False)
        if not linked.any():
            continue
        for i in range(0, len(left), 256):
            x, y = np.nonzero(linked[i : i + 256])
            p, q = left[x + i], right[y]
            first = ~(codes[p, :t] == codes[q, :t]).any(1) if t else np.ones(len(p), bool)
            np.add.at(links, p[first], copies[q[first]])
            if a != b:
                np.add.at(links, q[first], copies[p[first]])
        while True:  # the least place of each local component
            low = np.where(linked, root[right][None, :], len(ids)).min(1)
            new = root.copy()
            new[left] = np.minimum(new[left], low)
            new[right] = np.minimum(new[right], np.where(linked, new[left][:, None], len(ids)).min(0))
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(ids[root[some]])], names=["class_id", "links", "root"])


def embedding_components(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """Links of cosine `least` or more between vectors of one label, and their components.

    vectors: vec_id long, embedding array, label; other columns are left out. One row per
    input row: vec_id, n_links, component_id (the smallest vec_id reachable by links),
    kept (vec_id = component_id). Vectors null, zero or with null or non-finite
    components, and rows without a label, link with nothing; so do vectors of different
    numbers of components. Repeated rows are vectors that link. A null vec_id takes part
    and is never the smallest. An empty table gives an empty result.
    """
    every = vectors.select(F.col("vec_id").cast("long"), "label", "embedding")
    live = packed(every.filter(F.col("label").isNotNull() & F.exists("embedding", lambda x: x != 0)), "label")
    live = live.withColumn("class_id", F.xxhash64("label", "vec"))
    live = settle(live)
    classes = settle(live.groupBy("class_id", "label", "dim", "vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("rep")))
    sample = classes.orderBy(F.xxhash64("class_id")).limit(SAMPLE).select("dim", "vec", F.xxhash64("label").alias("label")).toPandas()
    times = classes.count() / max(1, len(sample))
    coders = {}
    for d, g in sample.groupby("dim"):
        of_label = g["label"].value_counts().to_numpy(float)
        coders[int(d)] = Coder(int(d), unit_rows(matrix(list(g["vec"]))), least, times * (of_label**2).sum() / of_label.sum())
    codes = classes.select("class_id", "dim", "vec").mapInArrow(lambda it: give_codes(it, coders), "class_id long, codes array<int>")
    coded = settle(codes.join(classes.drop("rep"), "class_id"))

    keys = coded.select("class_id", "label", "dim", F.posexplode("codes").alias("table", "code")).withColumn("bucket", F.xxhash64("label", "dim", "table", "code"))
    sizes = keys.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    keys = keys.join(sizes, "bucket").withColumn("wide", F.ceil(F.col("size") / CELL))
    keys = keys.withColumn("chunk", F.pmod(F.xxhash64("class_id"), F.col("wide")))
    keys = keys.select("bucket", "table", "class_id", "chunk", F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("other"))
    a, b = F.least("chunk", "other"), F.greatest("chunk", "other")
    cells = keys.select("class_id", "bucket", a.alias("a"), b.alias("b"), "table", F.when(F.col("chunk") == a, 0).otherwise(1).alias("side"))
    cells = cells.join(coded, "class_id").select("bucket", "a", "b", "table", "side", "class_id", "copies", "codes", "vec")
    cells = cells.repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b")
    met = settle(cells.mapInArrow(lambda it: link_cells(it, least), "class_id long, links long, root long"))
    links = met.groupBy("class_id").agg(F.sum("links").alias("links"))
    parts = connected_components(met.filter("class_id <> root"), "class_id", "root").withColumnRenamed("node", "class_id")

    named = classes.select("class_id", "copies", "rep").join(links, "class_id", "left").join(parts, "class_id", "left")
    named = named.withColumn("component", F.coalesce("component", "class_id"))
    lowest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(lowest, "component").select("class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    found = live.select("vec_id", "class_id").join(named, "class_id").select("vec_id", "n_links", "component_id")
    usable = F.col("label").isNotNull() & F.exists("embedding", lambda x: x != 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    lone = every.filter(~F.coalesce(usable, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(lone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

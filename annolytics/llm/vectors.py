"""Vectors as packed binary rows, for operators that multiply blocks of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def packed(vectors: DataFrame, *others: str) -> DataFrame:
    """vec_id, others, dim, vec (doubles, little-endian) of the vectors that are not null
    and hold neither null nor non-finite components."""
    array = F.col("embedding").cast("array<double>")
    fit = F.forall(array, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), *others, array.alias("embedding")).filter(fit)
    schema = "".join(f"{rows.schema[c].name} {rows.schema[c].dataType.simpleString()}, " for c in ("vec_id", *others))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(others) + 1)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8"), np.cumsum([0, *pa.compute.list_value_length(lists).to_pylist()])
            vec = [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = [*batch.columns[: len(others) + 1], pa.array(np.diff(ends).astype(np.int32)), pa.array(vec, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", *others, "dim", "vec"])

    return rows.mapInArrow(pack, f"{schema}dim int, vec binary")


def matrix(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """Groups of rows sorted by their first `keys` columns: the key, and the other columns."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key:
                if held:
                    yield key, [list(c) for c in zip(*held, strict=True)]
                key, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield key, [list(c) for c in zip(*held, strict=True)]

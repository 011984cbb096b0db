"""Shards by jump consistent hashing (Lamping and Veach, 2014): no ring table, and one
more shard takes rows only into itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

SHARDS = 40
#: Parts of a shard that are numbered apart, so that no shard is one task's.
PARTS = 512
#: Bytes of a row besides its text.
ROW_BYTES = 16


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key."""
    key, bucket, jump = keys.astype(np.uint64), np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    while len(live):
        bucket[live] = jump[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        jump[live] = ((bucket[live] + 1) * (float(1 << 31) / ((key[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
        live = live[jump[live] < shards]
    return bucket


def shard_of(key: Column, shards: int) -> Column:
    """Jump hash of a long column; the key is mixed first, null is a key like others."""

    @F.pandas_udf("int")
    def jump(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return jump(F.xxhash64(key))


def shard_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and place of every row.

    docs: doc_id long, text string; other columns are left out. One row per input row:
    doc_id, size (UTF-8 bytes and ROW_BYTES), text_crc32, law, shard, slot (gapless
    within the shard), grown_shard (with one shard more). doc_id and the number of shards
    alone decide, so repeated ids share a shard and a null id is an id. A null text is
    empty; an empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumns({"shard": shard_of(F.col("doc_id"), shards), "grown_shard": shard_of(F.col("doc_id"), shards + 1)})
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(PARTS)))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("shard", "part").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    rows = rows.withColumn("slot", F.row_number().over(inside)).join(parts, ["shard", "part"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("base") + F.col("slot") - 1).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write all columns of docs under path, one folder `shard=k` for each shard; hot
    shards are spread over several files. A column `shard` of docs is written as
    `given_shard`; null ids and texts are values, and an empty table writes no row."""
    placed = docs.withColumnRenamed("shard", "given_shard").withColumn("shard", shard_of(F.col("doc_id").cast("long"), shards))
    placed.repartition("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(16))).write.partitionBy("shard").parquet(path)

"""What several corpus operators need: tables in the folder all executors share,
small Arrow batches, and connected components by joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: Rows of an Arrow batch that goes to Python: long texts make large batches otherwise.
ARROW_ROWS = "400"


#: Parts of a shuffle partition that a key's rows may fill before they are spread, and rows
#: below which a key is never spread.
SLICES, HOT_ROWS = 8, 1000


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, as in tests, one of our own (on a
    cluster an error)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, and
    survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.settled_at = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a settled table that no later table is made from."""
    jvm = table.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(table.settled_at)
    path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def shielded(*own: str) -> Callable:
    """For operators that return rows of their first table: its columns that are not among `own`,
    which the operator reads, pass through under names that nothing within it has."""

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(operator)
        def outer(docs: DataFrame, *more, **how) -> DataFrame:
            names = {c: f"passed_through_{i}" for i, c in enumerate(docs.columns) if c not in own}
            return operator(docs.withColumnsRenamed(names), *more, **how).withColumnsRenamed({v: k for k, v in names.items()})

        return outer

    return wrap


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def join_skewed(rows: DataFrame, keys_table: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """rows joined with keys_table, which has one row for each key and, in its column `rows`,
    at least about how many rows the key has. Keys that would fill more than a small part of
    a task are spread over tasks by the columns `spread`. They are few: as their rows add
    up to no more than all, no more than SLICES * partitions of them can be so large."""
    spark = rows.sparkSession
    slices = SLICES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys_table = settle(keys_table)
    total = keys_table.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = keys_table.filter(F.col("rows") > max(HOT_ROWS, total // slices)).select(*keys, F.ceil(F.col("rows") * slices / max(1, total)).cast("int").alias("salts"))
    known = F.broadcast(hot)  # at most `slices` rows
    salt = F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread), "salts")).cast("int")
    left = rows.join(known, keys, "left").withColumn("salt", salt).drop("salts")
    salts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts") - 1, F.lit(0))))
    right = keys_table.join(known, keys, "left").withColumn("salt", salts).drop("salts")
    return left.join(right, [*keys, "salt"]).drop("salt")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Node and component (its smallest node) of every node that an edge touches, but for the
    smallest nodes themselves.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) on an
    edge table until nothing changes; each round is a table in the shared folder.
    Edges need not be distinct; loops are left out.
    """
    now = settle(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    sums = (F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64(F.lit(1), "v", "u")))
    seen = now.agg(*sums).first()
    order = Window.partitionBy("u").orderBy("v")
    least, last = F.first("v").over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lag("v").over(order)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.withColumn("m", F.least("u", least)).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.withColumns({"m": least, "last": last}).filter("last is null or v <> last")
        # the row of the least neighbour stands for the node itself
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after, before = settle(small.filter("u <> v").distinct()), seen
        discard(now)
        now, seen = after, after.agg(*sums).first()
        # a star forest: no node is both a centre and a leaf, and each leaf has one centre
        if seen == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))

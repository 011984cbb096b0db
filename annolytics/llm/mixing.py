"""Mix sources to target weights, with DataFrame operations alone.

Each source's words, laid end to end in a fixed order of its documents, are cut into
blocks of BLOCK words. Output shards of SHARD_SLOTS slots draw the sources of their
slots (a multinomial draw each); a source's slots are numbered through all shards and
mapped to its blocks by a pseudorandom permutation of the block numbers for each pass
through the source (swap-or-not shuffle of Hoang, Morris and Rogaway, 2012, which needs
no table and any number of blocks). Slots and documents meet by source and block number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import settle, shielded

BLOCK = 128
SHARD_SLOTS = 65_536
#: Weights of the sources in code-point order, repeating; words taken of all words; most passes.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
ROUNDS = 24
#: Slots that one task lays out, about.
TASK_SLOTS = 32_768
#: Parts of a source whose sizes are summed apart, so that no source is one task's.
PARTS = 1024
#: Sources up to which their table is broadcast.
FEW_SOURCES = 10_000
SEED = 17


def word_count(text: Column) -> Column:
    marks = F.translate(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def permuted(index: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """The place of `index` in a pseudorandom permutation of 0 to n - 1 chosen by `key`."""
    def swap_or_not(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        return F.when(F.pmod(F.xxhash64(*key, r, F.greatest(x, partner)), F.lit(2)) == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), index.cast("long"), swap_or_not)


def with_sums_before(rows: DataFrame, order: list[str], **sums: str) -> DataFrame:
    """rows with, for each name of sums, the sum of its column over the rows before in order.
    Rows are cut into ranges, which are summed apart, so that no task has all of them."""
    placed = rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
    placed = settle(placed.withColumn("range", F.spark_partition_id()))
    above, inside = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("range").agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    bases = ranges.select("range", *(F.coalesce(F.sum(n).over(above), F.lit(0)).alias(f"{n}_base") for n in sums))
    # a row for each shuffle partition
    out = placed.join(F.broadcast(bases), "range")
    return out.withColumns({n: F.col(f"{n}_base") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()}).select(*rows.columns, *sums)


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source_key, source_size -> also target: share of all words by weight, none above
    `most` times the source; what that cuts off goes to the others by weight."""
    ranked = with_sums_before(sizes.withColumn("one", F.lit(1).cast("long")), ["source_key"], rank="one").drop("one")
    ranked = ranked.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = with_sums_before(ranked.withColumn("full_at", most * F.col("source_size") / F.col("weight")), ["full_at", "source_key"], size_before="source_size", weight_before="weight")
    ranked = ranked.join(F.broadcast(ranked.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))))  # one row
    level = (share * F.col("all_size") - most * F.col("size_before")) / (F.col("all_weight") - F.col("weight_before"))
    ranked = ranked.withColumn("level", level)
    water = ranked.agg(F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "source_key", "level")))["level"].alias("water"))
    target = F.least(most * F.col("source_size"), F.col("weight") * F.coalesce("water", F.lit(float("inf"))))
    return ranked.join(F.broadcast(water)).withColumn("target", target).select("source_key", "source_size", "target")


def mix_plan(docs: DataFrame, block: int = BLOCK, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs: doc_id, doc_key, copy, source, text -> three tables.

    sized: doc_id, doc_key, copy, source_id, size, offset (of its first word in its source);
    sources: source_id, source_size, target and the source's slots;
    slots: shard, slot, source_id, block, words (of the block that are taken), pass.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("~"))  # null last
    sized = settle(docs.select("doc_id", "doc_key", "copy", F.xxhash64(key).alias("source_id"), key.alias("source_key"), word_count(F.col("text")).alias("size")))
    sources = source_targets(sized.groupBy("source_key").agg(F.sum("size").alias("source_size")), weights, share, most)
    whole, blocks = F.col("source_size") > 0, F.ceil(F.col("source_size") / block)
    sources = sources.select(F.xxhash64("source_key").alias("source_id"), "source_size", "target", F.floor("target").alias("quota"))
    sources = sources.withColumn("passes", F.when(whole, F.floor(F.col("quota") / F.col("source_size"))).otherwise(0))
    rest = F.col("quota") - F.col("passes") * F.col("source_size")
    sources = sources.withColumns({"blocks": blocks, "full_blocks": F.floor(F.col("source_size") / block), "rest": rest})
    sources = settle(sources.withColumn("n_slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block)))
    total, n_sources = sources.agg(F.coalesce(F.sum("n_slots"), F.lit(0)), F.count("*")).first()
    few = F.broadcast if n_sources <= FEW_SOURCES else lambda df: df

    # where each document stands in its source
    part = F.pmod(F.xxhash64("doc_id", "doc_key"), F.lit(PARTS))
    sized = sized.drop("source_key").withColumn("part", part)
    before = Window.partitionBy("source_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sized.groupBy("source_id", "part").agg(F.sum("size").alias("words")).withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0)))
    inside = Window.partitionBy("source_id", "part").orderBy("doc_id", "doc_key", "copy").rowsBetween(Window.unboundedPreceding, 0)
    sized = sized.withColumn("upto", F.sum("size").over(inside)).join(parts.drop("words"), ["source_id", "part"])
    sized = sized.select("doc_id", "doc_key", "copy", "source_id", "size", (F.col("base") + F.col("upto") - F.col("size")).alias("offset"))

    # multinomial draws: a ticket of all slots' tickets for each slot of each shard
    tickets = with_sums_before(sources.select("source_id", "n_slots"), ["source_id"], low="n_slots").filter("n_slots > 0")
    wide = max(1, total // 1024)
    tickets = tickets.select("*", F.explode(F.sequence(F.floor(F.col("low") / wide), F.floor((F.col("low") + F.col("n_slots") - 1) / wide))).alias("range"))
    draws = spark.range(total).select(F.floor(F.col("id") / shard_slots).alias("shard"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, total))).alias("ticket"))
    draws = draws.withColumn("range", F.floor(F.col("ticket") / wide)).join(tickets, "range").filter("ticket >= low and ticket < low + n_slots")
    counts = draws.groupBy("source_id", "shard").agg(F.count("*").alias("drawn"))
    so_far = Window.partitionBy("source_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("drawn").over(so_far), F.lit(0))).join(few(sources.select("source_id", "n_slots")), "source_id")
    counts = counts.select("source_id", "shard", "first", F.least("drawn", F.col("n_slots") - F.col("first")).alias("taken")).filter("taken > 0")
    # slots drawn beyond a source's number go, in further shards, to those that are short
    short = few(sources.filter("n_slots > 0")).join(counts.groupBy("source_id").agg(F.sum("taken").alias("have")), "source_id", "left")
    short = short.select("source_id", F.coalesce("have", F.lit(0)).alias("first"), (F.col("n_slots") - F.coalesce("have", F.lit(0))).alias("taken")).filter("taken > 0")
    short = with_sums_before(short, ["source_id"], before="taken")
    short = short.select("source_id", (F.floor((F.col("before") + F.col("taken")) / shard_slots) + total // shard_slots + 1).alias("shard"), "first", "taken")
    counts = counts.unionByName(short.select("source_id", "shard", "first", "taken"))
    # long runs are cut before they are laid out slot by slot
    counts = counts.select("source_id", "shard", F.col("first").alias("run"), "taken", F.explode(F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / 1024))).alias("cut"))
    # they are few bytes but much work: tasks by the number of slots
    counts = counts.repartition(-(-total // TASK_SLOTS) + 1, "source_id", "shard", "cut")
    low = F.col("run") + F.col("cut") * 1024
    slots = counts.select("source_id", "shard", F.explode(F.sequence(low, F.least(low + 1023, F.col("run") + F.col("taken") - 1))).alias("slot"))
    slots = slots.join(few(sources), "source_id")
    last = F.col("slot") >= F.col("passes") * F.col("blocks")
    slots = slots.withColumn("pass", F.when(last, F.col("passes")).otherwise(F.floor(F.col("slot") / F.col("blocks"))))
    slots = slots.withColumn("index", F.col("slot") - F.col("pass") * F.col("blocks"))
    at = permuted(F.least("index", F.greatest(F.col("full_blocks") - 1, F.lit(0))), F.greatest("full_blocks", F.lit(1)), F.lit(seed), F.col("source_id"), F.col("pass"))
    length = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    slots = slots.withColumn("block", F.when(F.col("index") < F.col("full_blocks"), at).otherwise(F.col("full_blocks")))
    slots = slots.withColumn("words", F.when(last, F.least(length, F.col("rest") - F.col("index") * block)).otherwise(length))
    return sized, sources, slots.select("shard", "slot", "source_id", "block", "words", "pass")


def _pieces(sized: DataFrame, slots: DataFrame, block: int) -> DataFrame:
    """Documents cut at block ends, one row for each time that the mix takes their block:
    low and high in the block, and got, the words taken."""
    pieces = sized.filter("size > 0").select("*", F.explode(F.sequence(F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("size") - 1) / block))).alias("block"))
    low = F.greatest(F.col("offset") - F.col("block") * block, F.lit(0))
    high = F.least(F.col("offset") + F.col("size") - F.col("block") * block, F.lit(block))
    pieces = pieces.withColumns({"low": low, "high": high})
    return pieces.join(slots, ["source_id", "block"], "left").withColumn("got", F.greatest(F.least("high", F.coalesce("words", F.lit(0))) - F.col("low"), F.lit(0)))


def mix_sizes(docs: DataFrame, block: int = BLOCK, **how) -> DataFrame:
    """How many words of each document the mix takes.

    docs: doc_id long, source string, text string; other columns are left out. One row
    per input row: doc_id, size, source_size, target (of its source), taken. A null
    source is a source, the last one; a null or empty text has size 0 and nothing is
    taken of it; repeated rows are documents of their own; the same input gives the same result.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "source", "text")
    docs = docs.select(F.col("doc_id"), F.xxhash64("text").alias("doc_key"), F.lit(0).alias("copy"), "source", "text")
    sized, sources, slots = mix_plan(docs, block, **how)
    got = _pieces(sized, slots, block).groupBy("source_id", "offset", "doc_id", "size").agg(F.sum("got").alias("taken"))
    none = sized.filter("size = 0").select("source_id", "offset", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    few = F.broadcast if sources.count() <= FEW_SOURCES else lambda df: df
    return got.unionByName(none).join(few(sources.select("source_id", "source_size", "target")), "source_id").select("doc_id", "size", "source_size", "target", "taken")


@shielded("doc_id", "text", "source", "n_chars")
def mix_documents(docs: DataFrame, block: int = BLOCK, **how) -> DataFrame:
    """The mixed corpus: rows with the columns of docs, whatever their names, in which text (and n_chars, where
    there is one) is a run of words that one pass takes of a document; a document taken
    whole keeps its text as it is, others have their words joined by one space. Documents
    without words, null texts among them, are in no block and so not in the mix. A null
    source is a source; repeated rows are documents of their own; an empty table gives an
    empty mix.
    """
    given = docs.columns
    docs = docs.withColumn("doc_key", F.xxhash64(*(c for c in given if c != "doc_id")))
    docs = docs.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "doc_key").orderBy("doc_id")))
    sized, _, slots = mix_plan(docs, block, **how)
    own = ["doc_id", "doc_key", "copy"]
    taken = _pieces(sized, slots, block).filter("got > 0").select(*own, "size", "pass", (F.col("low") + F.col("block") * block - F.col("offset")).alias("from"), "got")
    # neighbouring pieces of one pass are one run
    order = Window.partitionBy(*own, "pass").orderBy("from")
    taken = taken.withColumn("gap", (F.coalesce(F.lag(F.col("from") + F.col("got")).over(order), F.lit(-1)) != F.col("from")).cast("int"))
    taken = taken.withColumn("run", F.sum("gap").over(order)).groupBy(*own, "size", "pass", "run").agg(F.min("from").alias("from"), F.sum("got").alias("got"))
    runs = taken.groupBy(*own).agg(F.collect_list(F.struct("size", "from", "got")).alias("runs"))
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.doc_key") == F.col("r.doc_key")) & (F.col("d.copy") == F.col("r.copy"))
    out = docs.alias("d").join(runs.alias("r"), same).select(*(F.col(f"d.{c}") for c in given), F.explode("runs").alias("run"))
    words = F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    part = F.array_join(F.slice(words, (F.col("run.from") + 1).cast("int"), F.col("run.got").cast("int")), " ")
    out = out.withColumn("text", F.when(F.col("run.got") == F.col("run.size"), F.col("text")).otherwise(part))
    if "n_chars" in given:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*given)

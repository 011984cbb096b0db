"""Similarity join of texts on the Jaccard index of their word shingles, with the
PartEnum signatures of Arasu, Ganti and Kaushik (2006).

Sets go to bands of sizes so that similar ones are in one band or in neighbours; an
instance of the scheme covers two neighbouring bands. Within an instance similar sets
differ in k elements at most. Its domain is split by hash into n1 parts of three cells
each, with 2 * n1 > k, so that two similar sets differ in at most one element in some
part, and hence agree on two of its three cells. A signature is the content of two
cells of a part: all three choices are enumerated. n1 stands a little above its least
value, so that part agreements are left over when cells are empty; a set with too many
empty cells to be sure of one gives each of its elements as a signature as well.

Copies (equal sets) are one class with one fingerprint. Signatures travel as packed
arrays, one row for each batch of texts and bucket of signatures. A bucket gives all
pairs of a group of up to PAIRED classes. A larger group gives its members and pairs of
each with the group's hubs, the members of least and of greatest priority. Sizes and odd
sketches bound the difference of two sets from below, and what may still be similar is
verified. Links make components. What large groups hold beyond that is settled by exact
bounds, so that no pair that could join two components is left out:

1. Shingles of a member that no other component of members has cannot be shared with
   one: members with too many of them have no more links. This is done before the hubs
   are met, when each member is a component, and again after it.
2. The others meet by prefixes: of two similar sets each has a shingle of the other
   among its few rarest ones, so many as their sizes allow. Pairs of different
   components that share one are verified.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import connected_components, discard, settle, small_batches, shielded
from .text_arrays import byte_runs, mix, shingle_sets

WIDTH, PERCENT = 5, 80
#: Classes in a group of one signature of which all pairs are given.
PAIRED = 10
#: Signatures in a bucket, about: one bucket at a time is in a task's memory.
BUCKET_ROWS = 2_000_000
#: Pairs with one first set that one task's group verifies.
HOMES = 2000
#: Columns of an odd sketch, of 64 bits each.
ODD = [f"odd{i}" for i in range(8)]
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Sizes are shipped as whole powers of this number.
_LEVEL = np.log(1.1)


class Bands:
    """Size bands and, for each instance (bands j and j + 1), k and n1."""

    def __init__(self, percent: int):
        self.percent, self.lows = percent, [1]

    def upto(self, size: int) -> None:
        while self.lows[-1] <= size:
            self.lows.append(self.lows[-1] * 100 // self.percent + 1)

    def band(self, sizes: np.ndarray) -> np.ndarray:
        self.upto(int(sizes.max(initial=1)) + 1)
        return np.searchsorted(np.array(self.lows), sizes, "right") - 1

    def most_apart(self, instance: np.ndarray) -> np.ndarray:
        """k: |A - B| + |B - A| of similar sets, the smaller one in band `instance`."""
        self.upto(1 << 40)
        large = np.array(self.lows)[instance + 1] - 1
        return (large + large * 100 // self.percent) * (100 - self.percent) // (100 + self.percent)


def fingerprint(s: np.ndarray) -> int:
    """Of a set of shingle hashes, as a signed 64-bit number; 0 for the empty set."""
    if not len(s):
        return 0
    return int(mix(np.array([mix(s).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def odd_sketch(s: np.ndarray, cells: int = 512) -> np.ndarray:
    """The parity of the number of elements in each cell, as bits of 64-bit numbers: two sets
    differ in at least as many elements as their sketches in bits. The two halves of a
    sketch make one of half as many cells."""
    counts = np.bincount((s >> np.uint64(23)).astype(np.int64) & (cells - 1), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def wide_sketch(s: np.ndarray) -> np.ndarray:
    """An odd sketch of at least four cells for each element."""
    return odd_sketch(s, max(512, 1 << (4 * len(s) - 1).bit_length()))


def signatures(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Signature and number of its set, for sets that are not empty."""
    sizes = np.array([len(s) for s in sets])
    all_elements, band = np.concatenate(sets), bands.band(sizes)
    out_sig, out_set = [], []
    for down in (0, 1):
        used = np.flatnonzero(band >= down)
        if not len(used):
            continue
        instance = band[used] - down
        k = bands.most_apart(instance)
        n1 = k // 2 + 1 + -(-k * 12 // 100)
        keep = np.repeat(band >= down, sizes)
        elements, of = all_elements[keep], np.repeat(np.arange(len(used)), sizes[used])
        base = np.concatenate([[0], np.cumsum(3 * n1)])
        part = ((elements >> np.uint64(32)) * n1[of].astype(np.uint64)) >> np.uint64(32)
        cell = base[of] + part.astype(np.int64) * 3 + ((elements & np.uint64(0xFFFFFFFF)) % np.uint64(3)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        heads = np.flatnonzero(np.r_[True, np.diff(cell[order]) > 0])
        sums, filled = np.zeros(base[-1], np.uint64), np.zeros(base[-1], bool)
        where = cell[order][heads]
        sums[where] = np.add.reduceat(mix(elements[order] + _GOLD), heads)
        filled[where] = True
        sums, filled = sums.reshape(-1, 3), filled.reshape(-1, 3)
        owner = np.repeat(np.arange(len(used)), n1)
        index = (np.arange(len(owner)) - np.repeat(base[:-1] // 3, n1)).astype(np.uint64)
        label = instance[owner].astype(np.uint64) * np.uint64(1 << 40) + index * np.uint64(4)
        for left_out in range(3):
            a, b = [c for c in range(3) if c != left_out]
            some = filled[:, a] | filled[:, b]
            sig = mix(sums[:, a] + sums[:, b] * _GOLD + mix(label + np.uint64(left_out)))
            out_sig.append(sig[some])
            out_set.append(used[owner[some]])
        bad = np.bincount(owner[filled.sum(1) < 2], minlength=len(used))
        unsure = n1 - k // 2 <= bad
        if unsure.any():
            chosen = unsure[of]
            out_sig.append(mix(elements[chosen] + mix(instance[of[chosen]].astype(np.uint64) * np.uint64(1 << 40) + np.uint64(3))))
            out_set.append(used[of[chosen]])
    return np.concatenate(out_sig), np.concatenate(out_set)


def describe(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """doc_id, doc_key, text -> doc_id, doc_key, n, fp, odd sketch."""
    for batch in batches:
        n, fp, odd = [], [], [np.zeros((0, len(ODD)), np.int64)]
        for _, _, data, offsets in byte_runs(batch.column(2)):
            sets = shingle_sets(data, offsets, width)
            n += [len(s) for s in sets]
            fp += [fingerprint(s) for s in sets]
            odd += [odd_sketch(s)[None] for s in sets]
        sketches = [pa.array(x) for x in np.concatenate(odd).T.copy()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(fp, pa.int64()), *sketches], names=["doc_id", "doc_key", "n", "fp", *ODD])


def size_level(sizes: np.ndarray) -> np.ndarray:
    return np.minimum(np.log(np.maximum(sizes, 1)) / _LEVEL, 255).astype(np.uint8)


def packed_rows(values: np.ndarray, of: np.ndarray, buckets: int, named: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row for each bucket: its values (low 32 bits) by set, how many each set has, and of
    these sets what is in `named`."""
    bucket = ((values >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((of, bucket))
    values, of, bucket = values[order], of[order], bucket[order]
    cuts = [*np.flatnonzero(np.r_[True, np.diff(bucket) > 0]).tolist(), len(bucket)]
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        inside, counts = np.unique(of[a:b], return_counts=True)
        counts = counts.astype(np.uint32 if counts.max() > 65535 else np.uint16)
        rows.append((int(bucket[a]), values[a:b].astype(np.uint32).tobytes(), counts.tobytes(), *(x[inside].tobytes() for x in named)))
    names = ["bucket", "sigs", "counts", *(f"named{i}" for i in range(len(named)))]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if i == 0 else pa.binary()) for i, x in enumerate(zip(*rows, strict=True))], names=names)


_PACKED = "bucket int, sigs binary, counts binary, named0 binary, named1 binary"


def whole_buckets(batches: Iterator[pa.RecordBatch], kinds: tuple[str, str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows sorted by bucket -> bucket, values, and for each value what is named of its set."""
    now, held = None, []
    for batch in batches:
        for bucket, sigs, counts, *named in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != now:
                if held:
                    yield now, *(np.concatenate(x) for x in zip(*held, strict=True))
                now, held = bucket, []
            sets = [np.frombuffer(x, k) for x, k in zip(named, kinds, strict=True)]
            count = np.frombuffer(counts, np.uint16 if len(counts) == 2 * len(sets[0]) else np.uint32)
            held.append((np.frombuffer(sigs, np.uint32), *(np.repeat(x, count) for x in sets)))
    if held:
        yield now, *(np.concatenate(x) for x in zip(*held, strict=True))


def pack_signatures(batches: Iterator[pa.RecordBatch], width: int, percent: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """text -> packed signatures with fingerprint and size level of their sets; of copies within
    a task one."""
    bands, seen = Bands(percent), set()
    for batch in batches:
        for _, _, data, offsets in byte_runs(batch.column(0)):
            named = {fp: s for s in shingle_sets(data, offsets, width) if len(s) and (fp := fingerprint(s)) not in seen}
            if named:
                seen.update(named)
                sets = list(named.values())
                sig, of = signatures(sets, bands)
                yield from packed_rows(sig, of, buckets, [np.array(list(named), np.int64), size_level(np.array([len(s) for s in sets]))])


def pairs_of_bucket(sig: np.ndarray, fp: np.ndarray, level: np.ndarray, percent: int, paired: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (smaller fp first) of the groups up to `paired`, and pairs of the members
    of larger ones with their hubs (hub first); no repeats."""
    order = np.lexsort((mix(fp.view(np.uint64)), sig))
    sig, fp, level = sig[order], fp[order], level[order].astype(np.int64)
    first = np.r_[True, (sig[1:] != sig[:-1]) | (fp[1:] != fp[:-1])]
    sig, fp, level = sig[first], fp[first], level[first]
    heads = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
    counts = np.diff(np.append(heads, len(sig)))
    apart = int(np.log(100 / percent) / _LEVEL) + 1
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for g in np.unique(counts):
        if 2 <= g <= paired:
            a, b = np.triu_indices(g, 1)
            left.append((heads[counts == g][:, None] + a).ravel())
            right.append((heads[counts == g][:, None] + b).ravel())
    i, j = np.concatenate(left), np.concatenate(right)
    ok = np.abs(level[i] - level[j]) <= apart
    pairs = np.sort(np.stack([fp[i[ok]], fp[j[ok]]], 1), axis=1)
    big = counts > paired
    members = np.flatnonzero(np.repeat(big, counts))
    hubs = np.concatenate([np.repeat(heads[big], counts[big]), np.repeat(heads[big] + counts[big] - 1, counts[big])])
    # a member stays, with itself, where no hub is of its size
    hubs = np.where(np.abs(level[hubs] - np.tile(level[members], 2)) <= apart, hubs, np.tile(members, 2))
    met = np.stack([fp[hubs], np.tile(fp[members], 2)], 1)
    return tuple(np.unique(x, axis=0) if len(x) else x.reshape(0, 2) for x in (pairs, met))


def meet_in_buckets(batches: Iterator[pa.RecordBatch], percent: int, paired: int) -> Iterator[pa.RecordBatch]:
    """Packed signatures sorted by bucket -> kind 0: pair a, b; kind 1: member b of a large
    group and its hub a."""
    for _, sig, fp, level in whole_buckets(batches, ("<i8", "u1")):
        for kind, rows in enumerate(pairs_of_bucket(sig, fp, level, percent, paired)):
            for i in range(0, len(rows), 50_000):
                part = rows[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(part[:, 0]), pa.array(part[:, 1])], names=["kind", "a", "b"])


def shingle_rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """text, fp, member -> fp, member, n, sketch (wide), elements."""
    for batch in batches:
        given = batch.columns[1:]
        for first, last, data, offsets in byte_runs(batch.column(0)):
            sets = shingle_sets(data, offsets, width)
            ends = np.cumsum([0, *(len(s) for s in sets)])
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            sketches = [wide_sketch(s) for s in sets]
            bits = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x) for x in sketches)]), pa.int32()), pa.array(np.concatenate(sketches)))
            sizes = pa.array(np.diff(ends).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*(c.slice(first, last - first) for c in given), sizes, bits, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["fp", "member", "n", "sketch", "elements"])


def _slices(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(), np.cumsum([0, *pa.compute.list_value_length(column).to_pylist()])
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """home, salt, fp, elements, a home's own set first -> a, b of the similar pairs."""
    home, own = None, np.zeros(0, np.int64)
    for batch in batches:
        found = []
        keys = (c.to_pylist() for c in batch.columns[:3])
        for h, salt, fp, other in zip(*keys, _slices(batch.column(3)), strict=True):
            if h == fp:
                home, own = (h, salt), other
            else:
                assert home == (h, salt), "a pair without its first set"
                both = np.sort(np.concatenate([own, other]))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                if 100 * shared >= percent * (len(own) + len(other) - shared):
                    found.append((h, fp))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The similar ones of distinct pairs (a, b) of fingerprints; the sets meet at a's home,
    which has a place for each HOMES pairs."""
    places = F.ceil(F.count("*").over(Window.partitionBy("a")) / HOMES)
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), places).cast("int"))
    # the first pair of a place brings the home's own set as well
    first = F.row_number().over(Window.partitionBy("a", "salt").orderBy("b")) == 1
    both = F.when(first, F.array("a", "b")).otherwise(F.array("b"))
    sends = pairs.select(F.col("a").alias("home"), "salt", both.alias("fps")).select("home", "salt", F.explode("fps").alias("fp"))
    # both sides grow with the documents, so neither is broadcast at any size
    met = sends.join(sets.select("fp", "elements").hint("shuffle_merge"), "fp").select("home", "salt", "fp", "elements")
    met = met.repartition("home", "salt").sortWithinPartitions("home", "salt", F.col("fp") != F.col("home"), "fp")
    return met.mapInArrow(lambda it: verify(it, percent), "a long, b long")


def may_be_similar(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that size and odd sketch do not rule out."""
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("fp").alias(side), F.col("n").alias(f"{side}_n"), *(F.col(o).alias(f"{side}_{o}") for o in ODD)), side)
    differ = sum((F.bit_count(F.col(f"a_{o}").bitwiseXOR(F.col(f"b_{o}"))) for o in ODD), F.lit(0))
    close = (F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent) & (differ * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent))
    return pairs.filter(close).select("a", "b")


def still_similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that wide sketches do not rule out either. The wider of two is folded."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("fp").alias(side), F.col("n").alias(f"{side}_n"), F.col("sketch").alias(f"{side}_sketch")), side)
    width = F.least(F.size("a_sketch"), F.size("b_sketch"))

    def folded(x: Column) -> Column:
        return F.when(F.size(x) > width, F.zip_with(F.slice(x, F.lit(1), width), F.slice(x, width + 1, width), lambda u, v: u.bitwiseXOR(v))).otherwise(x)

    apart = F.zip_with(folded(F.col("a_sketch")), folded(F.col("b_sketch")), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    differ = F.aggregate(apart, F.lit(0), lambda t, v: t + v)
    return pairs.filter(differ * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)).select("a", "b")


def count_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed elements sorted by bucket, with fingerprint and component of their sets -> fp and
    the number of its elements in the bucket that are in no other component."""
    for _, x, fp, part in whole_buckets(batches, ("<i8", "<i8")):
        order = np.lexsort((fp, x))
        order = order[np.r_[True, (np.diff(x[order]) != 0) | (np.diff(fp[order]) != 0)]]
        heads = np.flatnonzero(np.r_[True, np.diff(x[order]) != 0])
        alone = np.minimum.reduceat(part[order], heads) == np.maximum.reduceat(part[order], heads)
        alone = np.repeat(alone, np.diff(np.append(heads, len(order))))
        fps, count = np.unique(fp[order][alone], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(fps), pa.array(count.astype(np.int64))], names=["fp", "own"])


def pack_elements(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """fp, component, elements -> packed elements."""
    for batch in batches:
        sets = _slices(batch.column(2))
        of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        values = np.concatenate(sets).view(np.uint64) if sets else np.zeros(0, np.uint64)
        if len(values):
            yield from packed_rows(values, of, buckets, [batch.column(0).to_numpy(), batch.column(1).to_numpy()])


def n_buckets(spark, rows: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-rows // BUCKET_ROWS))


def by_bucket(packed: DataFrame, buckets: int, work: Callable, schema: str) -> DataFrame:
    return packed.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(work, schema)


def still_open(sets: DataFrame, percent: int) -> DataFrame:
    """fp of the sets (fp, n, component, elements) that could be similar to one of another component."""
    buckets = n_buckets(sets.sparkSession, sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    packed = sets.select("fp", "component", "elements").mapInArrow(lambda it: pack_elements(it, buckets), _PACKED)
    own = by_bucket(packed, buckets, count_own, "fp long, own long").groupBy("fp").agg(F.sum("own").alias("own"))
    kept = sets.select("fp", "n").join(own, "fp", "left").filter((F.col("n") - F.coalesce("own", F.lit(0))) * 100 >= F.col("n") * percent)
    return settle(kept.select("fp").distinct())


def prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets (fp, n, component, elements) of different components that share one of their
    rarest shingles, so many as two similar sets of their sizes have to look at."""
    rows = sets.select("fp", "n", "component", F.explode("elements").alias("x"))
    rows = rows.join(rows.groupBy("x").agg(F.count("*").alias("often")).filter("often > 1"), "x", "left")
    ordered = F.transform(F.array_sort(F.collect_set(F.struct(F.coalesce("often", F.lit(1)).alias("often"), "x"))), lambda s: s["x"])
    look = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    first = rows.groupBy("fp", "n", "component").agg(ordered.alias("elements")).select("fp", "n", "component", F.posexplode(F.slice("elements", F.lit(1), look.cast("int"))).alias("at", "x"))
    first = settle(first)
    other = first.select("x", F.col("fp").alias("b"), F.col("n").alias("b_n"), F.col("component").alias("b_component"), F.col("at").alias("b_at"))
    needed = F.ceil((F.col("n") + F.col("b_n")) * percent / (100 + percent))
    meet = (F.col("component") != F.col("b_component")) & (F.col("fp") < F.col("b")) & (F.least("n", "b_n") * 100 >= F.greatest("n", "b_n") * percent)
    meet = meet & (F.col("at") <= F.col("n") - needed) & (F.col("b_at") <= F.col("b_n") - needed)
    return first.join(other, "x").filter(meet).select(F.col("fp").alias("a"), "b").distinct()


def ngram_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, paired: int = PAIRED) -> DataFrame:
    """Components of texts whose word shingles have a Jaccard index of percent / 100 or more.

    docs: doc_id long, text string; other columns are left out. One row per input row:
    doc_id, doc_key (hash of the text), n_shingles, component_id (the smallest doc_id
    reachable by links, itself included), component_key (a number for each component, null
    without words). A text of fewer than `width` words has its whole sequence as one shingle;
    one without words, or null, links with nothing. Repeated rows are copies. A null
    doc_id takes part and is never the smallest, so its component is null only if all ids in it are.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("doc_key"), "text")
    base = settle(docs.mapInArrow(lambda it: describe(it, width), "doc_id long, doc_key long, n long, fp long, " + ", ".join(f"{o} long" for o in ODD)))
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc_key"))
    classes = settle(base.filter("n > 0").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), *(F.min(o).alias(o) for o in ODD), one.alias("one")))

    buckets = n_buckets(spark, base.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    packed = docs.select("text").mapInArrow(lambda it: pack_signatures(it, width, percent, buckets), _PACKED)
    met = settle(by_bucket(packed, buckets, lambda it: meet_in_buckets(it, percent, paired), "kind int, a long, b long"))
    pairs = settle(may_be_similar(met.filter("kind = 0").select("a", "b").distinct(), classes, percent))
    hubs = settle(met.filter("kind = 1").select("a", "b").distinct())
    discard(met)

    members = hubs.select(F.col("b").alias("fp")).distinct()
    of_pairs = pairs.select(F.explode(F.array("a", "b")).alias("fp"), F.lit(False).alias("member"))
    needed = of_pairs.unionByName(members.withColumn("member", F.lit(True))).groupBy("fp").agg(F.max("member").alias("member")).join(classes, "fp")
    needed = needed.select("fp", "member", F.col("one.doc_id").alias("of_id"), F.col("one.doc_key").alias("of_key"))
    # rows that are equal in id and text give a set again, which does no harm below
    texts = docs.join(needed, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("doc_key") == F.col("of_key"))).select("text", "fp", "member")
    sets = settle(texts.mapInArrow(lambda it: shingle_rows(it, width), "fp long, member boolean, n long, sketch array<long>, elements array<long>"))

    crowded = not hubs.isEmpty()
    if crowded:
        # each member is a component of its own at first
        left = still_open(sets.filter("member").withColumn("component", F.col("fp")), percent)
        close = hubs.join(left.withColumnRenamed("fp", "a"), "a", "left_semi").join(left.withColumnRenamed("fp", "b"), "b", "left_semi").filter("a <> b")
        close = close.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = pairs.unionByName(may_be_similar(close, classes, percent)).distinct()
    edges = settle(verified(settle(still_similar(pairs, sets, percent)), sets, percent))
    parts = connected_components(edges)
    if crowded:
        # few sets are left, and go in a table of their own
        named = left.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
        few = settle(sets.filter("member").join(named, "fp"))
        few = settle(few.join(still_open(few, percent), "fp", "left_semi"))
        more = settle(verified(settle(still_similar(prefix_pairs(few, percent), few, percent)), few, percent))
        if not more.isEmpty():
            parts = connected_components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    discard(sets)

    # a component's own node is a leaf of none
    named = classes.select("fp", "rep").join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lows = named.groupBy("component").agg(F.min("rep").alias("low"))
    named = named.join(lows, "component").select("fp", "low", F.col("component").alias("component_key"))
    return base.join(named, "fp", "left").select("doc_id", "doc_key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id"), "component_key")


@shielded("doc_id", "text")
def one_of_each(docs: DataFrame, **how: int) -> DataFrame:
    """The rows of docs, all columns whatever their names, without near copies: of each component
    the text of smallest doc_id (null is the greatest) stays, once. Null texts and those
    without words all stay; an empty table stays empty."""
    found = ngram_components(docs, **how).filter("n_shingles > 0")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("of_id"), F.col("doc_key").alias("of_key"))
    best = found.groupBy("component_key").agg(F.min(place).alias("best")).select("best.of_id", "best.of_key")
    text = F.coalesce("text", F.lit(""))
    keyed = docs.withColumns({"of_id": F.col("doc_id").cast("long"), "of_key": F.xxhash64("text"), "worded": F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]"))})
    same = keyed.of_id.eqNullSafe(best.of_id) & (keyed.of_key == best.of_key)
    kept = keyed.filter("worded").join(best, same, "left_semi").dropDuplicates(["of_id", "of_key"])
    return kept.unionByName(keyed.filter("not worded")).select(*docs.columns)

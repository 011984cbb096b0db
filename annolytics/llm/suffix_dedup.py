"""Repeated byte strings of a corpus, by a collection Burrows-Wheeler transform
that grows column by column.

A string of `length` bytes (a window) is repeated if it starts at two places of the
corpus. Windows are dealt to groups that equal windows must share, so that the
transform is built over many small collections on all executors and not once:

1. Every window has a least `anchor`-byte gram by hash (a winnowing minimiser). Equal
   windows have equal ones. Runs of windows with one minimiser are the segments; a
   minimiser met once in the corpus ends here, and so do groups of equal segments,
   which are wholly repeated. Those that meet in one batch of texts are settled there,
   so that of a passage that many documents share a batch ships each segment once.
2. The other segments are cut, at fixed distances from the minimiser, into pieces of
   `STEP` windows at most. The bytes that all windows of a piece share (its core)
   become one symbol; before it stand up to STEP - 1 bytes and after it as many.
3. The pieces of a group are the documents of a collection. Each round inserts one
   symbol of every piece, from the last to the first, into the transform, and sets
   the common prefixes of the new suffixes with their neighbours. A window is
   repeated if its suffix shares STEP symbols with a neighbour.

Spark's shuffle files are the sequential external files: a task streams its sorted
groups and holds one bounded collection at a time. A group of over HOT_GROUP pieces
is settled by counting its single windows, whose keys spread over all tasks.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import join_skewed, settle, small_batches, shielded
from .text_arrays import byte_runs, mix

LENGTH = 400
#: Bytes of the grams of which the least is the minimiser of a window.
ANCHOR = 128
#: Windows in a piece at most; LENGTH - STEP + 1 bytes are its core.
STEP = 32
#: Pieces inserted in one collection.
COLLECTION = 20_000
#: Distinct pieces of one group beyond which its windows are counted one by one.
HOT_GROUP = 100_000

#: Bits of a packed minimiser that hold its place; texts may have so many bytes.
_PLACE_BITS = np.uint64(28)

SEGMENT = "anchor long, content long, doc_id long, doc_key long, start int, windows int, times int"
PIECE = "anchor long, place int, core long, content long, left binary, right binary, doc_id long, doc_key long, start int, n int, single boolean"
RANGE = "doc_id long, doc_key long, start int, n int"


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the `width` bytes (a power of two) from each place on."""
    h, done = mix(data.astype(np.uint64) + np.uint64(1)), 1
    while done < width:
        h = mix(h[:-done] * np.uint64(0x9E3779B97F4A7C15) + h[done:])
        done *= 2
    return h


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        h = np.minimum(h[:-done], h[done:])
        done *= 2
    return np.minimum(h[: len(h) - (width - done)], h[width - done :]) if done < width else h


def find_segments(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Columns doc_id, doc_key, text -> SEGMENT rows. times: how often the batch has the
    segment, at the first of its places; 0 at the others."""
    reach = length - anchor + 1
    for batch in batches:
        ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows: list[tuple] = []
        for first, last, data, offsets in byte_runs(batch.column(2)):
            if len(data) < length:
                continue
            hashes = gram_hashes(data, anchor)
            # the leftmost of equal ones: the low bits, the same for all texts, hold the place
            least = sliding_min((hashes >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64), reach)
            least &= (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
            change = np.flatnonzero(least[1:] != least[:-1]) + 1
            text = data.tobytes()
            for i in range(last - first):
                a, end = int(offsets[i]), int(offsets[i + 1]) - length + 1
                if end <= a:
                    continue
                lo, hi = np.searchsorted(change, [a + 1, end])
                cuts = [a, *change[lo:hi].tolist(), end]
                anchors = hashes[least[cuts[:-1]]].view(np.int64).tolist()
                for s, e, of in zip(cuts[:-1], cuts[1:], anchors, strict=True):
                    content = xxhash.xxh3_64_intdigest(text[s : e + length - 1])
                    rows.append((of, content - 2**64 if content >= 2**63 else content, ids[first + i], keys[first + i], s - a, e - s))
        if rows:
            times = Counter(row[:2] for row in rows)
            rows = [(*row, times.pop(row[:2], 0)) for row in rows]
            kinds = [pa.int64()] * 4 + [pa.int32()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in SEGMENT.split(", ")])


def cut_pieces(batches: Iterator[pa.RecordBatch], length: int, anchor: int, step: int) -> Iterator[pa.RecordBatch]:
    """Columns text, doc_id, doc_key, wanted (structs of anchor, content, start, windows,
    copies) -> PIECE rows. start and n: the piece's windows in the document; single: its
    content stands there alone."""
    core_bytes = length - step + 1
    for batch in batches:
        rows: list[tuple] = []
        for text, doc_id, doc_key, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = text.encode()
            for w in wanted:
                own = data[w["start"] : w["start"] + w["windows"] + length - 1]
                h = gram_hashes(np.frombuffer(own, np.uint8), anchor)
                at = int(np.argmax(h == np.int64(w["anchor"]).view(np.uint64)))
                block = (at - np.arange(w["windows"])) // step
                heads = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
                for p, q in zip(heads.tolist(), [*heads[1:].tolist(), w["windows"]], strict=True):
                    c = at - int(block[p]) * step  # the core's first byte
                    core = xxhash.xxh3_64_intdigest(own[c : c + core_bytes])
                    core = core - 2**64 if core >= 2**63 else core
                    rows.append((w["anchor"], int(block[p]), core, w["content"], own[p:c], own[c + core_bytes : q - 1 + length], doc_id, doc_key, w["start"] + p, q - p, w["copies"] == 1))
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in PIECE.split(", ")])


def repeated_suffixes(documents: list[np.ndarray], shared: int) -> list[np.ndarray]:
    """For each document (symbols above 0), which of its suffixes share `shared`
    symbols or more with the suffix of another document or place.

    The transform grows by one symbol of each document a round, from the last symbol
    to the first. `bwt` has, in the order of the suffixes so far, the symbol before
    each (0: none); `owner` and `begin` say whose suffix it is and where it starts;
    `common` is its common prefix with the one before it, counted up to `shared`.
    """
    m = len(documents)
    lengths = np.array([len(x) for x in documents])
    width = int(lengths.max())
    # right-aligned: column `width` is the end of all; beyond it nothing is equal
    table = np.zeros((m, width), np.uint16)
    for i, x in enumerate(documents):
        if len(x):
            table[i, width - len(x) :] = x
    bwt = table[:, -1].copy()
    owner, begin = np.arange(m), np.full(m, width)
    common = np.zeros(m, np.uint8)
    at = np.arange(m)  # where each document's newest suffix stands
    ends = m  # the empty suffixes come first

    def prefix(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at i and j."""
        same, live, k = np.zeros(len(i), np.uint8), np.arange(len(i)), 0
        oi, oj, bi, bj = owner[i], owner[j], begin[i], begin[j]
        while len(live) and k < shared:
            live = live[(bi[live] + k < width) & (bj[live] + k < width)]
            live = live[table[oi[live], bi[live] + k] == table[oj[live], bj[live] + k]]
            same[live] += 1
            k += 1
        return same

    for done in range(1, width + 1):
        new = np.flatnonzero(lengths >= done)
        order = np.argsort(bwt, kind="stable")  # suffixes, old and new, by the symbol that each begins with
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        none = len(bwt) - np.count_nonzero(bwt)
        spot = rank[at[new]] - none + ends
        old = np.ones(len(bwt) + len(new), bool)
        old[spot] = False
        grown = []
        for x, y in ((bwt, table[new, width - done - 1] * (lengths[new] > done) if done < width else np.zeros(len(new), np.uint16)), (owner, new), (begin, np.full(len(new), width - done)), (common, np.zeros(len(new), np.uint8))):
            z = np.empty(len(old), x.dtype)
            z[old], z[spot] = x, y
            grown.append(z)
        bwt, owner, begin, common = grown
        moved = np.flatnonzero(old)
        at = moved[at]
        at[new] = spot
        touched = np.unique(np.r_[spot, spot + 1])
        touched = touched[(touched >= ends) & (touched < len(bwt))]
        common[touched] = prefix(touched - 1, touched)
    hit = common >= shared
    hit[:-1] |= hit[1:]
    found = [np.zeros(len(x), bool) for x in documents]
    for d, b in zip(owner[hit].tolist(), begin[hit].tolist(), strict=True):
        found[d][b - width + lengths[d]] = True
    return found


def _bounds(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return edges[::2], edges[1::2]


def _ranges(rows: list[tuple]) -> list[pa.Array]:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return [pa.array([x[i] for x in rows], k) for i, k in enumerate(kinds)]


def insert_collections(batches: Iterator[pa.RecordBatch], step: int, most: int) -> Iterator[pa.RecordBatch]:
    """PIECE rows sorted by group (anchor, place, core) -> RANGE rows of repeated windows,
    those of contents that stand at one place."""
    held: list[tuple] = []

    def settle_held(rows: list[tuple]) -> pa.RecordBatch:
        # equal pieces are inserted once; all the windows of one met twice are repeated
        distinct: dict[tuple, int] = {}
        groups: dict[tuple, int] = {}
        index, copies = [], []
        for anchor, place, core, _, left, right, *_ in rows:
            group = groups.setdefault((anchor, place, core), 256 + len(groups))
            i = distinct.setdefault((group, left, right), len(distinct))
            if i == len(copies):
                copies.append(0)
            copies[i] += 1
            index.append(i)
        symbols = [np.concatenate([np.frombuffer(left, np.uint8).astype(np.uint16) + 1, np.array([group + 1], np.uint16), np.frombuffer(right, np.uint8).astype(np.uint16) + 1]) for group, left, right in distinct]
        found = repeated_suffixes(symbols, step)
        out: list[tuple] = []
        for (*_, doc_id, doc_key, start, n, single), i in zip(rows, index, strict=True):
            if not single:
                continue
            if copies[i] > 1:
                out.append((doc_id, doc_key, start, n))
            else:
                for a, b in zip(*_bounds(found[i][:n]), strict=True):
                    out.append((doc_id, doc_key, start + int(a), int(b - a)))
        return pa.RecordBatch.from_arrays(_ranges(out), names=["doc_id", "doc_key", "start", "n"])

    last, groups = None, 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            group = row[:3]
            if group != last:
                if len(held) >= most or groups >= 60_000:
                    yield settle_held(held)
                    held, groups = [], 0
                last, groups = group, groups + 1
            held.append(row)
    if held:
        yield settle_held(held)


def single_windows(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    """PIECE rows of hot groups -> one row for each window: its 128-bit key, single, RANGE."""
    for batch in batches:
        rows, keys, alone = [], [], []
        for anchor, place, core, _, left, right, doc_id, doc_key, start, n, single in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            head = f"{anchor},{place},{core},".encode()
            for t in range(n):
                part = left[t:]
                keys.append(hashlib.blake2b(head + bytes([len(part)]) + part + right[: step - 1 - len(part)], digest_size=16).digest())
                alone.append(single)
                rows.append((doc_id, doc_key, start + t, 1))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(alone, pa.bool_()), *_ranges(rows)], names=["key", "single", "doc_id", "doc_key", "start", "n"])


def keep_rest(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Columns doc_id, text, spans (start and n of repeated windows) -> the digest of each
    document and its remaining text."""
    for batch in batches:
        out = []
        for doc_id, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = (text or "").encode()
            runs: list[list[int]] = []
            for s in sorted(spans or [], key=lambda s: s["start"]):
                a, b = s["start"], s["start"] + s["n"] + length - 1
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(b, runs[-1][1])
                else:
                    runs.append([a, b])
            cuts = [0, *(x for r in runs for x in r), len(data)]
            rest = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)) if runs else data
            out.append((doc_id, len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), None if text is None else rest.decode("utf-8", "ignore")))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate((*(pa.int64(),) * 4, pa.string(), pa.string()))], names=names)


def repeated_windows(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, step: int = STEP, hot: int = HOT_GROUP) -> DataFrame:
    """doc_id, doc_key, start, n: runs of repeated windows of documents (doc_id, doc_key, text)."""
    small_batches(docs.sparkSession)
    segments = settle(docs.mapInArrow(lambda it: find_segments(it, length, anchor), SEGMENT))
    one = F.min(F.struct("doc_id", "doc_key", "start", "windows")).alias("one")
    counts = F.sum("times").alias("copies"), F.count_if(F.col("times") == 1).alias("lone")
    contents = settle(segments.filter("times > 0").groupBy("anchor", "content").agg(*counts, one))
    # a content that stands at two places is repeated as a whole, at each of them; only those
    # that are alone in their batch have to look for the other place
    twice = contents.filter("copies > 1 and lone > 0").select("anchor", "content", F.col("lone").alias("rows"))
    lone = join_skewed(segments.filter("times = 1"), twice, ["anchor", "content"], ["doc_id", "start"])
    whole = segments.filter("times <> 1").select("doc_id", "doc_key", "start", F.col("windows").alias("n")).unionByName(lone.select("doc_id", "doc_key", "start", F.col("windows").alias("n")))

    # contents that are not alone with their minimiser may share windows
    shared = contents.groupBy("anchor").agg(F.count("*").alias("rows")).filter("rows > 1")
    mixed = join_skewed(contents, shared, ["anchor"], ["content"])
    place = F.struct("anchor", "content", "one.start", "one.windows", "copies")
    wanted = mixed.groupBy("one.doc_id", "one.doc_key").agg(F.collect_list(place).alias("wanted"))
    wanted = wanted.withColumnsRenamed({"doc_id": "of_id", "doc_key": "of_key"})
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("doc_key") == F.col("of_key"))).select("text", "doc_id", "doc_key", "wanted")
    pieces = settle(texts.mapInArrow(lambda it: cut_pieces(it, length, anchor, step), PIECE))

    group, columns = ["anchor", "place", "core"], [x.split()[0] for x in PIECE.split(", ")]
    sizes = pieces.groupBy(group).agg(F.count("*").alias("rows")).filter("rows > 1")
    pieces = join_skewed(pieces, sizes, group, ["content"])
    small = pieces.filter(F.col("rows") <= hot).select(columns).repartition(*group).sortWithinPartitions(*group)
    found = small.mapInArrow(lambda it: insert_collections(it, step, COLLECTION), RANGE)
    big = pieces.filter(F.col("rows") > hot).select(columns)
    single = big.mapInArrow(lambda it: single_windows(it, step), f"key binary, single boolean, {RANGE}")
    twice = single.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1")
    found = found.unionByName(join_skewed(single, twice, ["key"], ["doc_id", "start"]).filter("single").select("doc_id", "doc_key", "start", "n"))
    return whole.unionByName(found)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, **how: int) -> DataFrame:
    """Remove from every text each byte that a repeated string of `length` bytes covers.

    docs: doc_id long, text string; other columns are left out. One row per input row:
    doc_id, n_bytes, n_removed, n_spans, kept_sha256 and text, what is left (bytes that no
    longer form a character are left out of it; null stays null). A null text is
    empty; texts shorter than `length` stay whole; a repeated row counts as a copy, so
    both lose what they share; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("doc_key"), "text")
    windows = repeated_windows(docs, length, **how).distinct()
    spans = windows.groupBy("doc_id", "doc_key").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    spans = spans.withColumnsRenamed({"doc_id": "of_id", "doc_key": "of_key"})
    joined = docs.join(spans, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("doc_key") == F.col("of_key")), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(lambda it: keep_rest(it, length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")


@shielded("doc_id", "text", "n_chars")
def without_repeats(docs: DataFrame, length: int = LENGTH, **how: int) -> DataFrame:
    """The rows of docs, all columns whatever their names, with the repeated bytes of their texts
    removed (n_chars, where there is one, is counted anew). Null texts stay null; repeated rows
    all stay and lose what they share; an empty table stays empty."""
    given = docs.columns
    keyed = docs.withColumns({"own_id": F.col("doc_id").cast("long"), "own_key": F.xxhash64(F.col("doc_id").cast("long"), "text")})
    windows = repeated_windows(keyed.select(F.col("own_id").alias("doc_id"), F.col("own_key").alias("doc_key"), "text"), length, **how).distinct()
    spans = windows.groupBy("doc_id", "doc_key").agg(F.collect_list(F.struct("start", "n")).alias("spans")).withColumnsRenamed({"doc_id": "of_id", "doc_key": "of_key"})
    joined = keyed.join(spans, F.col("own_id").eqNullSafe(F.col("of_id")) & (F.col("own_key") == F.col("of_key")), "left")
    named = [F.col(c).alias(f"given_{i}") for i, c in enumerate(given)]
    kinds = ", ".join(f"given_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(given))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.nulls(len(batch), pa.int64())
            part = pa.RecordBatch.from_arrays([ids, *batch.columns[:2]], names=["doc_id", "text", "spans"])
            for rest in keep_rest(iter([part]), length):
                yield pa.RecordBatch.from_arrays([*batch.columns[2:], rest.column(5)], names=[*batch.schema.names[2:], "kept_text"])

    out = joined.select("text", "spans", *named).mapInArrow(cut, f"{kinds}, kept_text string")
    out = out.select(*(F.col("kept_text" if c == "text" else f"given_{i}").alias(c) for i, c in enumerate(given)))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in given else out

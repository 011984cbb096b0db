"""Maximal periodic runs of words by multi-scale minimizers.

A run of period q is a longest stretch whose words q apart are the same; its smallest period
is q and it has EXPONENT periods or more. At scale k, which serves the periods from k / 2 + 1
to k, the strings of k words are hashed, and the least hash of every window of k / 2
strings is a minimizer. Within a run two strings are equal only a multiple of q apart, and
windows q apart pick strings q apart, so that neighbouring equal minimizers lie exactly one
period apart: such a pair seeds an extension to both sides. Periods up to SHORT are
found by comparing the words at each lag.

Texts lie end to end, with a word of its own between them, and all steps run on arrays over
as many texts as hold RUN_WORDS words; a longer text is taken alone, whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import small_batches
from .text_arrays import mix

#: Fewest words and periods of a run.
LENGTH, EXPONENT = 6, 4
#: Periods found by lag, and words that are searched at once.
SHORT, RUN_WORDS = 4, 200_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_RUNS = "array<struct<start: long, length: long, period: long>>"


class Prefixes:
    """Hashes of the strings of any length at any place, and how far two places agree."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        step = np.full(n, _MULTIPLIER, np.uint64)
        step[:1] = 1
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * np.multiply.accumulate(step), out=self.sums[1:])
        step = np.full(n + 1, _INVERSE, np.uint64)
        step[:1] = 1
        self.back = np.multiply.accumulate(step)
        self.n = n

    def strings(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.back[at]

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words from a and from b (greater) on that agree, by halving steps."""
        done, step = np.zeros_like(a), 1 << max(0, int(self.n).bit_length() - 1)
        while step:
            can = b + done + step <= self.n
            at = np.flatnonzero(can)
            same = self.strings(a[at] + done[at], step) == self.strings(b[at] + done[at], step)
            done[at[same]] += step
            step >>= 1
        return done

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words before a and before b that agree."""
        done, step = np.zeros_like(a), 1 << max(0, int(self.n).bit_length() - 1)
        while step:
            can = a - done - step >= 0
            at = np.flatnonzero(can)
            same = self.strings(a[at] - done[at] - step, step) == self.strings(b[at] - done[at] - step, step)
            done[at[same]] += step
            step >>= 1
        return done


def _extreme(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Extreme of each window of `width`, a power of two."""
    step = 1
    while step < width:
        x = pick(x[:-step], x[step:])
        step *= 2
    return x


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least hash of some window of `width`, all places of a tie."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = _extreme(hashes, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    # the greatest of the minima of the windows around a place
    return np.flatnonzero(_extreme(np.concatenate([edge, least, edge]), width, np.maximum) == hashes)


def _primes(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def find_runs(codes: np.ndarray, longest: int, least: int = LENGTH, exponent: int = EXPONENT) -> np.ndarray:
    """start, length and period of each run of the words, by start and period. longest: words
    of the longest text among them."""
    found, n = [], len(codes)
    for q in range(1, min(SHORT, longest // exponent) + 1):
        same = np.zeros(n - q + 2, np.int8)
        same[1:-1] = codes[q:] == codes[:-q]
        edges = np.diff(same)
        starts, lengths = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0) - np.flatnonzero(edges > 0) + q
        ok = lengths >= max(least, exponent * q)
        found.append(np.stack([starts[ok], lengths[ok], np.full(ok.sum(), q)], 1))
    scale = 2 * SHORT
    prefixes = Prefixes(codes) if longest >= exponent * (SHORT + 1) else None
    while scale // 2 + 1 <= longest // exponent and n > scale:
        places = np.arange(n - scale + 1)
        hashes = mix(prefixes.strings(places, scale))
        at = minimizers(hashes, scale // 2)
        order = at[np.argsort(hashes[at], kind="stable")]
        a, b = order[:-1], order[1:]
        ok = (hashes[a] == hashes[b]) & (b - a > scale // 2) & (b - a <= scale)
        a, b = a[ok], b[ok]
        before, after = prefixes.behind(a, b), prefixes.ahead(a, b)
        runs = np.stack([a - before, before + after + b - a, b - a], 1)
        found.append(np.unique(runs[runs[:, 1] >= np.maximum(least, exponent * runs[:, 2])], axis=0))
        scale *= 2
    runs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)
    keep = [i for i, (s, length, q) in enumerate(runs.tolist()) if _is_run(codes, s, length, q)]
    runs = runs[keep]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _is_run(codes: np.ndarray, start: int, length: int, q: int) -> bool:
    """Whether the words themselves, not their hashes, have the period, at its greatest extent,
    and none that divides it."""
    end = start + length
    if not np.array_equal(codes[start : end - q], codes[start + q : end]):
        return False
    if (start and codes[start - 1] == codes[start - 1 + q]) or (end < len(codes) and codes[end] == codes[end - q]):
        return False
    return not any(np.array_equal(codes[start : end - q // p], codes[start + q // p : end]) for p in _primes(q))


def _searched(lists: list[list[bytes]], least: int, exponent: int) -> list[tuple[list, bytes]]:
    """Runs and kept words of each text."""
    code: dict[bytes, int] = {}
    starts, ends, parts, at = [], [], [], 0
    for i, words in enumerate(lists):
        starts.append(at)
        parts.append(np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, len(words)))
        parts.append(np.array([-2 - i]))  # stands in no text
        at += len(words) + 1
        ends.append(at - 1)
    codes = np.concatenate(parts)
    runs = find_runs(codes, max(map(len, lists)), least, exponent)
    dropped = np.zeros(len(codes) + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(dropped) > 0
    of = np.searchsorted(starts, runs[:, 0], "right") - 1
    out = []
    for i, words in enumerate(lists):
        own = runs[of == i] if len(runs) else runs
        kept = words if not len(own) else [w for w, gone in zip(words, dropped[starts[i] : ends[i]].tolist(), strict=True) if not gone]
        out.append(([{"start": s - starts[i], "length": n, "period": q} for s, n, q in own.tolist()], b" ".join(kept)))
    return out


def _found(batches: Iterator[pa.RecordBatch], least: int, exponent: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        ids, texts, first = batch.column(0), batch.column(1), 0
        while first < len(texts):
            lists, size, last = [], 0, first
            while last < len(texts) and (last == first or size < RUN_WORDS):
                lists.append((texts[last].as_py() or "").encode().split())
                size += len(lists[-1]) + 1
                last += 1
            rows = _searched(lists, least, exponent)
            yield pa.RecordBatch.from_arrays([ids.slice(first, last - first), pa.array([len(x) for x in lists]), pa.array([r for r, _ in rows], kind), pa.array([t.decode() for _, t in rows])], names=["doc_id", "n_words", "runs", "text"])
            first = last


def periodic_runs(docs: DataFrame, least: int = LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length and period in words, by start and period) and text
    (the words kept, one space between them) of every row of docs (doc_id long, text
    string; other columns are left out, whatever their names).

    Words are what stands between white space (bytes 9 to 13 and 32). A run has at least
    `least` words and `exponent` (4 or more, which the scales rely on) periods; a word goes
    if a run holds it after its first period. A null or empty text has no words and the
    text ''. Repeated rows are searched each; an empty table gives an empty result.
    """
    if exponent < 4:
        raise ValueError("runs of fewer than four periods need not meet the minimizers of a scale")
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda batches: _found(batches, least, exponent), f"doc_id long, n_words long, runs {_RUNS}, text string")


def repeat_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where of a tenth of the documents, chosen by the crc32 h of doc_id, the
    words from place g % n on (g = h / 10, n words) repeat the first few of them: a planted
    run. Texts of other rows, of none, and of null doc_id are left as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    chosen = chosen.select("doc_id", "text", "words", F.floor(F.col("h") / 10).alias("g"), F.size("words").cast("long").alias("n"))
    chosen = chosen.select("doc_id", "text", "words", "g", "n", F.when(F.col("n") > 0, F.pmod("g", "n")).alias("a"))
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    chosen = chosen.select("doc_id", "text", "words", "a", p.alias("p"))
    tail = F.transform(F.col("words"), lambda w, i: F.when(i < F.col("a"), w).otherwise(F.element_at("words", (F.col("a") + F.pmod(i - F.col("a"), F.col("p")) + 1).cast("int"))))
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli (of the longest run, the earliest
    of equals), runs_sha256, collapsed_sha256 of periodic_runs rows."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("minus"), (-r["period"]).alias("back"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.back")
    return rows.select("doc_id", "n_runs", (-F.col("best.minus")).alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

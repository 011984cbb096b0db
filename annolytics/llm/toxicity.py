"""Toxicity by compression distance: a dictionary of toxic text and one of ordinary text each
compress the windows of a document; where the toxic one is shorter, by how much and how
nearly it holds the whole window are evidence, and a calibrated threshold decides.

A window is a word with a space at either end, A-Z lower-cased and without punctuation at
its ends; words above LONGEST bytes are cut into windows. Whole texts are scored; only
the fit takes a sample of labelled rows.

Fit. Half the sample trains a pair of dictionaries, and the other half's windows are
compressed by it, so that no window meets a dictionary that has seen its document. Windows
that the toxic dictionary shortens, and that toxic documents hold far more often than
ordinary ones, train the final toxic dictionary; the final ordinary one has ordinary
text in its place, and both start with the same ordinary text, so that what all documents
share costs the same under either. Evidence of each pair of lengths is measured on
the halves that a pair of dictionaries has not seen.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .common import small_batches

#: Most bytes of a window, and of its lengths' classes: saved bytes and bytes left over.
LONGEST, SAVED, LEFT = 48, 9, 8
#: Labelled documents of each class that the fit takes (those of least hash), and the
#: greatest length of one, which bounds the sample in bytes.
FIT_ROWS, FIT_CHARS = 3000, 30_000
#: Bytes of dictionaries, and the compression level: the fast double-hash search.
FIRST, COMMON, LEVEL = 114_688, 65_536, 3
#: Saved bytes from which a window may be toxic; the G statistic and the ratio of document
#: frequencies from which it trains the final dictionary.
LEAST_SAVED, LEAST_G, LEAST_RATIO = 2, 11.0, 8.0
#: Windows that a task remembers the lengths of.
REMEMBERED = 500_000
#: The compressor finds no match that begins in its last 8 bytes; this tail stands there, and
#: ends every dictionary.
TAIL = b"0123456789abcdef"

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_WORD = re.compile(rb"[^\x20\x09-\x0D]{1,%d}" % LONGEST)


def raw_windows(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode())


def window(word: bytes) -> bytes:
    return b" " + word.translate(_LOWER).strip(b".,;:!?\"'()[]*#$%&") + b" "


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content + TAIL, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    settings = zstandard.ZstdCompressionParameters.from_level(LEVEL, window_log=18, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)


def _trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """The content of a trained dictionary; of too few samples, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


@dataclass
class Dictionaries:
    """The contents of a toxic and an ordinary dictionary, as they go to the executors."""

    toxic: bytes
    ordinary: bytes
    known: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> tuple:
        return self.toxic, self.ordinary

    def __setstate__(self, state: tuple) -> None:
        self.toxic, self.ordinary = state
        self.known = {}

    def lengths(self, windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that the toxic dictionary saves on each window against the ordinary one, and
        bytes that it needs beyond those of a window that it holds whole."""
        if "toxic" not in self.known:
            self.known |= {"toxic": _compressor(self.toxic).compress, "ordinary": _compressor(self.ordinary).compress}
            self.known["least"] = len(self.known["toxic"](TAIL))
        ended = [w + TAIL for w in windows]
        a, b = (np.fromiter(map(len, map(self.known[k], ended)), np.int64, len(ended)) for k in ("toxic", "ordinary"))
        return b - a, a - self.known["least"]

    def classes(self, windows: list[bytes]) -> np.ndarray:
        saved, left = self.lengths(windows)
        return np.clip(saved, 0, SAVED - 1) * LEFT + np.clip(left, 0, LEFT - 1)


@dataclass
class Toxicity:
    """A fitted model: dictionaries, evidence of each class of lengths, and the weights of
    [evidence, its root, log of the number of windows, 1]."""

    dictionaries: Dictionaries
    evidence: np.ndarray
    weights: np.ndarray

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_features(counts, self.evidence) @ self.weights, -30, 30)))


def _features(counts: np.ndarray, evidence: np.ndarray) -> np.ndarray:
    total = counts @ evidence
    return np.stack([total, np.sqrt(total), np.log1p(counts.sum(1)), np.ones(len(counts))], 1)


def _counts(windows: list[bytes], dictionaries: Dictionaries) -> np.ndarray:
    return np.bincount(dictionaries.classes(windows), minlength=SAVED * LEFT).astype(float) if windows else np.zeros(SAVED * LEFT)


def _g(n: int, m: int, toxic: int, ordinary: int) -> float:
    """Of n toxic and m ordinary documents with a window, how far the share of toxic ones is
    above what chance gives (0 if it is not)."""
    chance = (n + m) * toxic / (toxic + ordinary)
    return 2 * (n * math.log(n / chance) + (m * math.log(m / (n + m - chance)) if m else 0.0)) if n > chance else 0.0


def _telling(found: list[Counter], toxic: int, ordinary: int) -> list[bytes]:
    """Windows that toxic documents hold far more often, once for each such document, in an
    order that spreads each."""
    keep = {w: n for w, n in found[1].items() if _g(n, found[0][w], toxic, ordinary) >= LEAST_G and n * ordinary >= LEAST_RATIO * (found[0][w] + 0.5) * toxic}
    copies = [(zlib.crc32(w + b"%d" % i), w) for w, n in keep.items() for i in range(n)]
    return [w for _, w in sorted(copies)]


def fit_texts(texts: list[str], toxic: list[int], weights: tuple[float, float] = (1.0, 1.0)) -> Toxicity | None:
    """Fit on labelled texts, whose classes weigh `weights` (ordinary, toxic) in the calibration;
    None unless both classes are there. Equal texts count once."""
    rows = {t: y for t, y in sorted(zip(texts, toxic, strict=True))}
    one: dict[bytes, bytes] = {}  # equal windows are one object
    docs = [(y, zlib.crc32(t.encode()) % 2, [one.setdefault(w, w) for w in map(window, raw_windows(t))]) for t, y in rows.items()]
    number = Counter((y, half) for y, half, _ in docs)
    if not number[0, 0] + number[0, 1] or not number[1, 0] + number[1, 1]:
        return None
    parts: dict[tuple[int, int], list[bytes]] = {(y, h): [] for y in (0, 1) for h in (0, 1)}
    held = {k: Counter() for k in parts}
    for y, half, windows in docs:
        text = b"".join(windows)
        parts[y, half] += [text[i : i + 256] for i in range(0, len(text), 256)]
        held[y, half].update(set(windows))
    size = min(FIRST, *(max(1024, sum(map(len, p)) // 8) for p in parts.values()))
    first = [Dictionaries(*(_trained(parts[y, half], size, 32) for y in (1, 0))) for half in (0, 1)]
    found = []
    for half in (0, 1):
        both = []
        for y in (0, 1):
            windows = list(held[y, half])
            saved, _ = first[1 - half].lengths(windows) if windows else (np.zeros(0), 0)
            both.append(Counter({w: held[y, half][w] for w, s in zip(windows, saved.tolist(), strict=True) if s >= LEAST_SAVED}))
        found.append(both)
    ordinary = parts[0, 0] + parts[0, 1]
    common = _trained(ordinary[::2], min(COMMON, max(1024, sum(map(len, ordinary)) // 16)), 32)

    def final(samples: list[bytes]) -> Dictionaries:
        own = min(8192, 512 + sum(map(len, set(samples))))
        return Dictionaries(common + _trained(samples, own, 16), common + _trained(ordinary[1::2] or ordinary, max(1024, own), 32))

    halves = [final(_telling(found[h], number[1, h] or 1, number[0, h] or 1)) for h in (0, 1)]
    model = final(_telling([found[0][y] + found[1][y] for y in (0, 1)], number[1, 0] + number[1, 1], number[0, 0] + number[0, 1]))
    counts = np.array([_counts(windows, halves[1 - half]) for _, half, windows in docs])
    labels = np.array([y for y, _, _ in docs])
    rates = [np.log((counts[labels == y].sum(0) + 0.5) / (counts[labels == y].sum() + 0.5 * SAVED * LEFT)) for y in (0, 1)]
    evidence = np.where(rates[1] - rates[0] > math.log(1.5), rates[1] - rates[0], 0.0)
    evidence[: LEAST_SAVED * LEFT] = 0.0
    return Toxicity(model, evidence, _logistic(_features(counts, evidence), labels, np.where(labels == 1, weights[1], weights[0])))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; the last column is the intercept."""
    w, pull = np.zeros(x.shape[1]), np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    weight = weight / weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (weight * (p - y)) + pull * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = FIT_ROWS) -> Toxicity | float:
    """Fit on documents with a label of toxic 0 or 1 where `usable` (a condition on doc_id)
    holds: of each class the `rows` documents of least hash, among those of FIT_CHARS
    characters at most. All usable labels give the shares by which the classes count in
    the calibration. Without documents of both classes, the share of toxic ones (0.0 without
    any) is returned, and is every document's score."""
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("place")).filter(usable)
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)").distinct()
    # texts stay where they are: the join and the choice see ids, and the chosen ids are few
    known = named.select("doc_id", "place", F.length("text").alias("size")).join(marked, "doc_id").select("doc_id", "place", "size", "toxic")
    number = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    short = known.filter(F.col("size") <= FIT_CHARS).distinct()
    chosen = [tuple(r) for y in (0, 1) for r in short.filter(F.col("toxic") == y).orderBy("place", "doc_id").limit(rows).select("doc_id", "place", "toxic").collect()]
    ids = docs.sparkSession.createDataFrame(chosen, named.select("doc_id", "place", F.lit(0).alias("toxic")).schema)
    sample = named.join(F.broadcast(ids), ["doc_id", "place"]).groupBy("doc_id", "place", "toxic").agg(F.first("text").alias("text")).collect()
    taken = Counter(r.toxic for r in sample)
    share = number.get(1, 0) / max(1, sum(number.values()))
    if not taken[0] or not taken[1]:
        return share
    weights = (number[0] / taken[0], number[1] / taken[1])
    return fit_texts([r.text for r in sample], [r.toxic for r in sample], weights) or share


def _scored(batches: Iterator[pa.RecordBatch], model: Toxicity) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, int] = {}
    for batch in batches:
        lists = [raw_windows(t) for t in batch.column(1).to_pylist()]
        new = list(set().union(*lists) - known.keys())
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(set().union(*lists))
        if new:
            known.update(zip(new, model.dictionaries.classes([window(w) for w in new]).tolist(), strict=True))
        counts = np.zeros((len(lists), SAVED * LEFT))
        for i, words in enumerate(lists):
            if words:
                counts[i] = np.bincount(np.fromiter(map(known.__getitem__, words), np.int64, len(words)), minlength=SAVED * LEFT)
        out = [batch.column(0), pa.array(counts.sum(1).astype(np.int64)), pa.array(counts @ model.evidence), pa.array(model.scores(counts))]
        yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_windows", "evidence", "score"])


def score_toxicity(docs: DataFrame, model: Toxicity | float) -> DataFrame:
    """doc_id, n_windows, evidence and score (0 to 1, higher: toxic likelier) of every row of
    docs (doc_id long, text string; other columns are left out, whatever their names).

    A null or empty text has no window and the score of no evidence. A repeated row is
    scored each time; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if isinstance(model, float):
        return rows.select("doc_id", F.lit(0).cast("long").alias("n_windows"), F.lit(0.0).alias("evidence"), F.lit(model).alias("score"))
    small_batches(docs.sparkSession)
    return rows.mapInArrow(lambda batches: _scored(batches, model), "doc_id long, n_windows long, evidence double, score double")


def classify_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; documents whose crc32 of doc_id
    leaves 1 when divided by 3 are held out: their labels take no part. A null doc_id is
    not held out, and has no label."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    scored = score_toxicity(docs, fit_toxicity(docs, labels, fold != 1))
    return scored.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

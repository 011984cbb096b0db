"""A quality classifier by co-training (Blum and Mitchell, 1998).

Two views of a document are judged apart: its text (marks, letters, words and lines) and
its metadata (language, source, lengths). Each view has a logistic classifier. In each
round the two score all unlabelled documents, and what one is sure of is a
pseudo-labelled example of the other. The views are calibrated on labelled rows that
neither was trained on, and their log odds are added up for the score of all documents.

Labelled documents are a bounded sample, the FIT_ROWS of least hash, whose features come
to the driver. The features of all unlabelled ones are a table in the shared folder; each
Newton step adds up gradient and Hessian by partition, and these sums alone reach the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import settle, small_batches, shielded
from .text_arrays import byte_runs, words

FIT_ROWS, ROUNDS = 20_000, 4
#: A view is sure of an unlabelled document from this probability on.
SURE = 0.97
#: Weight of a pseudo-label; a label has 1.
PSEUDO_WEIGHT = 0.5
#: Partitions whose sums come to the driver as they are; of more, groups are added up first.
DIRECT_SUMS = 64
#: Share of the labelled rows held back for calibration.
HELD_BACK = 0.3
#: A document is kept from this probability of good quality on.
KEEP_FROM = 0.5
SOURCE_CELLS = 64

# Classes of bytes: letters, capitals, digits, space, line end, others above ASCII, and each ASCII mark for itself.
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[32], _CLASS[10], _CLASS[128:] = 0, 1, 2, 3, 4, 5
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_MARKS] = 6 + np.arange(len(_MARKS))
N_CLASSES = 6 + len(_MARKS)
#: Neighbouring classes counted in pairs: the first six, and all marks as one.
N_PAIRS = 7 * 7
TEXT_FEATURES = N_CLASSES + N_PAIRS + 5
META_FEATURES = 4 + 16 + SOURCE_CELLS


def text_features(column: pa.Array) -> np.ndarray:
    """A row of TEXT_FEATURES for each text; a null one is an empty one."""
    rows = []
    for first, last, data, offsets in byte_runs(column):
        n = last - first
        of = np.repeat(np.arange(n), np.diff(offsets))
        kind = _CLASS[data]
        size = np.maximum(np.diff(offsets), 1)[:, None]
        single = np.bincount(of * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, -1) / size
        few = np.minimum(kind, 6)
        inside = of[1:] == of[:-1]
        pairs = np.bincount((of[1:] * N_PAIRS + few[:-1] * 7 + few[1:])[inside], minlength=n * N_PAIRS).reshape(n, -1) / size
        _, hashes, index = words(data, offsets)
        n_words = np.diff(index)
        kinds = np.array([len(np.unique(hashes[a:b])) for a, b in zip(index[:-1], index[1:], strict=True)])
        chars = np.diff(offsets) - np.bincount(of[(data & 0xC0) == 0x80], minlength=n)
        lines = np.bincount(of[data == 10], minlength=n) + 1
        more = np.stack([np.log1p(n_words), kinds / np.maximum(n_words, 1), chars / np.maximum(n_words, 1) / 10, np.log1p(n_words / lines), (n_words == 0) * 1.0], 1)
        rows.append(np.concatenate([np.sqrt(single), np.sqrt(pairs), more], 1))
    return np.concatenate(rows) if rows else np.zeros((0, TEXT_FEATURES))


def meta_features(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """A row of META_FEATURES: log length, nulls, and cells of language and source."""
    n = len(lang)
    out = np.zeros((n, META_FEATURES))
    chars = np.array(n_chars.cast(pa.float64()).fill_null(0.0), float)
    out[:, 0], out[:, 1] = np.log1p(np.maximum(chars, 0)) / 5, (np.log1p(np.maximum(chars, 0)) / 5) ** 2
    for at, (values, cells, start) in enumerate(((lang, 16, 4), (source, SOURCE_CELLS, 20))):
        for i, x in enumerate(values.to_pylist()):
            if x is None:
                out[i, 2 + at] = 1
            else:
                out[i, start + zlib.crc32(str(x).encode()) % cells] = 1
    return out


@dataclass
class Logistic:
    """A logistic classifier over standardised features, and its calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.slope * (self.standard(x) @ self.weights[1:] + self.weights[0]) + self.shift


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def newton_sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Gradient, then Hessian row by row, of the log likelihood."""
    p = probability(x @ w)
    return np.concatenate([x.T @ (weight * (y - p)), ((x * (weight * p * (1 - p))[:, None]).T @ x).ravel()])


def newton_step(w: np.ndarray, sums: np.ndarray, ridge: float) -> tuple[np.ndarray, bool]:
    """The next weights, and whether they are the last."""
    hold = np.full(len(w), ridge)
    hold[0] = 1e-3
    step = np.linalg.solve(sums[len(w) :].reshape(len(w), -1) + np.diag(hold), sums[: len(w)] - hold * w)
    return w + step * min(1.0, 4 / max(1e-9, np.abs(step).max())), bool(np.abs(step).max() < 1e-6)


def newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(25):
        w, last = newton_step(w, newton_sums(x, y, weight, w), ridge)
        if last:
            break
    return w


def moments(x: np.ndarray, y: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Number of rows, sums and sums of squares about the centre."""
    x = x - centre
    return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])


def view_sums(x: np.ndarray, y: np.ndarray, view: Logistic, weight: float) -> np.ndarray:
    z = view.standard(x)
    return newton_sums(np.concatenate([np.ones((len(z), 1)), z], 1), y, np.full(len(z), weight), view.weights)


def calibrate(view: Logistic, x: np.ndarray, y: np.ndarray) -> None:
    """Platt scaling with smoothed labels."""
    m = view.margin(x)
    good, bad = y.sum(), (1 - y).sum()
    soft = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    shift, slope = newton(np.stack([np.ones(len(m)), m], 1), soft, np.ones(len(m)), 1e-3)
    view.slope, view.shift = float(slope), float(shift)


@dataclass
class CoTrained:
    """Both views and the log odds of a good document before any is seen; views is empty
    where there was nothing to learn from, and then all documents are good."""

    views: list[Logistic]
    prior: float

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by text, by metadata and by both."""
        if not self.views:
            return (np.ones(len(text)),) * 3
        a, b = self.views[0].margin(text), self.views[1].margin(meta)
        return tuple(1 / (1 + np.exp(-np.clip(m, -30, 30))) for m in (a, b, a + b - self.prior))


def pseudo_labels(text: np.ndarray, meta: np.ndarray, past: list[list[Logistic]]) -> list[np.ndarray]:
    """Of each view, the label that the other gave in the first round it was sure; NaN without."""
    given = [np.full(len(text), np.nan), np.full(len(text), np.nan)]
    for views in past:
        for v, x in enumerate((text, meta)):
            p = probability(views[v].margin(x))
            sure = (np.maximum(p, 1 - p) >= SURE) & np.isnan(given[1 - v])
            given[1 - v][sure] = (p[sure] >= 0.5) * 1.0
    return given


Sums = Callable[[np.ndarray, np.ndarray], np.ndarray]


class Pool:
    """Features of all unlabelled documents: table x of binary rows."""

    def __init__(self, table: DataFrame):
        self.table, self.parts = table, table.rdd.getNumPartitions()

    def sums(self, past: list[list[Logistic]], tasks: list[Sums | None]) -> list[np.ndarray | float]:
        """What the task of each view gives for its pseudo-labelled rows, added up."""

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: list[np.ndarray | None] = [None for _ in tasks]
            for batch in batches:
                x = _matrix(batch.column(0).to_pylist())
                both = x[:, :TEXT_FEATURES], x[:, TEXT_FEATURES:]
                for v, (task, y) in enumerate(zip(tasks, pseudo_labels(*both, past), strict=True)):
                    some = np.flatnonzero(~np.isnan(y))
                    if task and len(some):
                        more = task(both[v][some], y[some])
                        total[v] = more if total[v] is None else total[v] + more
            part = TaskContext.get().partitionId()
            yield _sum_rows([(part, v, x) for v, x in enumerate(total) if x is not None])

        def add_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
            yield _sum_rows([(rows[0][0], v, sum(np.frombuffer(x) for _, w, x in rows if w == v)) for v in sorted({r[1] for r in rows})])

        out = self.table.mapInArrow(add, _SUMS)
        if self.parts > DIRECT_SUMS:
            groups = int(self.parts**0.5)
            out = out.repartition(groups, F.pmod("part", F.lit(groups))).mapInArrow(add_again, _SUMS)
        total: list[np.ndarray | float] = [0.0 for _ in tasks]
        for row in sorted(out.collect(), key=lambda r: (r.part, r.view)):
            total[row.view] = total[row.view] + np.frombuffer(row.sums)
        return total


_SUMS = "part int, view int, sums binary"


def _sum_rows(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    columns = pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2].tobytes() for r in rows], pa.binary())
    return pa.RecordBatch.from_arrays(list(columns), names=["part", "view", "sums"])


def fit_views(labelled: list[tuple[np.ndarray, np.ndarray]], pool: Pool | None, past: list[list[Logistic]]) -> list[Logistic]:
    """Both views, from the labelled rows and all that the views of the past were sure of;
    Newton's method starts at the last of these."""
    empty: list[np.ndarray | float] = [0.0, 0.0]
    centres = [x.mean(0) for x, _ in labelled]
    others = pool.sums(past, [partial(moments, centre=c) for c in centres]) if pool and past else empty
    views = []
    for v, ((x, y), centre, more) in enumerate(zip(labelled, centres, others, strict=True)):
        n, first, second = np.split(moments(x, y, centre) + more, [1, 1 + len(centre)])
        mean, scale = centre + first / n, np.sqrt(np.maximum(second / n - (first / n) ** 2, 0))
        scale[scale < 1e-9] = 1.0
        weights = np.zeros(len(centre) + 1)
        if past:
            before = past[-1][v]
            weights[1:] = before.weights[1:] * scale / before.scale
            weights[0] = before.weights[0] + ((mean - before.mean) / before.scale) @ before.weights[1:]
        views.append(Logistic(mean, scale, weights))
    going = [True, True]
    for _ in range(25):
        tasks = [partial(view_sums, view=view, weight=PSEUDO_WEIGHT) if go else None for view, go in zip(views, going, strict=True)]
        others = pool.sums(past, tasks) if pool and past else empty
        for v, view in enumerate(views):
            if going[v]:
                view.weights, last = newton_step(view.weights, view_sums(*labelled[v], view, 1.0) + others[v], 1.0)
                going[v] = not last
        if not any(going):
            break
    return views


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool: Callable[[], Pool | None], rounds: int = ROUNDS, seed: int = 5) -> CoTrained:
    """pool is asked for where there is something to learn from."""
    if len(np.unique(y)) < 2:
        return CoTrained([], 0.0)
    turn = np.random.default_rng(seed).permutation(len(y))
    held = turn[: int(len(y) * HELD_BACK)]
    train = turn[len(held) :]
    if len(np.unique(y[held])) < 2 or len(np.unique(y[train])) < 2:
        held = train = turn
    rest = pool() if rounds else None
    past: list[list[Logistic]] = []
    for _ in range(rounds + 1 if rest else 1):
        views = fit_views([(x[train], y[train]) for x in (text, meta)], rest, past)
        for view, x in zip(views, (text, meta), strict=True):
            calibrate(view, x[held], y[held])
        past.append(views)
    return CoTrained(past[-1], float(np.log(y[held].mean() / (1 - y[held].mean()))))


def _features(docs: DataFrame) -> DataFrame:
    """doc_id, y -> doc_id, y, features of both views as bytes."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.concatenate([text_features(batch.column(2)), meta_features(*batch.columns[3:])], 1).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "y", "x"])

    return docs.select("doc_id", "y", "text", "lang", "source", "n_chars").mapInArrow(features, "doc_id long, y int, x binary")


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<f4").reshape(len(rows), TEXT_FEATURES + META_FEATURES).astype(float)


def _gathered(found: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = found.groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("one")).select("doc_id", "one.*").toPandas().sort_values("doc_id")
    x = _matrix(list(rows["x"]))
    return x[:, :TEXT_FEATURES], x[:, TEXT_FEATURES:], rows["y"].to_numpy(float)


def unlabelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Features x of every document without a label, those without an id among them."""
    found = _features(docs.withColumn("y", F.lit(None).cast("int"))).select("doc_id", "x")
    # null ids are dealt out by their features
    found = found.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("x")).otherwise(F.lit(0)))
    return settle(found.join(labels.select("doc_id", F.lit(0).cast("long").alias("spread")), ["doc_id", "spread"], "left_anti").select("x"))


def train_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS) -> CoTrained:
    """Fit on the labelled documents and on all unlabelled ones that a view is sure of.
    Labels that are null or other than 0 and 1, or of documents that are not there, are
    left out; an id labelled twice counts once, as bad if one label says so."""
    small_batches(docs.sparkSession)
    docs = _typed(docs)
    labels = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    labels = labels.groupBy("doc_id").agg(F.min("y").alias("y"))
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # the sample is bounded by its limit
    text, meta, y = _gathered(_features(docs.join(F.broadcast(chosen), "doc_id")))
    return co_train(text, meta, y, lambda: Pool(unlabelled(docs, labels)), rounds)


def _typed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text", "lang", "source", F.col("n_chars").cast("long"))


def score_quality(docs: DataFrame, model: CoTrained, given: list[str] | None = None) -> DataFrame:
    """docs' columns `given` (doc_id, if none are named), and text_score, meta_score, score, keep,
    which `given` must not name. Nulls, repeated rows and empty tables as in classify_quality."""
    small_batches(docs.sparkSession)
    given = given or ["doc_id"]
    own = [F.col(c).alias(f"given_{i}") for i, c in enumerate(given)]
    rows = docs.select("text", "lang", "source", F.col("n_chars").cast("long"), *own)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_features(batch.column(0)), meta_features(*batch.columns[1:4])
            if batch.num_rows:
                scores = model.scores(*(a.astype("<f4").astype(float) for a in x))
                columns = [*batch.columns[4:], *(pa.array(s) for s in scores), pa.array(scores[2] >= KEEP_FROM)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[4:], "text_score", "meta_score", "score", "keep"])

    schema = "".join(f"`given_{i}` {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(given))
    out = rows.mapInArrow(score, f"{schema}text_score double, meta_score double, score double, keep boolean")
    return out.select(*(F.col(f"given_{i}").alias(c) for i, c in enumerate(given)), "text_score", "meta_score", "score", "keep")


@shielded("doc_id", "text", "lang", "source", "n_chars")
def good_documents(docs: DataFrame, labels: DataFrame, **how: int) -> DataFrame:
    """The rows of docs, all columns whatever their names, that classify_quality would keep."""
    return score_quality(docs, train_quality(docs, labels, **how), docs.columns).filter("keep").select(*docs.columns)


def classify_quality(docs: DataFrame, labels: DataFrame, **how: int) -> DataFrame:
    """Score all documents after co-training on the labelled ones.

    docs: doc_id, text, lang, source, n_chars; labels: doc_id, quality; other columns are
    left out. One row per input row of docs: doc_id, text_score, meta_score, score (the
    probability of good quality), keep. Null columns are values of their own, a null text
    an empty one; repeated rows have equal scores; without labels of both kinds every
    document is kept; an empty table gives an empty result.
    """
    return score_quality(docs.withColumn("doc_id", F.col("doc_id").cast("long")), train_quality(docs, labels, **how))

"""Average precision of detections or tracks, from candidate pairs to one row of AP and AR
for each category, area range and threshold."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.boxes import box, intersection
from ..operators.masks import track_mask_iou
from ..operators.ordered import free_by_level, pass_over
from ..operators.tables import top_detections
from ..shared import settled

# IoU thresholds, area ranges of images and of tracks, recall points.
THRESHOLDS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)
IMAGE_AREAS = {"all": (0.0, 1e10), "small": (0.0, 32.0**2), "medium": (32.0**2, 96.0**2), "large": (96.0**2, 1e10)}
TRACK_AREAS = {"all": (0.0, 1e10), "small": (0.0, 128.0**2), "medium": (128.0**2, 256.0**2), "large": (256.0**2, 1e10)}
RECALL_POINTS = 100
#: Score steps within which detections are counted first, so that no category is one task's.
SCORE_STEPS = 1024
#: Rows of a step that one task counts.
STEP_ROWS = 100_000


def box_pairs(gt: DataFrame, dt: DataFrame, *keys: str) -> DataFrame:
    """Pairs of a key with their IoU; with a crowd the common part counts against the
    detection's own area alone."""
    a = gt.select(*keys, "ann_id", "iscrowd", *(F.col(c).alias(f"gt_{c}") for c in "xywh"))
    b = dt.select(*keys, "det_id", *(F.col(c).alias(f"dt_{c}") for c in "xywh"))
    both, own = intersection(box("gt_"), box("dt_")), F.col("dt_w") * F.col("dt_h")
    whole = F.when(F.col("iscrowd") == 1, own).otherwise(F.col("gt_w") * F.col("gt_h") + own - both)
    return a.join(b, list(keys)).select(*keys, "ann_id", "det_id", F.when(whole > 0, both / F.greatest(whole, F.lit(1e-300))).otherwise(0.0).alias("iou"))


def _bits(hit: Sequence[Column]) -> Column:
    """A whole number whose bits say which of the columns are true."""
    out = F.lit(0).cast("long")
    for i, c in enumerate(hit):
        out = out.bitwiseOR(F.when(c, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def ap_matches(gt: DataFrame, dt: DataFrame, pairs: DataFrame, keys: Sequence[str], areas: dict[str, tuple[float, float]] = IMAGE_AREAS, thresholds: Sequence[float] = THRESHOLDS, max_dets: int = 100) -> tuple[DataFrame, DataFrame]:
    """Greedy matching for every area range and threshold, its levels.

    gt: keys, ann_id, area, iscrowd; dt: keys, det_id, score, area; pairs: keys, ann_id,
    det_id, iou. Returns (dt rows: keys, det_id, score and, by the bits of their levels, tps and
    fps; gt rows: keys, ann_id and, by the bits of the area ranges, ignored). Levels are numbered
    area range by area range. Ground truth that is a crowd or outside the range is ignored, and
    so are detections that take one, or that take none and are outside the range.
    """
    keys, n = list(keys), len(thresholds)
    if len(areas) * n > 62:
        raise ValueError("more than 62 pairs of area range and threshold")
    best = dt.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "det_id"))).filter(F.col("rank") <= max_dets).drop("rank")
    outside = [(F.col("area") < lo) | (F.col("area") > hi) for lo, hi in areas.values()]
    # an area range as the bits of its levels
    spread = [F.lit(((1 << n) - 1) << i * n).cast("long") for i in range(len(areas))]

    def levels(of: Sequence[Column]) -> Column:
        out = F.lit(0).cast("long")
        for c, bits in zip(of, spread, strict=True):
            out = out.bitwiseOR(F.when(c, bits).otherwise(F.lit(0).cast("long")))
        return out

    ranged = gt.select(*keys, "ann_id", "iscrowd", *(((F.col("iscrowd") == 1) | c).alias(f"out{i}") for i, c in enumerate(outside)))
    out = [F.col(f"out{i}") for i in range(len(areas))]
    met = _bits([F.col("iou") >= t for _ in areas for t in thresholds])
    rows = pairs.filter(F.col("iou") >= min(thresholds)).select(*keys, "ann_id", "det_id", "iou", met.alias("met"))
    rows = rows.join(best.select(*keys, "det_id", "score"), [*keys, "det_id"]).join(ranged.select(*keys, "ann_id", (F.col("iscrowd") == 1).alias("free"), levels(out).alias("ignored")), [*keys, "ann_id"])
    found = free_by_level(rows, keys, "det_id", "ann_id", [F.desc("score"), "det_id", F.desc("iou"), F.desc("ann_id")])
    every = F.lit((1 << len(areas) * n) - 1).cast("long")
    every_dt = best.select(*keys, "det_id", "score", levels(outside).alias("outside")).join(found, [*keys, "det_id"], "left").na.fill(0, ["took", "took_ignored"])
    fps = every.bitwiseAND(F.bitwise_not(F.col("took").bitwiseOR(F.col("took_ignored")).bitwiseOR(F.col("outside"))))
    return every_dt.select(*keys, "det_id", "score", F.col("took").alias("tps"), fps.alias("fps")), ranged.select(*keys, "ann_id", _bits(out).alias("ignored"))


def precision_recall(rows: DataFrame, by: Sequence[str], order: Sequence[str | Column], step_rows: int = STEP_ROWS) -> DataFrame:
    """rows (by, score, is_tp, is_fp) with the running numbers tp and fp in falling score
    (order breaks ties). Scores are counted by steps first, and a step of more than
    step_rows rows by cells of one score and a range of the first tie-breaking column, so
    that equal scores spread too; the running sum within a cell starts at the sum of what
    stands above it. The numbers are the same for every step_rows."""
    by = list(by)
    tie = F.col(order[0]) if isinstance(order[0], str) else order[0]
    rows = rows.withColumns({"step": F.floor(F.col("score") * SCORE_STEPS), "tie": tie.try_cast("double")})
    flags = {"tps": F.count_if("is_tp"), "fps": F.count_if("is_fp")}

    def above(w) -> list[Column]:
        return [F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"{c}_above") for c in flags]

    steps = rows.groupBy(*by, "step").agg(*(f.alias(c) for c, f in flags.items()), F.count("*").alias("n"), F.min("tie").alias("low"), F.max("tie").alias("high"))
    steps = steps.select(*by, "step", *above(Window.partitionBy(*by).orderBy(F.desc("step"))), (F.col("n") > step_rows).alias("full"), "low", "high")
    rows = rows.join(F.broadcast(steps), [*by, "step"])  # SCORE_STEPS rows of each curve at most
    part = F.floor(F.coalesce((F.col("tie") - F.col("low")) / (F.col("high") - F.col("low") + 1) * SCORE_STEPS, F.lit(-1.0)))
    rows = rows.withColumns({"cell_score": F.when(F.col("full"), F.col("score")).otherwise(0.0), "cell": F.when(F.col("full"), part).otherwise(0)}).drop("low", "high", "tie")
    keys = [*by, "step", "cell_score", "cell"]
    cells = rows.filter("full").groupBy(*keys).agg(*(f.alias(c) for c, f in flags.items()))
    cells = cells.select(*keys, *(c.alias(f"{n}_before") for n, c in zip(flags, above(Window.partitionBy(*by, "step").orderBy(F.desc("cell_score"), "cell")), strict=True)))
    rows = rows.join(cells.repartition(*keys), keys, "left")  # not by step: a full one would be one task's
    inside = Window.partitionBy(*keys).orderBy(F.desc("score"), *order).rowsBetween(Window.unboundedPreceding, 0)
    tp, fp = (F.col(f"{c}_above") + F.coalesce(f"{c}_before", F.lit(0)) + F.sum(F.col(f).cast("long")).over(inside) for c, f in (("tps", "is_tp"), ("fps", "is_fp")))
    return rows.withColumns({"tp": tp, "fp": fp}).drop("step", "full", "cell_score", "cell", *(f"{c}_{w}" for c in flags for w in ("above", "before")))


def average_precision(matched: DataFrame, counted: DataFrame, by: Sequence[str], order: Sequence[str | Column] = ("image_id", "det_id"), points: int = RECALL_POINTS) -> DataFrame:
    """by, area_range, threshold, n_gt, ap, ar: the mean over the recall points of the greatest
    precision from each point on, and the greatest recall; -1 without ground truth."""
    by = [*by, "area_range"]
    n_gt = counted.groupBy(*by).agg(F.count_if("counted").alias("n_gt"))
    curve = precision_recall(matched.filter("is_tp or is_fp"), [*by, "threshold"], order).filter("is_tp").join(F.broadcast(n_gt), by).filter("n_gt > 0")
    # a true positive holds for all recall points up to its own
    curve = curve.groupBy(*by, "threshold", F.floor(F.col("tp") * points / F.col("n_gt")).alias("upto")).agg(F.max(F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.max("tp").alias("tp"))
    return _area_under(curve, n_gt.join(matched.select("threshold").distinct()), by, points)


def _area_under(curve: DataFrame, grid: DataFrame, by: list[str], points: int) -> DataFrame:
    """average_precision rows of the grid (by, n_gt, threshold) from the greatest precision and
    number of true positives up to each recall point (curve: by, threshold, upto, precision, tp)."""
    later = Window.partitionBy(*by, "threshold").orderBy(F.desc("upto")).rowsBetween(Window.unboundedPreceding, 0)
    prior = F.coalesce(F.lag("upto").over(Window.partitionBy(*by, "threshold").orderBy("upto")), F.lit(-1))
    curve = curve.withColumns({"best": F.max("precision").over(later), "wide": F.col("upto") - prior})
    sums = curve.groupBy(*by, "threshold").agg(F.sum(F.col("best") * F.col("wide")).alias("area"), F.max("tp").alias("tp"))
    out = grid.join(sums, [*by, "threshold"], "left")
    there = F.col("n_gt") > 0
    ap = F.when(there, F.coalesce(F.col("area") / (points + 1), F.lit(0.0))).otherwise(-1.0)
    ar = F.when(there, F.coalesce(F.col("tp"), F.lit(0)) / F.greatest("n_gt", F.lit(1))).otherwise(-1.0)
    return out.select(*by, "threshold", "n_gt", ap.alias("ap"), ar.alias("ar"))


def precision_by_level(matched: DataFrame, gt: DataFrame, by: str, order: Sequence[str], areas: dict[str, tuple[float, float]] = IMAGE_AREAS, thresholds: Sequence[float] = THRESHOLDS, points: int = RECALL_POINTS, step_rows: int = STEP_ROWS) -> DataFrame:
    """average_precision of ap_matches rows. A detection stays one row with the bits of its
    levels: rows are dealt by cells as in precision_recall, and the running numbers of all levels
    are counted cell by cell, from what stands above the cell."""
    n = len(areas) * len(thresholds)
    sides = ("tps", "fps")
    rows = settled(matched.filter(f"{by} is not null and score is not null and (tps <> 0 or fps <> 0)").select(by, "score", *order, *sides))
    rows = rows.withColumns({"step": F.floor(F.col("score") * SCORE_STEPS), "tie": F.col(order[0]).try_cast("double")})
    full = rows.groupBy(by, "step").agg(F.count("*").alias("n"), F.min("tie").alias("low"), F.max("tie").alias("high")).filter(F.col("n") > step_rows).drop("n")
    rows = rows.join(F.broadcast(full.withColumn("full", F.lit(True))), [by, "step"], "left")
    part = F.floor(F.coalesce((F.col("tie") - F.col("low")) / (F.col("high") - F.col("low") + 1) * SCORE_STEPS, F.lit(-1.0)))
    rows = rows.withColumns({"cell_score": F.when(F.col("full"), F.col("score")).otherwise(0.0), "cell": F.when(F.col("full"), part).otherwise(0)})
    cell = [by, "step", "cell_score", "cell"]
    names = [f"{c}{i}" for c in sides for i in range(n)]
    cells = rows.groupBy(*cell).agg(*(F.sum(F.shiftright(c, i).bitwiseAND(F.lit(1).cast("long"))).alias(f"{c}{i}") for c in sides for i in range(n)))
    inner = Window.partitionBy(by, "step").orderBy(F.desc("cell_score"), "cell").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(by).orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    steps = cells.groupBy(by, "step").agg(*(F.sum(c).alias(c) for c in names))
    steps = steps.select(by, "step", F.array(*(F.coalesce(F.sum(c).over(outer), F.lit(0)) for c in names)).alias("above"))
    within = cells.select(*cell, F.array(*(F.coalesce(F.sum(c).over(inner), F.lit(0)) for c in names)).alias("within"))
    n_gt = gt.groupBy(by).agg(*(F.count_if(F.shiftright("ignored", i).bitwiseAND(F.lit(1).cast("long")) == 0).alias(f"n{i}") for i in range(len(areas))))
    counted = F.array(*(F.col(f"n{i}") for i in range(len(areas)) for _ in thresholds))
    heads = within.join(steps, [by, "step"]).withColumn("start", F.zip_with("above", "within", lambda x, y: x + y)).join(F.broadcast(n_gt), by, "left").na.fill(0).select(*cell, F.concat("start", counted).alias("start"))
    null = F.lit(None)
    heads = heads.select(*cell, null.cast("double").alias("score"), *(null.cast(matched.schema[c].dataType).alias(c) for c in order), *(null.cast("long").alias(c) for c in sides), "start")
    both = heads.unionByName(rows.select(*cell, "score", *order, *sides, F.lit(None).cast("array<bigint>").alias("start")))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        start = batch.column(batch.num_columns - 1)
        tps, fps = (batch.column(i).fill_null(0).to_numpy() for i in (4, 5))
        key, out = batch.column(0), []
        cuts = [*np.flatnonzero(start.is_valid().to_numpy(zero_copy_only=False)), batch.num_rows]
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            head = np.array(start[int(first)].as_py(), np.int64)
            t, f = tps[first + 1 : last], fps[first + 1 : last]
            for i in range(n):
                hit = (t >> i) & 1 == 1
                if not head[2 * n + i] or not hit.any():
                    continue
                tp, fp = (head[j * n + i] + np.cumsum((side >> i) & 1) for j, side in enumerate((t, f)))
                tp, fp = tp[hit], fp[hit]
                upto = np.floor(tp * points / head[2 * n + i]).astype(np.int64)
                at = np.flatnonzero(np.r_[True, np.diff(upto) > 0])
                out.append((key[int(first)].as_py(), np.full(len(at), i), upto[at], np.maximum.reduceat(tp / (tp + fp), at), tp[np.r_[at[1:] - 1, len(tp) - 1]]))
        sizes = [len(o[1]) for o in out]
        columns = [pa.array([o[0] for o, k in zip(out, sizes, strict=True) for _ in range(k)], batch.schema.field(0).type)]
        columns += [pa.array(np.concatenate([o[j] for o in out]) if out else np.zeros(0, kind)) for j, kind in ((1, np.int64), (2, np.int64), (3, np.float64), (4, np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=[by, "level", "upto", "precision", "tp"])

    kind = matched.schema[by].dataType.simpleString()
    curve = pass_over(both, cell, [F.col("start").isNull(), F.desc("score"), *order], [*cell, *sides, "start"], count, f"`{by}` {kind}, level long, upto long, precision double, tp long")
    levels = F.array(*(F.struct(F.lit(a).alias("area_range"), F.lit(t).alias("threshold")) for a in areas for t in range(len(thresholds))))
    curve = curve.groupBy(by, "level", "upto").agg(F.max("precision").alias("precision"), F.max("tp").alias("tp"))
    curve = curve.withColumn("at", F.element_at(levels, F.col("level").cast("int") + 1)).select(by, "at.*", "upto", "precision", "tp")
    ranges = F.array(*(F.struct(F.lit(a).alias("area_range"), F.col(f"n{i}").alias("n_gt")) for i, a in enumerate(areas)))
    grid = n_gt.select(by, F.explode(ranges).alias("r")).select(by, "r.*", F.explode(F.sequence(F.lit(0), F.lit(len(thresholds) - 1))).alias("threshold"))
    return _area_under(curve, grid, [by, "area_range"], points)


def mean_precision(rows: DataFrame, *by: str) -> DataFrame:
    """Means of average_precision rows over categories and thresholds that are defined: by,
    area_range, ap, ap50, ap75, ar; -1 where none is."""
    def mean(c: str, at: int | None = None) -> Column:
        ok = (F.col(c) > -1) & (F.lit(True) if at is None else F.col("threshold") == at)
        return F.coalesce(F.avg(F.when(ok, F.col(c))), F.lit(-1.0))

    return rows.groupBy(*by, "area_range").agg(mean("ap").alias("ap"), mean("ap", 0).alias("ap50"), mean("ap", 5).alias("ap75"), mean("ar").alias("ar"))


def rarity_bucket_average(rows: DataFrame, bucket: str) -> DataFrame:
    """Unweighted mean over the buckets of their mean precision."""
    each = mean_precision(rows, bucket)
    return each.groupBy("area_range").agg(*(F.avg(F.when(F.col(c) > -1, F.col(c))).alias(c) for c in ("ap", "ap50", "ap75", "ar")), F.count("*").alias("n_buckets"))


def evaluate_ap(gt: DataFrame, dt: DataFrame, positive_split: bool = False, max_dets: int = 100) -> DataFrame:
    """AP and AR of detections of images, by category, area range and threshold."""
    keys = ["image_id", "category_id"]
    if positive_split:
        dt = dt.join(gt.select(*keys).distinct(), keys, "left_semi")
    gt, dt = (df.withColumn("area", F.col("w") * F.col("h")) for df in (gt, dt))
    return precision_by_level(*ap_matches(gt, dt, box_pairs(gt, dt, *keys), keys, max_dets=max_dets), "category_id", ["image_id", "det_id"])


def track_pairs(gt: DataFrame, dt: DataFrame, *keys: str) -> DataFrame:
    """Pairs of tracks of a key with their IoU over all frames: keys, ann_id, det_id, iou."""
    area = F.sum(F.col("w") * F.col("h"))
    left = gt.select(*keys, "frame_idx", F.col("track_id").alias("ann_id"), *(F.col(c).alias(f"gt_{c}") for c in "xywh"))
    right = dt.select(*keys, "frame_idx", F.col("track_id").alias("det_id"), *(F.col(c).alias(f"dt_{c}") for c in "xywh"))
    both = left.join(right, [*keys, "frame_idx"]).groupBy(*keys, "ann_id", "det_id").agg(F.sum(intersection(box("gt_"), box("dt_"))).alias("both")).filter("both > 0")
    both = both.join(gt.groupBy(*keys, F.col("track_id").alias("ann_id")).agg(area.alias("gt_area")), [*keys, "ann_id"])
    both = both.join(dt.groupBy(*keys, F.col("track_id").alias("det_id")).agg(area.alias("dt_area")), [*keys, "det_id"])
    return both.select(*keys, "ann_id", "det_id", (F.col("both") / (F.col("gt_area") + F.col("dt_area") - F.col("both"))).alias("iou"))


def evaluate_track_map(gt: DataFrame, dt: DataFrame, by_category: bool = True, max_dets: int = 100, masks: bool = False) -> DataFrame:
    """AP and AR of tracks. gt, dt: video_id, category_id, track_id, frame_idx, x, y, w, h, and
    dt a score, one for a track; with masks, runs (col, row_start, run_len) instead of boxes.
    Without by_category all pairs of video and category are one class (phrases):
    category_id is then 1 in the result."""
    keys = ["video_id", "category_id"]
    if masks:
        pairs = track_mask_iou(gt, dt, tuple(keys)).withColumnsRenamed({"gt_track": "ann_id", "dt_track": "det_id"})
        gt, dt = (df.groupBy(*keys, "track_id", "frame_idx", *more).agg(F.sum("run_len").alias("size")) for df, more in ((gt, []), (dt, ["score"])))
        mean = F.avg("size").alias("area")
    else:
        pairs, mean = track_pairs(gt, dt, *keys), F.avg(F.col("w") * F.col("h")).alias("area")
    ann = gt.groupBy(*keys, F.col("track_id").alias("ann_id")).agg(mean).withColumn("iscrowd", F.lit(0))
    det = dt.groupBy(*keys, F.col("track_id").alias("det_id")).agg(mean, F.max("score").alias("score"))
    matched, counted = ap_matches(ann, det, pairs, keys, TRACK_AREAS, max_dets=max_dets)
    if not by_category:
        one = F.lit(1).cast("long")
        matched, counted = matched.withColumn("pair", F.col("category_id")).withColumn("category_id", one), counted.withColumn("category_id", one)
        return precision_by_level(matched, counted, "category_id", ["video_id", "pair", "det_id"], TRACK_AREAS)
    return precision_by_level(matched, counted, "category_id", ["video_id", "det_id"], TRACK_AREAS)


__all__ = ["average_precision", "evaluate_ap", "evaluate_track_map", "mean_precision", "precision_recall", "rarity_bucket_average", "top_detections"]

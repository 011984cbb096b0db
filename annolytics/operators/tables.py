"""Joins, filters, windows and set operations on annotation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.boxes import box, iou


def score_filter(df: DataFrame, threshold: float, strict: bool = False) -> DataFrame:
    return df.filter(F.col("score") > threshold if strict else F.col("score") >= threshold)


def drop_crowd(gt: DataFrame) -> DataFrame:
    return gt.filter("iscrowd = 0")


def positive_split(predictions: DataFrame, gt: DataFrame, *keys: str) -> DataFrame:
    """Predictions whose key has ground truth."""
    return predictions.join(gt.select(*keys), list(keys), "left_semi")


def candidate_pairs(gt: DataFrame, dt: DataFrame, *keys: str) -> DataFrame:
    """All pairs of one key, with their box IoU: keys, ann_id, det_id, iou."""
    a = gt.select(*keys, "ann_id", *(F.col(c).alias(f"gt_{c}") for c in "xywh"))
    b = dt.select(*keys, "det_id", *(F.col(c).alias(f"dt_{c}") for c in "xywh"))
    return a.join(b, list(keys)).select(*keys, "ann_id", "det_id", iou(box("gt_"), box("dt_")).alias("iou"))


def top_detections(dt: DataFrame, k: int, key: str = "image_id") -> DataFrame:
    """The k detections of highest score of each key, with their rank; k of 0 or less is off."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "det_id"))
    ranked = dt.withColumn("rank", rank)
    return ranked.filter(F.col("rank") <= k) if k > 0 else ranked


def relabel_contiguous(df: DataFrame, value: str, *keys: str) -> Column:
    return F.dense_rank().over(Window.partitionBy(*keys).orderBy(value)) - 1


def dedup_shards(predictions: DataFrame, key: str, shard: str) -> DataFrame:
    """For each key the rows of the first shard that has it."""
    return predictions.withColumn("first", F.min(shard).over(Window.partitionBy(key))).filter(F.col(shard) == F.col("first")).drop("first")


def confirm_tracks(frames: DataFrame, k: int) -> DataFrame:
    """frames: video_id, track_id, frame_idx, matched -> also streak (matched frames in a
    row, this one included) and confirmed (k in a row so far, at some time)."""
    order = Window.partitionBy("video_id", "track_id").orderBy("frame_idx")
    runs = frames.withColumn("island", F.sum(F.when(F.col("matched"), 0).otherwise(1)).over(order))
    inside = Window.partitionBy("video_id", "track_id", "island").orderBy("frame_idx").rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.withColumn("streak", F.sum(F.col("matched").cast("int")).over(inside))
    return runs.withColumn("confirmed", F.max("streak").over(order) >= k).drop("island")


def pair_universe(gt: DataFrame, predictions: DataFrame, *keys: str) -> DataFrame:
    """All keys of either side and whether each side has them."""
    a, b = gt.select(*keys).distinct().withColumn("in_gt", F.lit(1)), predictions.select(*keys).distinct().withColumn("in_dt", F.lit(1))
    return a.join(b, list(keys), "full").fillna(0, ["in_gt", "in_dt"])


def track_box_iou(gt: DataFrame, dt: DataFrame) -> DataFrame:
    """Spatio-temporal IoU of the tracks of one video and category: intersections of
    shared frames over all area of both."""
    keys = ["video_id", "category_id"]
    area = F.sum(F.col("w") * F.col("h"))
    a = gt.groupBy(*keys, "track_id").agg(area.alias("gt_area")).withColumnRenamed("track_id", "gt_track")
    b = dt.groupBy(*keys, "track_id").agg(area.alias("dt_area")).withColumnRenamed("track_id", "dt_track")
    left = gt.select(*keys, "frame_idx", F.col("track_id").alias("gt_track"), *(F.col(c).alias(f"gt_{c}") for c in "xywh"))
    right = dt.select(*keys, "frame_idx", F.col("track_id").alias("dt_track"), *(F.col(c).alias(f"dt_{c}") for c in "xywh"))
    from ..functions.boxes import intersection

    both = left.join(right, [*keys, "frame_idx"]).groupBy(*keys, "gt_track", "dt_track").agg(F.sum(intersection(box("gt_"), box("dt_"))).alias("both")).filter("both > 0")
    out = both.join(a, [*keys, "gt_track"]).join(b, [*keys, "dt_track"])
    return out.select(*keys, "gt_track", "dt_track", (F.col("both") / (F.col("gt_area") + F.col("dt_area") - F.col("both"))).alias("iou"))


def mask_boxes(runs: DataFrame) -> DataFrame:
    """Area and inclusive box of each mask of column-wise runs."""
    return runs.groupBy("image_id", "ann_id").agg(F.sum("run_len").alias("area"), F.min("col").alias("x0"), F.min("row_start").alias("y0"), F.max("col").alias("x1"), F.max(F.col("row_start") + F.col("run_len") - 1).alias("y1"))


def mask_overlaps(runs: DataFrame) -> DataFrame:
    """Common pixels of the masks of an image, smaller id first; runs meet by column."""
    a = runs.select("image_id", "col", F.col("ann_id").alias("a"), F.col("row_start").alias("a0"), (F.col("row_start") + F.col("run_len")).alias("a1"))
    b = runs.select("image_id", "col", F.col("ann_id").alias("b"), F.col("row_start").alias("b0"), (F.col("row_start") + F.col("run_len")).alias("b1"))
    met = a.join(b, ["image_id", "col"]).filter("a < b and a0 < b1 and b0 < a1")
    return met.groupBy("image_id", "a", "b").agg(F.sum(F.least("a1", "b1") - F.greatest("a0", "b0")).alias("pixels"))


def count_metrics(frames: DataFrame) -> DataFrame:
    return frames.groupBy("video_id").agg(F.count("*").alias("n_boxes"), F.countDistinct("track_id").alias("n_ids"), F.countDistinct("frame_idx").alias("n_frames"))


def count_both(gt: DataFrame, dt: DataFrame) -> DataFrame:
    """Boxes and ids of either side and frames of both, for each video and, with a null
    video_id, summed over all."""
    sides = gt.select("video_id", "frame_idx", F.col("track_id").alias("gt_id"), F.lit(None).cast("long").alias("dt_id"), F.lit(1).alias("is_gt"))
    sides = sides.unionByName(dt.select("video_id", "frame_idx", F.lit(None).cast("long").alias("gt_id"), F.col("track_id").alias("dt_id"), F.lit(0).alias("is_gt")))
    names = ("dets", "gt_dets", "ids", "gt_ids", "frames")
    values = (F.count_if(F.col("is_gt") == 0), F.count_if(F.col("is_gt") == 1), F.countDistinct("dt_id"), F.countDistinct("gt_id"), F.countDistinct("frame_idx"))
    each = sides.groupBy("video_id").agg(*(v.alias(n) for n, v in zip(names, values, strict=True)))
    return each.unionByName(each.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names)).withColumn("video_id", F.lit(None).cast("long")))


def mean_target_iou(images: DataFrame, targets: DataFrame, matched: DataFrame) -> DataFrame:
    """For each image the sum of IoU over its targets that are not empty, a target without
    a match counting 0, by their number; 1.0 without targets. matched: image_id, ann_id, iou,
    one row for a target at most."""
    full = targets.filter("w > 0 and h > 0").select("image_id", "ann_id").join(matched.select("image_id", "ann_id", "iou"), ["image_id", "ann_id"], "left")
    sums = full.groupBy("image_id").agg(F.count("*").alias("n_targets"), F.sum(F.coalesce("iou", F.lit(0.0))).alias("total"))
    out = images.select("image_id").distinct().join(sums, "image_id", "left")
    return out.select("image_id", F.coalesce("n_targets", F.lit(0)).alias("n_targets"), F.coalesce(F.col("total") / F.col("n_targets"), F.lit(1.0)).alias("mean_iou"))


def compact_history(turns: DataFrame, first: str, second: str) -> DataFrame:
    """The first two turns, and all from the last later assistant turn that holds both
    markers on."""
    match = (F.col("turn") > 1) & (F.col("role") == "assistant") & F.contains("text", F.lit(first)) & F.contains("text", F.lit(second))
    last = F.max(F.when(match, F.col("turn"))).over(Window.partitionBy("conv_id"))
    return turns.withColumn("last", last).filter("turn < 2 or turn >= last").drop("last")

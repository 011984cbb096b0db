"""Assignment joins: which prediction goes with which ground truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .ordered import assign, first_free, optimal_pairs

__all__ = ["assign", "associate", "filtered_assignment", "greedy_match", "one_to_many_match", "optimal_match"]


def optimal_match(pairs: DataFrame, group: str | Sequence[str], left: str, right: str, score: str, carry: Sequence[str] = ()) -> DataFrame:
    """The pairs of the 1:1 assignment of greatest total score within each group, with the
    columns `carry`. Pairs whose score is null or not above 0 add nothing and are never in it."""
    keys = [group] if isinstance(group, str) else list(group)
    return optimal_pairs(pairs, keys, left, right, score, list(carry))


def filtered_assignment(costs: DataFrame, group: str, row: str, target: str, cost: str, repeats: int = 1, limit: float = 1e8) -> DataFrame:
    """The pairs of the 1:1 assignment of least total cost among as many as possible; pairs
    that cost `limit` or more are not allowed. Each target may be taken `repeats` times."""
    copies = costs.filter(F.col(cost) < limit).withColumn("again", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    # a common addend above all costs makes more pairs better than cheaper ones
    total = F.sum(F.abs(F.col(cost))).over(Window.partitionBy(group)) + 1
    scored = copies.withColumn("gain", total - F.col(cost)).withColumn("place", F.struct(target, "again"))
    ids = scored.withColumn("place", F.dense_rank().over(Window.partitionBy(group).orderBy("place")).cast("long"))
    return optimal_pairs(ids, [group], row, "place", "gain", [target, cost]).select(group, row, target, cost)


def greedy_match(pairs: DataFrame, group: Sequence[str], thresholds: Sequence[float]) -> DataFrame:
    """Predictions by falling score (ties by det_id) each take, at every threshold, the free
    ground truth of greatest IoU (ties to the greater ann_id); what is to be ignored only
    where nothing else is left, and a crowd stays free.

    pairs: group, det_id, score, ann_id, iou, ignored, iscrowd. Returns group, threshold
    (its number), det_id, ann_id, ignored.
    """
    keys = list(group)
    levels = F.filter(F.array(*(F.when(F.col("iou") >= F.lit(t), F.lit(i)) for i, t in enumerate(thresholds))), lambda x: x.isNotNull())
    rows = pairs.withColumn("threshold", F.explode(levels)).withColumns({"ignored": F.col("ignored").cast("boolean"), "free": F.col("iscrowd").cast("boolean")})
    order = [F.desc("score"), "det_id", "ignored", F.desc("iou"), F.desc("ann_id")]
    return first_free(rows, [*keys, "threshold"], "det_id", "ann_id", "free", order, ["ignored"])


def one_to_many_match(pairs: DataFrame, group: str, n_queries: int, alpha: float = 0.3, top: int = 4, threshold: float = 0.4) -> DataFrame:
    """Pairs (group, query, target, prob, iou) whose merit alpha * prob + (1 - alpha) * iou is
    above the (1 - top / n_queries) quantile of its target and above the threshold."""
    rows = pairs.withColumn("merit", alpha * F.col("prob") + (1 - alpha) * F.col("iou"))
    cut = rows.groupBy(group, "target").agg(F.percentile("merit", F.lit(1 - top / n_queries)).alias("cut"))
    return rows.join(cut, [group, "target"]).filter((F.col("merit") > F.col("cut")) & (F.col("merit") > threshold)).drop("cut")


def associate(dets: DataFrame, tracks: DataFrame, pairs: DataFrame, iou: float = 0.5, track_iou: float = 0.5, new_score: float = 0.7, sure: float = 0.8, one_to_one: bool = False) -> DataFrame:
    """What becomes of the detections and tracks of each frame.

    dets: frame, det_id, score; tracks: frame, track_id, is_empty; pairs: frame, det_id,
    track_id, iou. One row for each fact: frame, kind, det_id, track_id. Kinds: `new` (score
    from new_score on and no track from iou on), `matched` (pair from iou on), `unmatched`
    (track that is not empty and has no detection from track_iou on; with one_to_one only
    that assigned to it counts), `empty` (track), `sure` (a detection that is not new, of
    score and best IoU from `sure` on, with its best track).
    """
    null = F.lit(None).cast("long")
    near = pairs.filter(F.col("iou") >= iou)
    new = dets.filter(F.col("score") >= new_score).join(near, ["frame", "det_id"], "left_anti").select("frame", F.lit("new").alias("kind"), "det_id", null.alias("track_id"))
    matched = near.select("frame", F.lit("matched").alias("kind"), "det_id", "track_id")
    chosen = optimal_match(pairs, "frame", "det_id", "track_id", "iou") if one_to_one else pairs
    full = tracks.filter(~F.col("is_empty"))
    unmatched = full.join(chosen.filter(F.col("iou") >= track_iou), ["frame", "track_id"], "left_anti").select("frame", F.lit("unmatched").alias("kind"), null.alias("det_id"), "track_id")
    empty = tracks.filter("is_empty").select("frame", F.lit("empty").alias("kind"), null.alias("det_id"), "track_id")
    best = pairs.groupBy("frame", "det_id").agg(F.max(F.struct("iou", (-F.col("track_id")).alias("minus"))).alias("best"))
    best = best.join(dets, ["frame", "det_id"]).filter((F.col("score") >= sure) & (F.col("best.iou") >= sure))
    best = best.join(new, ["frame", "det_id"], "left_anti").select("frame", F.lit("sure").alias("kind"), "det_id", (-F.col("best.minus")).alias("track_id"))
    return new.unionByName(matched).unionByName(unmatched).unionByName(empty).unionByName(best)

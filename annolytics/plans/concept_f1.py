"""Concept-level F1: how well phrases are found (image level) times how well their
objects are delimited (box level)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.masks import boundary_f_measure, mask_similarity, track_mask_iou
from ..operators.matching import optimal_match
from ..operators.tables import candidate_pairs, drop_crowd, score_filter

# IoU thresholds and the terms that keep denominators above 0.
THRESHOLDS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)
BOX_TERM, IMAGE_TERM, MEAN_TERM = 1e-4, 1e-6, 1e-9


def scored_pairs(gt: DataFrame, dt: DataFrame, runs: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """image_id, ann_id, det_id and IoU above 0 of boxes, or of the masks whose run tables of
    ground truth and of predictions are given."""
    if runs is None:
        return candidate_pairs(gt, dt, "image_id").filter("iou > 0")
    own = [r.join(df.select("image_id", F.col(i).alias("ann_id")), ["image_id", "ann_id"], "left_semi") for r, df, i in zip(runs, (gt, dt), ("ann_id", "det_id"), strict=True)]
    return mask_similarity(*own).select("image_id", F.col("a").alias("ann_id"), F.col("b").alias("det_id"), "iou")


def image_eval(images: DataFrame, gt: DataFrame, dt: DataFrame, least_score: float = 0.5, runs: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row for each image and threshold: tp, fp, fn of boxes, or of masks where the run
    tables of both sides are given; precision, recall and f1 of images with anything on either
    side; and il_tp, il_fp, il_fn, il_tn of the image."""
    gt, dt = drop_crowd(gt), score_filter(dt, least_score)
    return counted_eval(images, gt, dt, scored_pairs(gt, dt, runs))


def counted_eval(images: DataFrame, gt: DataFrame, dt: DataFrame, pairs: DataFrame) -> DataFrame:
    """image_eval of the pairs (image_id, ann_id, det_id, iou) of gt and dt."""
    matched = optimal_match(pairs, "image_id", "ann_id", "det_id", "iou")
    hits = matched.groupBy("image_id").agg(*(F.count_if(F.col("iou") >= t).alias(f"tp{i}") for i, t in enumerate(THRESHOLDS)))
    n_gt, n_dt = gt.groupBy("image_id").agg(F.count("*").alias("n_gt")), dt.groupBy("image_id").agg(F.count("*").alias("n_dt"))
    rows = images.select("image_id").join(n_gt, "image_id", "left").join(n_dt, "image_id", "left").join(hits, "image_id", "left").na.fill(0)
    levels = F.explode(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"tp{i}").alias("tp")) for i, t in enumerate(THRESHOLDS))))
    rows = rows.select("image_id", "n_gt", "n_dt", levels.alias("level")).select("image_id", "n_gt", "n_dt", "level.*")
    rows = rows.withColumns({"fp": F.col("n_dt") - F.col("tp"), "fn": F.col("n_gt") - F.col("tp")})
    precision, recall = F.col("tp") / (F.col("tp") + F.col("fp") + BOX_TERM), F.col("tp") / (F.col("tp") + F.col("fn") + BOX_TERM)
    f1 = 2 * precision * recall / (precision + recall + BOX_TERM)
    there, found = F.col("n_gt") > 0, F.col("n_dt") > 0
    rows = rows.withColumns({n: F.when(there | found, c) for n, c in (("precision", precision), ("recall", recall), ("f1", f1))})
    return rows.withColumns({"il_tp": there & found, "il_fp": ~there & found, "il_fn": there & ~found, "il_tn": ~there & ~found})


def concept_f1(rows: DataFrame) -> DataFrame:
    """Metrics of each threshold over image_eval rows."""
    found, there = F.col("n_dt") > 0, F.col("n_gt") > 0
    sums = {"tp": F.sum("tp"), "fp": F.sum("fp"), "fn": F.sum("fn"), "pos_fp": F.sum(F.when(there, F.col("fp")).otherwise(0)), "f1_sum": F.sum(F.when(there & found, F.col("f1")).otherwise(0.0)), "n_both": F.count_if(there & found)}
    sums |= {"il_tp": F.count_if(there & found), "il_fn": F.count_if(there & ~found), "il_fp": F.count_if(~there & found), "il_tn": F.count_if(~there & ~found)}
    out = rows.groupBy("threshold").agg(*(c.alias(n) for n, c in sums.items()))
    recall = F.col("tp") / (F.col("tp") + F.col("fn") + BOX_TERM)

    def precision(fp: str):
        return F.col("tp") / (F.col("tp") + F.col(fp) + BOX_TERM)

    def f1(fp: str):
        return 2 * precision(fp) * recall / (precision(fp) + recall + BOX_TERM)

    a, b, c, d = (F.col(x).cast("double") for x in ("il_tp", "il_fp", "il_fn", "il_tn"))
    mcc = (a * d - b * c) / (F.sqrt((a + b) * (a + c) * (d + b) * (d + c)) + IMAGE_TERM)
    il_precision, il_recall = a / (a + b + IMAGE_TERM), a / (a + c + IMAGE_TERM)
    out = out.withColumns({"precision": precision("fp"), "recall": recall, "positive_micro_precision": precision("pos_fp")})
    out = out.withColumns({"il_precision": il_precision, "il_recall": il_recall, "il_f1": 2 * il_precision * il_recall / (il_precision + il_recall + IMAGE_TERM), "il_fpr": b / (b + d + IMAGE_TERM)})
    out = out.withColumns({"micro_f1": f1("fp"), "positive_micro_f1": f1("pos_fp"), "positive_macro_f1": F.col("f1_sum") / F.greatest("n_both", F.lit(1)), "il_mcc": mcc})
    return out.withColumn("cgf1", F.col("positive_micro_f1") * F.col("il_mcc")).select("threshold", "tp", "fp", "fn", "precision", "recall", "micro_f1", "positive_micro_precision", "positive_micro_f1", "positive_macro_f1", "il_tp", "il_fp", "il_fn", "il_tn", "il_precision", "il_recall", "il_f1", "il_fpr", "il_mcc", "cgf1")


#: Metrics of boxes, which have a value for each threshold, and of images.
BOX_METRICS = ("cgf1", "precision", "recall", "micro_f1", "positive_macro_f1", "positive_micro_f1", "positive_micro_precision")
IMAGE_METRICS = ("il_precision", "il_recall", "il_f1", "il_fpr", "il_mcc")


def summarize(metrics: DataFrame) -> DataFrame:
    """One row over concept_f1 rows: box metrics as means over the thresholds, at 0.5 and
    at 0.75, and image metrics."""
    out = [F.avg(m).alias(m) for m in BOX_METRICS] + [F.max(m).alias(m) for m in IMAGE_METRICS]
    out += [F.max(F.when(F.col("threshold") == t, F.col(m))).alias(f"{m}_{round(100 * t)}") for t in (0.5, 0.75) for m in BOX_METRICS]
    return metrics.agg(*out)


def pair_f1(counts: DataFrame) -> DataFrame:
    """image_eval rows of pairs of video and category -> tp, fp, fn and f1 of each, as means over
    the thresholds and at 0.5 and 0.75; f1 is 1 where there is nothing on either side."""
    base = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    rows = counts.withColumn("f1", F.when(base > 0, 2 * F.col("tp") / F.greatest(base, F.lit(1))).otherwise(1.0))
    names = ("tp", "fp", "fn", "f1")
    out = [F.avg(c).alias(c) for c in names] + [F.max(F.when(F.col("threshold") == t, F.col(c))).alias(f"{c}_{round(100 * t)}") for t in (0.5, 0.75) for c in names]
    return rows.groupBy("image_id").agg(*out)


def track_eval(pairs: DataFrame, gt: DataFrame, dt: DataFrame, least_score: float = 0.5, masks: bool = False) -> DataFrame:
    """image_eval rows for pairs of video and category (image_id is the pair). pairs: pair_id,
    video_id, category_id; gt, dt: tracks as in track_pairs, or with masks their runs, dt
    with a score."""
    from .average_precision import track_pairs

    keys = ["video_id", "category_id"]
    kept = dt.filter(F.col("score") >= least_score)
    met = track_mask_iou(gt, kept, tuple(keys)).withColumnsRenamed({"gt_track": "ann_id", "dt_track": "det_id"}) if masks else track_pairs(gt, kept, *keys)
    named = pairs.select(*keys, F.col("pair_id").alias("image_id"))
    ids = [df.select(*keys, F.col("track_id").alias(i)).distinct().join(named, keys) for df, i in ((gt, "ann_id"), (kept, "det_id"))]
    return counted_eval(named, ids[0], ids[1], met.join(named, keys))


def evaluate_track_cgf1(gt: DataFrame, dt: DataFrame, declared: DataFrame, least_score: float = 0.5, masks: bool = False) -> tuple[DataFrame, DataFrame]:
    """Metrics over all pairs of video and category, declared negatives among them, and of each."""
    from ..operators.reshape import numbered_pairs

    rows = track_eval(numbered_pairs(gt, dt, declared), gt, dt, least_score, masks)
    return concept_f1(rows), pair_f1(rows)


def oracle_cgf1(images: DataFrame, annotators: list[DataFrame], dt: DataFrame, least_score: float = 0.5, runs: list[tuple[DataFrame, DataFrame]] | None = None) -> DataFrame:
    """image_eval rows of the annotator that suits the predictions best, image by image. images:
    annotator, image_id, is_instance_exhaustive; annotators: their ground truth; runs: for masks,
    the run tables of each annotator and of the predictions."""
    from ..operators.reshape import best_annotator, exhaustive_images

    chosen = exhaustive_images(images)
    evals = [image_eval(chosen, gt, dt.join(chosen, "image_id", "left_semi"), least_score, runs[i] if runs else None).withColumn("annotator", F.lit(i)) for i, gt in enumerate(annotators)]
    rows = evals[0]
    for other in evals[1:]:
        rows = rows.unionByName(other)
    means = rows.groupBy("image_id", "annotator").agg(F.avg("f1").alias("mean_f1"))
    return rows.join(best_annotator(means).select("image_id", "annotator"), ["image_id", "annotator"])


def demo_metrics(rows: DataFrame) -> DataFrame:
    """Shares of images without any error, and F1 by the other conventions, at each threshold:
    macro F1 over images with ground truth that counts a missing prediction as 0 (f1_w0dt),
    cgf1_macro = macro F1 times MCC, and the like for micro F1 and f1_w0dt."""
    base = concept_f1(rows)
    there = F.col("n_gt") > 0
    perfect = (F.col("fp") == 0) & (F.col("fn") == 0)
    more = rows.groupBy("threshold").agg(F.avg(F.when(there, perfect.cast("int"))).alias("perfect_positives"), F.avg(F.when(~there, perfect.cast("int"))).alias("perfect_negatives"), F.sum(F.when(there, F.coalesce("f1", F.lit(0.0)))).alias("f1_sum"), F.count_if(there).alias("n_positive"))
    out = base.join(more, "threshold").withColumn("f1_w0dt", F.col("f1_sum") / F.greatest("n_positive", F.lit(1)))
    return out.withColumns({"cgf1_macro": F.col("positive_macro_f1") * F.col("il_mcc"), "cgf1_micro": F.col("positive_micro_f1") * F.col("il_mcc"), "cgf1_w0dt": F.col("f1_w0dt") * F.col("il_mcc")}).drop("f1_sum", "n_positive")


def region_boundary(gt: DataFrame, dt: DataFrame, runs: tuple[DataFrame, DataFrame], edges: tuple[DataFrame, DataFrame], wide: tuple[DataFrame, DataFrame], least_score: float = 0.5) -> DataFrame:
    """image_id, j (mean IoU), f (mean boundary F) and j_and_f of the 1:1 assignment of masks, for
    images with something on both sides. runs, edges, wide: the run tables of masks, of
    their boundaries and of the widened boundaries, of ground truth and of predictions.
    As many pairs count as the smaller side has; those without a common pixel go by id."""
    gt, dt = drop_crowd(gt), score_filter(dt, least_score)
    keys = ["image_id", "ann_id", "det_id"]
    matched = optimal_match(scored_pairs(gt, dt, runs), "image_id", "ann_id", "det_id", "iou").select(*keys, "iou")
    rest = [df.select("image_id", i).join(matched, ["image_id", i], "left_anti").withColumn("place", F.row_number().over(Window.partitionBy("image_id").orderBy(i))) for df, i in ((gt, "ann_id"), (dt, "det_id"))]
    pairs = matched.unionByName(rest[0].join(rest[1], ["image_id", "place"]).select(*keys, F.lit(0.0).alias("iou")))
    partner = pairs.select("image_id", "ann_id", "det_id")

    def of_partner(table: DataFrame) -> DataFrame:
        return table.withColumnRenamed("ann_id", "det_id").join(partner, ["image_id", "det_id"]).drop("det_id")

    f = boundary_f_measure(partner, edges[0], of_partner(edges[1]), wide[0], of_partner(wide[1])).select("image_id", "ann_id", "f")
    each = pairs.join(f, ["image_id", "ann_id"]).groupBy("image_id").agg(F.avg("iou").alias("j"), (F.sum("f") / (F.count("*") + MEAN_TERM)).alias("f"))
    return each.withColumn("j_and_f", (F.col("j") + F.col("f")) / 2)


#: Outputs that have a mean over the thresholds and values at 0.5 and 0.75: name and column.
DEMO_LEVELS = {"cgf1": "cgf1_macro", "precision": "precision", "recall": "recall", "f1": "micro_f1", "macro_f1": "positive_macro_f1", "perfect_pos": "perfect_positives", "perfect_neg": "perfect_negatives", "cgf1_micro": "cgf1_micro", "positive_micro_precision": "positive_micro_precision", "positive_micro_f1": "positive_micro_f1", "cgf1_w0dt": "cgf1_w0dt", "positive_w0dt_macro_f1": "f1_w0dt"}


def demo_summary(rows: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """One row of the 44 outputs over image_eval rows and region_boundary rows; j, f and j_and_f
    are 0 where no image has a match."""
    metrics = demo_metrics(rows)
    out = [F.coalesce(F.avg(c), F.lit(0.0)).alias(n) for n, c in DEMO_LEVELS.items()] + [F.max(m).alias(m) for m in IMAGE_METRICS]
    out += [F.coalesce(F.max(F.when(F.col("threshold") == t, F.col(c))), F.lit(0.0)).alias(f"{n}_{round(100 * t)}") for t in (0.5, 0.75) for n, c in DEMO_LEVELS.items()]
    one = metrics.agg(*out)
    names = ("j", "f", "j_and_f")
    if regions is None:
        return one.select("*", *(F.lit(0.0).alias(c) for c in names))
    return one.join(regions.agg(*(F.coalesce(F.sum(c) / (F.count("*") + MEAN_TERM), F.lit(0.0)).alias(c) for c in names)))

"""Detections stay one row through the average precision, whatever the number of levels."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from annolytics.plans import average_precision as A
from annolytics.operators.matching import greedy_match


def _sides(spark, seed):
    rng = random.Random(seed)
    gt = [(i, 1 + k % 2, i * 10 + k, int(rng.random() < 0.2), rng.uniform(100, 15000)) for i in range(30) for k in range(4)]
    dt = [(i, 1 + k % 3, i * 10 + k, rng.randrange(4) / 4, rng.uniform(100, 15000)) for i in range(30) for k in range(6)]
    pairs = [(g[0], g[1], g[2], d[2], rng.randrange(4, 20) / 20) for g in gt for d in dt if g[:2] == d[:2]]
    return (spark.createDataFrame(gt, "image_id long, category_id long, ann_id long, iscrowd int, area double"), spark.createDataFrame(dt, "image_id long, category_id long, det_id long, score double, area double"),
        spark.createDataFrame(pairs, "image_id long, category_id long, ann_id long, det_id long, iou double"))


def test_levels_match_as_each_by_itself(spark):
    gt, dt, pairs = _sides(spark, 1)
    keys = ["image_id", "category_id"]
    matched, _ = A.ap_matches(gt, dt, pairs, keys)
    assert matched.count() == dt.count()  # one row a detection
    found = {tuple(r) for r in matched.select("det_id", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("level"), "tps").filter("(shiftright(tps, level) & 1) = 1").select("det_id", "level").collect()}
    want = set()
    for a, (lo, hi) in enumerate(A.IMAGE_AREAS.values()):
        rows = pairs.join(gt.select("ann_id", "iscrowd", ((F.col("iscrowd") == 1) | (F.col("area") < lo) | (F.col("area") > hi)).alias("ignored")), "ann_id").join(dt.select("det_id", "score"), "det_id")
        want |= {(r.det_id, a * 10 + r.threshold) for r in greedy_match(rows, keys, A.THRESHOLDS).filter("not ignored").collect()}
    assert found == want


@pytest.mark.parametrize("most", [3, 100_000])
def test_cells_give_the_same_precision(spark, most):
    gt, dt, pairs = _sides(spark, 2)
    matched, ignored = A.ap_matches(gt, dt, pairs, ["image_id", "category_id"])
    got = A.precision_by_level(matched, ignored, "category_id", ["image_id", "det_id"], step_rows=most)
    level = F.explode(F.sequence(F.lit(0), F.lit(39))).alias("level")
    area = F.element_at(F.array(*(F.lit(a) for a in A.IMAGE_AREAS)), (F.floor(F.col("level") / 10) + 1).cast("int")).alias("area_range")
    each = matched.select("*", level).select("*", area, (F.col("level") % 10).alias("threshold"), F.expr("(shiftright(tps, level) & 1) = 1").alias("is_tp"), F.expr("(shiftright(fps, level) & 1) = 1").alias("is_fp"))
    counted = ignored.select("category_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("i"), "ignored").select("category_id", F.element_at(F.array(*(F.lit(a) for a in A.IMAGE_AREAS)), F.col("i") + 1).alias("area_range"), F.expr("(shiftright(ignored, i) & 1) = 0").alias("counted"))
    want = A.average_precision(each, counted, ["category_id"])
    rows = [sorted((r.category_id, r.area_range, r.threshold, r.n_gt, r.ap, r.ar) for r in df.collect()) for df in (got, want)]
    assert len(rows[0]) == 80 and [r[:4] for r in rows[0]] == [r[:4] for r in rows[1]]
    assert [r[4:] for r in rows[0]] == [pytest.approx(r[4:]) for r in rows[1]]

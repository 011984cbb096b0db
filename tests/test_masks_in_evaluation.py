"""Evaluation of masks: whole boxes as masks give what the boxes give, and region and boundary
measures what bitmaps give."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annolytics.operators import masks as K
from annolytics.plans import average_precision as A, concept_f1 as F1, tracking as H

BOXES = "image_id long, category_id long, ann_id long, det_id long, iscrowd int, score double, x double, y double, w double, h double"
TRACKS = "video_id long, category_id long, track_id long, frame_idx int, score double, x double, y double, w double, h double"


def as_runs(boxes, *keys):
    """Every column of a whole-numbered box is a run."""
    cols = F.explode(F.sequence(F.col("x").cast("long"), (F.col("x") + F.col("w") - 1).cast("long")))
    return boxes.select(*keys, cols.alias("col"), F.col("y").cast("long").alias("row_start"), F.col("h").cast("long").alias("run_len"))


def boxes(spark, seed, n=12):
    rnd = random.Random(seed)
    gt, dt = [], []
    for image in range(n):
        for _ in range(rnd.randrange(4)):
            b = [float(rnd.randrange(20)), float(rnd.randrange(20)), float(rnd.randrange(3, 14)), float(rnd.randrange(3, 14))]
            gt.append((image, 1, len(gt), None, int(rnd.random() < 0.1), None, *b))
            if rnd.random() < 0.8:
                dt.append((image, 1, None, 1000 + len(dt), 0, rnd.choice([0.3, 0.6, 0.9]), b[0] + rnd.randrange(3), b[1] + rnd.randrange(2), b[2], b[3]))
        if rnd.random() < 0.4:
            dt.append((image, 1, None, 1000 + len(dt), 0, 0.8, 40.0, 40.0, 5.0, 5.0))
    images = spark.createDataFrame([(i,) for i in range(n + 1)], "image_id long")
    return images, gt, dt, spark.createDataFrame(gt, BOXES), spark.createDataFrame(dt, BOXES)


def rounded(df, *order):
    names = [c for c in df.columns if c not in order]
    return [tuple(r[c] if not isinstance(r[c], float) else round(r[c], 9) for c in (*order, *names)) for r in sorted(df.collect(), key=lambda r: [str(r[c]) for c in order])]


def test_concept_f1_of_masks(spark):
    images, _, _, gt, dt = boxes(spark, 1)
    runs = as_runs(gt, "image_id", "ann_id"), as_runs(dt, "image_id", F.col("det_id").alias("ann_id"))
    want, got = (rounded(F1.image_eval(images, gt, dt, runs=r), "image_id", "threshold") for r in (None, runs))
    assert want == got and len(want) == 130
    judged = images.withColumns({"annotator": F.lit(0), "is_instance_exhaustive": F.lit(True)})
    judged = judged.unionByName(judged.withColumn("annotator", F.lit(1)))
    both = [rounded(F1.oracle_cgf1(judged, [gt, gt.filter("ann_id % 2 = 0")], dt, runs=r), "image_id", "threshold") for r in (None, [runs, runs])]
    assert both[0] == both[1]


def tracks(spark, seed):
    rnd = random.Random(seed)
    gt, dt = [], []
    for video, k in itertools.product(range(3), range(3)):
        x, y, score = rnd.randrange(10), rnd.randrange(10), rnd.choice([0.55, 0.7, 0.9])
        for f in range(rnd.randrange(1, 5)):
            gt.append((video, 1 + k % 2, k, f, None, float(x + f), float(y), 8.0, 6.0))
            if rnd.random() < 0.8:
                dt.append((video, 1 + k % 2, 10 + k, f, score, float(x + f + rnd.randrange(3)), float(y), 8.0, 7.0))
    return spark.createDataFrame(gt, TRACKS), spark.createDataFrame(dt, TRACKS)


def test_tracks_of_masks(spark):
    gt, dt = tracks(spark, 3)
    keys = ["video_id", "category_id"]
    runs = as_runs(gt, *keys, "track_id", "frame_idx"), as_runs(dt, *keys, "track_id", "frame_idx", "score")
    for by_category in (True, False):
        assert rounded(A.evaluate_track_map(gt, dt, by_category), "category_id", "area_range", "threshold") == rounded(A.evaluate_track_map(*runs, by_category, masks=True), "category_id", "area_range", "threshold")
    declared = gt.select("video_id", F.lit(9).cast("long").alias("category_id")).distinct()
    for a, b, order in zip(F1.evaluate_track_cgf1(gt, dt, declared), F1.evaluate_track_cgf1(*runs, declared, masks=True), ("threshold", "image_id"), strict=True):
        assert rounded(a, order) == rounded(b, order)
    for mode in ("class", "phrase"):
        assert rounded(H.evaluate_hota(gt, dt, mode), "level", "name", "alpha") == rounded(H.evaluate_hota(*runs, mode, masks=True), "level", "name", "alpha")
    with pytest.raises(ValueError):
        H.evaluate_hota(*runs, "agnostic", masks=True)


def test_tracks_without_pixels_are_equal(spark):
    schema = "video_id long, track_id long, frame_idx int, col long, row_start long, run_len long"
    gt, dt = spark.createDataFrame([(1, 1, 0, 0, 0, 4)], schema), spark.createDataFrame([(1, 5, 0, 0, 2, 4)], schema)
    all_gt, all_dt = (spark.createDataFrame([(1, i) for i in ids], "video_id long, track_id long") for ids in ((1, 2), (5, 6)))
    assert sorted(map(tuple, K.track_mask_iou(gt, dt, ("video_id",), all_gt, all_dt).collect())) == [(1, 1, 5, 2 / 6), (1, 2, 6, 1.0)]
    assert K.track_mask_iou(gt, dt).count() == 1


def bitmap(b):
    m = np.zeros((60, 60), bool)
    m[int(b[1]) : int(b[1] + b[3]), int(b[0]) : int(b[0] + b[2])] = True
    return m


def edge(b, wide=0):
    """First and last pixel of each column, or these and `wide` pixels above and below."""
    m = np.zeros((70, 60), bool)
    for c in range(int(b[0]), int(b[0] + b[2])):
        for r in (int(b[1]), int(b[1] + b[3]) - 1):
            m[r - wide + 5 : r + wide + 6, c] = True
    return m


def test_region_and_boundary_measures(spark):
    images, gt_rows, dt_rows, gt, dt = boxes(spark, 5)
    runs = as_runs(gt, "image_id", "ann_id"), as_runs(dt, "image_id", F.col("det_id").alias("ann_id"))
    ends = F.explode(F.array_distinct(F.array("row_start", F.col("row_start") + F.col("run_len") - 1)))
    edges = tuple(r.select("image_id", "ann_id", "col", ends.alias("row_start"), F.lit(1).cast("long").alias("run_len")) for r in runs)
    # the widened boundary as disjoint runs of one pixel
    wide = tuple(e.select("image_id", "ann_id", "col", F.explode(F.sequence(F.col("row_start") - 1, F.col("row_start") + 1)).alias("row_start"), "run_len").distinct() for e in edges)
    regions = F1.region_boundary(gt, dt, runs, edges, wide)
    got = {r.image_id: (r.j, r.f, r.j_and_f) for r in regions.collect()}
    want = {}
    for image in range(12):
        g, d = [r for r in gt_rows if r[0] == image and not r[4]], [r for r in dt_rows if r[0] == image and r[5] >= 0.5]
        if not g or not d:
            continue
        ious = np.array([[(bitmap(a[6:]) & bitmap(b[6:])).sum() / (bitmap(a[6:]) | bitmap(b[6:])).sum() for b in d] for a in g])
        few, many = (len(g), len(d)) if len(g) <= len(d) else (len(d), len(g))
        table = ious if len(g) <= len(d) else ious.T
        best = max(itertools.permutations(range(many), few), key=lambda p: sum(table[i, j] for i, j in enumerate(p)))
        pairs = [(i, j) if len(g) <= len(d) else (j, i) for i, j in enumerate(best)]
        met = [(i, j) for i, j in pairs if ious[i, j] > 0]
        met += list(zip([i for i in range(len(g)) if i not in {i for i, _ in met}], [j for j in range(len(d)) if j not in {j for _, j in met}], strict=False))
        fs = []
        for i, j in met:
            a, b, wa, wb = edge(g[i][6:]), edge(d[j][6:]), edge(g[i][6:], 1), edge(d[j][6:], 1)
            p, r = (b & wa).sum() / b.sum(), (a & wb).sum() / a.sum()
            fs.append(2 * p * r / (p + r) if p + r else 0)
        j, f = np.mean([ious[i, k] for i, k in met]), sum(fs) / (len(fs) + 1e-9)
        want[image] = (j, f, (j + f) / 2)
    assert got.keys() == want.keys() and len(want) > 4
    for image, row in want.items():
        assert got[image] == pytest.approx(row), image
    rows = F1.image_eval(images, gt, dt, runs=runs)
    one = F1.demo_summary(rows, regions).first()
    assert len(one) == 44 and one.j == pytest.approx(np.mean([r[0] for r in want.values()])) and one.j_and_f == pytest.approx((one.j + one.f) / 2)
    least = {r.threshold: r for r in F1.demo_metrics(rows).collect()}
    assert one.cgf1_50 == pytest.approx(least[0.5].cgf1_macro) and one.positive_w0dt_macro_f1_75 == pytest.approx(least[0.75].f1_w0dt) and one.perfect_neg == pytest.approx(np.mean([r.perfect_negatives for r in least.values()]))
    assert F1.demo_summary(rows).first().f == 0.0

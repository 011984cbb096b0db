"""Operators against plain versions and on the rows that trip them: empty sides, ties, nulls."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annolytics import queries as Q
from annolytics.functions import boxes as B
from annolytics.operators import masks as K, matching as M, query_sets as S, reshape as R, suppression as N, tables as T
from annolytics.operators.ordered import assign
from annolytics.plans import average_precision as A, concept_f1 as F1, tracking as H
from annolytics.streaming import lifecycle as L

BOXES = "image_id long, category_id long, ann_id long, det_id long, iscrowd int, score double, x double, y double, w double, h double"
TRACKS = "video_id long, category_id long, track_id long, frame_idx int, score double, x double, y double, w double, h double"


def iou(a, b, crowd=False):
    i = max(min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]), 0) * max(min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1]), 0)
    whole = b[2] * b[3] if crowd else a[2] * a[3] + b[2] * b[3] - i
    return i / whole if whole else 0.0


def random_boxes(n_images, seed):
    rnd = random.Random(seed)
    gt, dt = [], []
    for image in range(n_images):
        for _ in range(rnd.randrange(5)):
            b = [float(rnd.randrange(60)), float(rnd.randrange(60)), float(rnd.randrange(5, 60)), float(rnd.randrange(5, 60))]
            gt.append((image, 1, len(gt), None, int(rnd.random() < 0.2), None, *b))
            for _ in range(rnd.randrange(3)):
                d = [v + rnd.randrange(-3, 4) for v in b]
                dt.append((image, 1, None, 1000 + len(dt), 0, rnd.choice([0.2, 0.5, 0.5, 0.9]), *d))
        if rnd.random() < 0.3:
            dt.append((image, 1, None, 1000 + len(dt), 0, 0.7, 200.0, 200.0, 9.0, 9.0))
    return gt, dt


def plain_ap(gt, dt, t, lo, hi):
    """The protocol as loops: (ap, ar) of one category, threshold and area range."""
    flags, n_gt = [], 0
    for image in sorted({r[0] for r in gt + dt}):
        gs = [(g[2], g[6:], g[4], g[4] == 1 or not lo <= g[8] * g[9] <= hi) for g in gt if g[0] == image]
        n_gt += sum(not g[3] for g in gs)
        gs.sort(key=lambda g: (g[3], g[0]))
        taken = set()
        for d in sorted((d for d in dt if d[0] == image), key=lambda d: (-d[5], d[3])):
            best, m = t, None
            for g in gs:
                if g[0] in taken and not g[2]:
                    continue
                if m is not None and not m[3] and g[3]:
                    break
                v = iou(g[1], d[6:], g[2])
                if v >= best:
                    best, m = v, g
            if m:
                taken.add(m[0])
            outside = not lo <= d[8] * d[9] <= hi
            if not (m[3] if m else outside):
                flags.append((-d[5], image, d[3], m is not None))
    if not n_gt:
        return -1.0, -1.0
    tp = fp = 0
    points = []
    for *_, hit in sorted(flags):
        tp, fp = tp + hit, fp + (not hit)
        points.append((tp, tp / (tp + fp)))
    ap = sum(max((p for n, p in points if n * 100 >= r * n_gt), default=0.0) for r in range(101)) / 101
    return ap, tp / n_gt


def test_average_precision(spark):
    gt, dt = random_boxes(40, 3)
    got = A.evaluate_ap(spark.createDataFrame(gt, BOXES), spark.createDataFrame(dt, BOXES)).collect()
    areas = A.IMAGE_AREAS
    assert len(got) == 40
    for r in got:
        want = plain_ap(gt, dt, A.THRESHOLDS[r.threshold], *areas[r.area_range])
        assert (r.ap, r.ar) == pytest.approx(want), r


def test_average_precision_of_empty_sides(spark):
    gt, dt = random_boxes(3, 5)
    none = spark.createDataFrame([], BOXES)
    assert A.evaluate_ap(none, spark.createDataFrame(dt, BOXES)).count() == 0
    missed = A.evaluate_ap(spark.createDataFrame(gt, BOXES), none)
    assert missed.count() == 0 or {r.ap for r in missed.collect()} <= {0.0, -1.0}


def plain_hota(gt, dt, alphas):
    frames = sorted({r[3] for r in gt + dt})
    gi, di = sorted({r[2] for r in gt}), sorted({r[2] for r in dt})
    common, sims = np.zeros((len(gi), len(di))), {}
    for f in frames:
        a, b = [r for r in gt if r[3] == f], [r for r in dt if r[3] == f]
        s = np.array([[iou(x[5:], y[5:]) for y in b] for x in a]).reshape(len(a), len(b))
        sims[f] = [gi.index(x[2]) for x in a], [di.index(y[2]) for y in b], s
        share = s.sum(0)[None] + s.sum(1)[:, None] - s
        common[np.ix_(*sims[f][:2])] += np.where(share > H.EPS, s / np.where(share > 0, share, 1), 0)
    ng, nd = np.array([sum(r[2] == i for r in gt) for i in gi]), np.array([sum(r[2] == i for r in dt) for i in di])
    align = common / (ng[:, None] + nd[None] - common)
    out = {}
    for alpha in alphas:
        tp, loc, n = 0, 0.0, np.zeros((len(gi), len(di)))
        for x, y, s in sims.values():
            if len(x) and len(y):
                for i, j in assign(align[np.ix_(x, y)] * s):
                    if s[i, j] >= alpha / 100 - H.EPS:
                        tp, loc = tp + 1, loc + s[i, j]
                        n[x[i], y[j]] += 1
        ass = (n * n / np.maximum(1, ng[:, None] + nd[None] - n)).sum() / max(1, tp)
        det = tp / max(1, len(gt) + len(dt) - tp)
        out[alpha] = tp, len(gt) - tp, len(dt) - tp, np.sqrt(det * ass), max(1e-10, loc) / max(1e-10, tp)
    return out


def tracks(kind):
    def track(i, frames, shift=0.0):
        return [(1, 1, i, f, 0.9, 10.0 * i + shift + f, 5.0, 20.0, 20.0) for f in frames]

    gt = track(1, range(6)) + track(4, range(6))
    return gt, {"perfect": gt, "none": [], "switch": track(1, range(3)) + [(*r[:2], 9, *r[3:]) for r in track(1, range(3, 6), 2.0)], "apart": track(1, range(10, 14)), "shifted": track(1, range(6), 6.0) + track(4, range(1, 6), 3.0)}[kind]


@pytest.mark.parametrize("kind", ["perfect", "none", "switch", "apart", "shifted"])
def test_hota(spark, kind):
    gt, dt = tracks(kind)
    fields = H.hota_fields(H.hota_counts(spark.createDataFrame(gt, TRACKS), spark.createDataFrame(dt, TRACKS), ["video_id", "category_id"]))
    want = plain_hota(gt, dt, H.ALPHAS)
    rows = fields.collect()
    assert len(rows) == 19
    for r in rows:
        assert (r.tp, r.fn, r.fp, r.hota, r.loc_a) == pytest.approx(want[r.alpha]), r
    if kind == "perfect":
        assert {round(r.hota, 9) for r in rows} == {1.0}


def test_hota_combines_by_true_positives(spark):
    rows = spark.createDataFrame([(1, 5, 10, 0, 0, 8.0, 5.0, 5.0, 5.0), (2, 5, 30, 10, 20, 27.0, 15.0, 15.0, 15.0), (3, 5, 0, 0, 0, 0.0, 0.0, 0.0, 0.0)], "category_id long, alpha int, tp long, fn long, fp long, loc double, ass_a double, ass_re double, ass_pr double")
    one = H.hota_combine(rows).first()
    assert (one.tp, one.ass_a, one.loc_a) == (40, 0.5, 35 / 40)
    fields = H.hota_combine(rows, "category_id")
    assert H.hota_class_average(fields).first().ass_a == pytest.approx(1 / 3) and H.hota_class_average(fields, True).first().ass_a == pytest.approx(0.5)


def test_optimal_match_of_large_and_rectangular_groups(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for g, (n, m) in enumerate([(2, 5), (5, 2), (1, 1), (30, 20), (2, 2)]):
        s = np.where(rng.random((n, m)) < 0.4, rng.random((n, m)).round(2), 0.0) if g < 4 else np.array([[0.9, 0.8], [0.8, 0.1]])
        rows += [(g, i, 100 + j, float(s[i, j])) for i in range(n) for j in range(m)]
        want[g] = sum(s[i, j] for i, j in assign(s))
    rows += [(9, 1, 2, None), (10, 1, 2, 0.0)]
    got = M.optimal_match(spark.createDataFrame(rows, "g long, l long, r long, s double"), "g", "l", "r", "s").collect()
    for g, total in want.items():
        own = [r for r in got if r.g == g]
        assert sum(r.s for r in own) == pytest.approx(total) and len({r.l for r in own}) == len(own) == len({r.r for r in own})
    assert not [r for r in got if r.g > 8]
    assert sorted((r.l, r.r) for r in got if r.g == 4) == [(0, 101), (1, 100)]


def test_nms_threshold_and_ties(spark):
    rows = [(1, 1, None, 1, 0, 0.9, 0.0, 0.0, 2.0, 1.0), (1, 1, None, 2, 0, 0.8, 0.0, 0.0, 1.0, 1.0), (1, 1, None, 3, 0, 0.9, 0.0, 0.0, 2.0, 1.0), (1, 1, None, 4, 0, 0.7, 5.0, 5.0, 0.0, 0.0), (None, 1, None, 5, 0, 0.9, 0.0, 0.0, 1.0, 1.0)]
    kept = N.nms(spark.createDataFrame(rows, BOXES), "image_id", "det_id", "score", 0.1, 0.5)
    assert sorted(r.det_id for r in kept.collect()) == [1, 2, 4, 5]  # an IoU equal to the threshold stays
    assert N.nms(spark.createDataFrame([], BOXES), "image_id", "det_id", "score", 0.1, 0.5).count() == 0
    frames = [(1, 1, 1, 0, 0.9, 0.0, 0.0, 2.0, 1.0), (1, 1, 2, 0, 0.8, 0.0, 0.0, 1.0, 1.0), (1, 1, 3, 0, 0.7, None, None, None, None)]
    out = {r.track_id: r.x for r in N.nms_frames(spark.createDataFrame(frames, TRACKS), 0.5).collect()}
    assert out == {1: 0.0, 2: None, 3: None}  # here it goes
    tracked = {r.track_id: r.x for r in N.nms_tracks(spark.createDataFrame(frames, TRACKS), 0.5).collect()}
    assert tracked == {1: 0.0, 2: None, 3: None}


def test_boxes_without_area(spark):
    pair = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 2.0, 1.0, 0.0, 0.0, 1.0, 1.0), (0.0, 0.0, 1.0, 1.0, 3.0, 0.0, 1.0, 1.0)], ", ".join(f"{s}{c} double" for s in "ab" for c in "xywh"))
    a, b = B.box("a"), B.box("b")
    rows = pair.select(B.iou(a, b).alias("iou"), B.giou(a, b).alias("giou"), B.ioa(a, b).alias("ioa"), B.ioa(a, b, True).alias("other")).collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.0, 0.0, 0.0), (0.5, 0.5, 0.5, 1.0), (0.0, -0.5, 0.0, 0.0)]


def test_top_detections_can_be_off(spark):
    rows = spark.createDataFrame([(1, 1, None, i, 0, 0.5, 0.0, 0.0, 1.0, 1.0) for i in range(4)], BOXES)
    assert [T.top_detections(rows, k).count() for k in (0, -1, 3)] == [4, 4, 3]


def bitmap_runs(spark, maps):
    rows = []
    for ann, bits in enumerate(maps):
        for col in range(bits.shape[1]):
            edges = np.flatnonzero(np.diff(np.r_[0, bits[:, col].astype(int), 0]))
            rows += [(1, ann, col, int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return spark.createDataFrame(rows, "image_id long, ann_id long, col long, row_start long, run_len long")


def labels_of(bits):
    label, n = np.zeros(bits.shape, int), 0
    for start in zip(*np.nonzero(bits), strict=True):
        if label[start]:
            continue
        n += 1
        stack = [start]
        label[start] = n
        while stack:
            y, x = stack.pop()
            for v in range(max(0, y - 1), min(bits.shape[0], y + 2)):
                for u in range(max(0, x - 1), min(bits.shape[1], x + 2)):
                    if bits[v, u] and not label[v, u]:
                        label[v, u] = n
                        stack.append((v, u))
    return label


def test_mask_components_and_cleaning(spark):
    rng = np.random.default_rng(5)
    maps = [rng.random((12, 15)) < p for p in (0.2, 0.4, 0.6, 0.85)]
    runs = bitmap_runs(spark, maps)
    parts = K.mask_components(runs).collect()
    for ann, bits in enumerate(maps):
        sizes = np.bincount(labels_of(bits)[bits])[1:]
        own = {r.component: r.size for r in parts if r.ann_id == ann}
        assert sorted(own.values()) == sorted(sizes.tolist()) and sorted(own) == list(range(1, len(sizes) + 1))
    sizes = spark.createDataFrame([(1, a, 12, 15) for a in range(4)], "image_id long, ann_id long, h long, w long")
    cleaned = K.clean_masks(runs, sizes, 4).collect()
    for ann, bits in enumerate(maps):
        holes = labels_of(~bits)
        small = np.bincount(holes.ravel()) <= 4
        small[0] = False
        full = bits | small[holes]
        parts_of, least = labels_of(full), min(4, full.sum() // 2)
        keep = np.bincount(parts_of.ravel()) > least
        keep[0] = False
        got = np.zeros(bits.shape, bool)
        for r in cleaned:
            if r.ann_id == ann:
                got[r.row_start : r.row_start + r.run_len, r.col] = True
        assert (got == keep[parts_of]).all(), ann


def test_overlaps_go_to_the_best_object(spark):
    runs = spark.createDataFrame([(1, 1, 0, 0, 10), (1, 2, 0, 4, 3), (1, 3, 0, 8, 6), (1, 4, 1, 0, 2)], "image_id long, ann_id long, col long, row_start long, run_len long")
    scores = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.9), (1, 3, 0.5), (1, 4, 0.1)], "image_id long, ann_id long, score double")
    out = sorted((r.ann_id, r.row_start, r.run_len) for r in N.resolve_overlaps(runs, scores, "image_id").collect())
    assert out == [(1, 0, 4), (1, 7, 3), (2, 4, 3), (3, 10, 4), (4, 0, 2)]  # of equal scores the smaller id
    assert {r.ann_id: r.kept for r in N.drop_shrunk(runs, scores, "image_id", threshold=0.69).collect()} == {1: True, 2: True, 3: False, 4: True}


def test_best_annotator_is_not_symmetric(spark):
    rows = [(1, 0, 0.5), (1, 1, 0.6), (1, 2, 0.6), (2, 0, 0.5), (2, 1, None), (2, 2, 0.9), (3, 0, None), (3, 1, 0.9), (4, 0, None)]
    got = {r.image_id: r.annotator for r in R.best_annotator(spark.createDataFrame(rows, "image_id long, annotator int, mean_f1 double")).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 0}


def test_pair_f1_of_nothing_is_one(spark):
    rows = [(1, t, 0, 0, 0) for t in F1.THRESHOLDS] + [(2, t, int(t <= 0.5), 1, 0) for t in F1.THRESHOLDS]
    got = {r.image_id: r for r in F1.pair_f1(spark.createDataFrame(rows, "image_id long, threshold double, tp long, fp long, fn long")).collect()}
    assert got[1].f1 == 1.0 and got[2].f1_50 == pytest.approx(2 / 3) and got[2].f1_75 == 0.0


def test_errors_are_raised(spark):
    queries = spark.createDataFrame([(1, 0, 1, "a")], "datapoint_id long, query_no int, stage int, query_text string")
    targets = spark.createDataFrame([(1, 0, 5)], "datapoint_id long, query_no int, object_id long")
    objects = spark.createDataFrame([(1, 5, 0)], "datapoint_id long, object_id long, frame int")
    with pytest.raises(Exception, match="no first query"):
        S.compact(queries, targets, objects)[0].collect()
    frames = spark.createDataFrame([(1, 0), (1, 1)], "video_id long, frame_idx int")
    with pytest.raises(Exception, match="too few frames"):
        R.strided_frames(frames, 3, 1, 1).collect()
    with pytest.raises(ValueError, match="unknown image"):
        R.assert_known_images(frames.select(F.col("video_id").alias("image_id")), frames.select(F.lit(7).alias("image_id")))
    twice = spark.createDataFrame([(1, 1, 1, 0, 0.5, 0.0, 0.0, 1.0, 1.0)] * 2, TRACKS)
    with pytest.raises(ValueError, match="twice in a frame"):
        R.assert_unique_ids(twice.limit(1), twice)


RULES = L.Rules(start_delay=4, unmatched=2, overlap=2, keep_init=0, keep_max=2, keep_min=-1, confirm=2, delay=3)


def test_track_lifecycle_by_hand():
    """Object 1 is matched throughout; 2 misses twice within its start and is removed, also from
    the frames that wait; 3 comes on the last frame."""
    state, out = L.fresh(), []
    frames = [[(1, True, False, []), (2, True, False, [])], [(1, True, False, []), (2, False, False, [])], [(1, True, False, []), (2, False, False, [])], [(1, False, False, []), (3, True, False, [1])]]
    for i, rows in enumerate(frames):
        out += L.step(state, RULES, i, rows, i == 3)
    assert [r[:2] for r in out] == [(0, 1), (1, 1), (2, 1), (3, 1), (3, 3)]
    assert [r[3] for r in out if r[1] == 1] == [True] * 4 and [r[3] for r in out if r[1] == 3] == [False]
    assert state["removed"] == [2]
    assert L.step(L.fresh(), L.Rules(), 0, [], True) == []


def test_stream_equals_table(spark, sf_dir):
    queries = Q.queries()
    a, b = (sorted(map(tuple, queries[n](spark, sf_dir).collect())) for n in ("track_lifecycle", "track_lifecycle_stream"))
    assert a == b and len(a) > 10_000


@pytest.mark.parametrize("name", ["drop_queries_by_text", "semantic_queries_only", "drop_empty_objects"])
def test_curation_of_empty_tables(spark, name):
    queries = spark.createDataFrame([(1, 0, 0, None, None, None)], "datapoint_id long, query_no int, stage int, query_text string, input_x double, area double")
    given = {"drop_queries_by_text": lambda d: S.drop_queries_by_text(d, ["x"]), "semantic_queries_only": S.semantic_queries_only, "drop_empty_objects": lambda d: S.drop_empty_objects(d)}[name]
    assert given(queries.limit(0)).count() == 0
    assert given(queries).count() == (0 if name == "drop_empty_objects" else 1)

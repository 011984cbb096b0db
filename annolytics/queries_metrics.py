"""Queries of matching, suppression and the evaluations, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import boxes as B
from .operators import masks as K, matching as M, reshape as R, suppression as S
from .plans import average_precision as A, concept_f1 as F1, teta as E, tracking as H
from .views import register, view


def _flagged(spark, d):
    """Detections with flags that stand for the outcome of a matching."""
    dt = view(spark, d, "dt_boxes").withColumns({"area_range": F.lit("all"), "threshold": F.lit(0)})
    return dt.select("image_id", "category_id", "det_id", "score", "area_range", "threshold", (F.col("det_id") % 3 != 0).alias("is_tp"), (F.col("det_id") % 3 == 0).alias("is_fp"))


_CURVE = """(SELECT *, CAST(sum(t) OVER w AS BIGINT) AS tp, CAST(sum(1 - t) OVER w AS BIGINT) AS fp FROM (SELECT image_id, category_id, det_id, score, CASE WHEN det_id % 3 <> 0 THEN 1 ELSE 0 END AS t FROM dt_boxes)
  WINDOW w AS (PARTITION BY category_id ORDER BY score DESC, image_id, det_id ROWS UNBOUNDED PRECEDING))"""


@register(f"SELECT category_id, det_id, tp, fp FROM {_CURVE}")
def precision_recall_curve(spark, d):
    return A.precision_recall(_flagged(spark, d), ["category_id"], ["image_id", "det_id"]).select("category_id", "det_id", "tp", "fp")


@register(f"""SELECT category_id, 'all' AS area_range, 0 AS threshold, any_value(n_gt) AS n_gt, round(sum(best) / 101, 9) AS ap, round(any_value(top) / any_value(n_gt), 9) AS ar FROM (
  SELECT g.category_id, g.n_gt, r.i, coalesce(max(c.tp / (c.tp + c.fp)) FILTER (c.t = 1 AND c.tp * 100 >= r.i * g.n_gt), 0) AS best, max(c.tp) AS top
  FROM (SELECT category_id, count(*) AS n_gt FROM gt_boxes WHERE iscrowd = 0 GROUP BY 1) g CROSS JOIN (SELECT unnest(range(0, 101)) AS i) r JOIN {_CURVE} c USING (category_id) GROUP BY ALL) GROUP BY category_id""")
def average_precision(spark, d):
    counted = view(spark, d, "gt_boxes").select("category_id", F.lit("all").alias("area_range"), (F.col("iscrowd") == 0).alias("counted"))
    out = A.average_precision(_flagged(spark, d), counted, ["category_id"])
    return out.withColumns({c: F.round(c, 9) for c in ("ap", "ar")})


_BOX = "struct_pack(d := r.det_id, x := r.x, y := r.y, w := r.w, h := r.h)"
_BOTH = "greatest(least({0}.x + {0}.w, {1}.x + {1}.w) - greatest({0}.x, {1}.x), 0.0) * greatest(least({0}.y + {0}.h, {1}.y + {1}.h) - greatest({0}.y, {1}.y), 0.0)"


def _nms_sql(keys: str, rows: str, drop: str) -> str:
    """Greedy suppression as a recursion over the rank within the group."""
    on = " AND ".join(f"r.{k.strip()} = s.{k.strip()}" for k in keys.split(","))
    own = ", ".join(f"r.{k.strip()}" for k in keys.split(","))
    both = _BOTH.format("b", "r")
    hit = f"{both} {drop} * (b.w * b.h + r.w * r.h - {both})"
    return f"""SELECT {keys}, unnest(kept).d AS item FROM (WITH RECURSIVE r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, det_id) AS k FROM {rows}),
  s AS (SELECT {own}, r.k, [{_BOX}] AS kept FROM r WHERE r.k = 1
    UNION ALL SELECT {own}, r.k, CASE WHEN len(list_filter(s.kept, lambda b: {hit})) = 0 THEN list_append(s.kept, {_BOX}) ELSE s.kept END FROM s JOIN r ON {on} AND r.k = s.k + 1)
  SELECT {keys}, arg_max(kept, k) AS kept FROM s GROUP BY {keys})"""


@register(f"SELECT n.image_id, n.item AS det_id, t.score FROM ({_nms_sql('image_id', '(SELECT * FROM dt_boxes WHERE score > 0.1)', '> 0.5')}) n JOIN dt_boxes t ON t.image_id = n.image_id AND t.det_id = n.item")
def nms(spark, d):
    return S.nms(view(spark, d, "dt_boxes"), "image_id", "det_id", "score", 0.1, 0.5)


@register(f"SELECT t.video_id, t.frame_idx, t.track_id, n.item IS NOT NULL AS kept FROM dt_tracks t LEFT JOIN ({_nms_sql('video_id, frame_idx', '(SELECT video_id, frame_idx, track_id AS det_id, x, y, w, h, score FROM dt_tracks)', '>= 0.3')}) n ON n.video_id = t.video_id AND n.frame_idx = t.frame_idx AND n.item = t.track_id")
def nms_frames(spark, d):
    out = S.nms_frames(view(spark, d, "dt_tracks"), 0.3)
    return out.select("video_id", "frame_idx", "track_id", F.col("x").isNotNull().alias("kept"))


_TRACK_PAIRS = f"""(SELECT a.video_id, a.track_id AS a, b.track_id AS b, any_value(a.score) AS a_score, sum({_BOTH.format('a', 'b')}) AS i, sum(a.w * a.h + b.w * b.h) AS s
  FROM dt_tracks a JOIN dt_tracks b ON a.video_id = b.video_id AND a.frame_idx = b.frame_idx AND (a.score > b.score OR (a.score = b.score AND a.track_id < b.track_id)) GROUP BY ALL)"""


@register(f"""SELECT t.video_id, t.track_id, list_contains(kept, t.track_id) AS kept FROM (SELECT DISTINCT video_id, track_id FROM dt_tracks) t JOIN (
  WITH RECURSIVE e AS MATERIALIZED (SELECT * FROM {_TRACK_PAIRS} WHERE i >= 0.3 * (s - i)),
  r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY score DESC, track_id) AS k FROM (SELECT video_id, track_id, max(score) AS score FROM dt_tracks GROUP BY ALL)),
  g AS MATERIALIZED (SELECT r.video_id, r.k, any_value(r.track_id) AS track_id, list(e.a) FILTER (e.a IS NOT NULL) AS enemies FROM r LEFT JOIN e ON e.video_id = r.video_id AND e.b = r.track_id GROUP BY r.video_id, r.k),
  s AS (SELECT video_id, k, [track_id] AS kept FROM g WHERE k = 1 UNION ALL
    SELECT g.video_id, g.k, CASE WHEN list_has_any(s.kept, coalesce(g.enemies, [])) THEN s.kept ELSE list_append(s.kept, g.track_id) END FROM s JOIN g ON g.video_id = s.video_id AND g.k = s.k + 1)
  SELECT video_id, arg_max(kept, k) AS kept FROM s GROUP BY video_id) n ON n.video_id = t.video_id""")
def nms_tracks(spark, d):
    out = S.nms_tracks(view(spark, d, "dt_tracks"), 0.3)
    return out.groupBy("video_id", "track_id").agg(F.max(F.col("x").isNotNull()).alias("kept"))


_OCCLUDED = f"""(SELECT p.video_id, a, b, CASE WHEN a % 5 = 0 THEN -1 ELSE a % 7 END AS fa, CASE WHEN b % 5 = 0 THEN -1 ELSE b % 7 END AS fb FROM {_TRACK_PAIRS} p WHERE i >= 0.2 * (s - i))"""


@register(f"SELECT video_id, a AS object_id FROM {_OCCLUDED} WHERE fa > fb AND fb > -1 UNION SELECT video_id, b FROM {_OCCLUDED} WHERE fb > fa AND fa > -1")
def suppress_recently_occluded(spark, d):
    tracks = view(spark, d, "dt_tracks")
    a, b = S._sides(tracks, ["video_id", "frame_idx"], "track_id", "score", *"xywh")
    both = B.intersection(B.box("a_"), B.box("b_"))
    pairs = a.join(b, ["video_id", "frame_idx"]).filter(S._before()).groupBy("video_id", "a", "b").agg(F.sum(both).alias("i"), F.sum(B.area(B.box("a_")) + B.area(B.box("b_"))).alias("s"))
    pairs = pairs.select("video_id", "a", "b", F.when(F.col("s") > F.col("i"), F.col("i") / (F.col("s") - F.col("i"))).otherwise(0.0).alias("iou"))
    last = tracks.select("video_id", F.col("track_id").alias("object_id")).distinct().withColumn("frame", F.when(F.col("object_id") % 5 == 0, -1).otherwise(F.col("object_id") % 7))
    return S.suppress_recently_occluded(pairs, last, 0.2)


@register(f"""SELECT p.image_id, p.category_id, t AS threshold, p.dets AS det_id, p.anns AS ann_id FROM (
  WITH RECURSIVE e AS MATERIALIZED (SELECT g.image_id, g.category_id, g.ann_id, d.det_id, d.score, g.iscrowd, CASE WHEN g.iscrowd = 1 THEN {_BOTH.format('g', 'd')} / (d.w * d.h) ELSE {_BOTH.format('g', 'd')} / (g.w * g.h + d.w * d.h - {_BOTH.format('g', 'd')}) END AS iou
    FROM gt_boxes g JOIN dt_boxes d USING (image_id, category_id)),
  c AS MATERIALIZED (SELECT e.*, CAST(l.t AS INT) AS t, dense_rank() OVER (PARTITION BY image_id, category_id, l.t ORDER BY score DESC, det_id) AS k FROM e JOIN (VALUES (0, 0.5), (1, 0.75)) AS l(t, least) ON e.iou >= l.least),
  f AS MATERIALIZED (SELECT image_id, category_id, t, k, any_value(det_id) AS det_id, list(struct_pack(a := ann_id, crowd := iscrowd) ORDER BY iscrowd, iou DESC, ann_id DESC) AS options FROM c GROUP BY ALL),
  s AS (SELECT image_id, category_id, t, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS busy, CAST([] AS BIGINT[]) AS dets, CAST([] AS BIGINT[]) AS anns FROM f WHERE k = 1
    UNION ALL SELECT f.image_id, f.category_id, f.t, f.k, CASE WHEN o.a IS NULL OR o.crowd = 1 THEN s.busy ELSE list_append(s.busy, o.a) END, CASE WHEN o.a IS NULL THEN s.dets ELSE list_append(s.dets, f.det_id) END, CASE WHEN o.a IS NULL THEN s.anns ELSE list_append(s.anns, o.a) END
    FROM s JOIN f ON f.image_id = s.image_id AND f.category_id = s.category_id AND f.t = s.t AND f.k = s.k + 1, LATERAL (SELECT list_filter(f.options, lambda x: NOT list_contains(s.busy, x.a))[1] AS o))
  SELECT image_id, category_id, t, unnest(arg_max(dets, k)) AS dets, unnest(arg_max(anns, k)) AS anns FROM s GROUP BY image_id, category_id, t) p""")
def greedy_match(spark, d):
    keys = ["image_id", "category_id"]
    gt, dt = view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes")
    pairs = A.box_pairs(gt, dt, *keys).join(gt.select("ann_id", "iscrowd", (F.col("iscrowd") == 1).alias("ignored")), "ann_id").join(dt.select("det_id", "score"), "det_id")
    return M.greedy_match(pairs, keys, [0.5, 0.75]).select(*keys, "threshold", "det_id", "ann_id")


@register()
def evaluate_ap(spark, d):
    return A.evaluate_ap(view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes"))


@register()
def evaluate_ap_summary(spark, d):
    return A.mean_precision(A.evaluate_ap(view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes"), positive_split=True))


@register()
def rarity_bucket_average(spark, d):
    """Buckets: categories 1 and 2, and 3 and 4."""
    rows = A.evaluate_ap(view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes"))
    return A.rarity_bucket_average(rows.withColumn("bucket", F.col("category_id") > 2), "bucket")


@register()
def evaluate_track_map(spark, d):
    return A.evaluate_track_map(view(spark, d, "gt_tracks"), view(spark, d, "dt_tracks"))


@register()
def evaluate_phrase_ap(spark, d):
    return A.evaluate_track_map(view(spark, d, "gt_tracks"), view(spark, d, "dt_tracks"), by_category=False)


@register()
def evaluate_hota(spark, d):
    return H.evaluate_hota(view(spark, d, "gt_tracks"), view(spark, d, "dt_tracks"))


@register()
def hota_by_pair(spark, d):
    counts = H.hota_counts(view(spark, d, "gt_tracks"), view(spark, d, "dt_tracks"), ["video_id", "category_id"])
    return H.alpha_means(H.hota_fields(counts), "video_id", "category_id")


@register("""SELECT alpha, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fn) AS BIGINT) AS fn, CAST(sum(fp) AS BIGINT) AS fp, round(sqrt(sum(tp) / (sum(tp) + sum(fn) + sum(fp)) * sum(a) / sum(tp)), 9) AS hota, round(sum(l) / sum(tp), 9) AS loc_a FROM (
  SELECT category_id, video_id, v.alpha, tp, fn, fp, l, a FROM (SELECT video_id, category_id, count(*) + 1 AS tp, min(frame_idx) + 1 AS fn, max(frame_idx) AS fp, count(*) * 0.5 AS l, count(*) * 0.25 AS a FROM gt_tracks GROUP BY ALL)
  CROSS JOIN (VALUES (5), (50)) AS v(alpha)) GROUP BY alpha""")
def hota_combine(spark, d):
    """Counts derived from the tracks stand for those of an evaluation."""
    rows = view(spark, d, "gt_tracks").groupBy("video_id", "category_id").agg((F.count("*") + 1).alias("tp"), (F.min("frame_idx") + 1).alias("fn"), F.max("frame_idx").alias("fp"), (F.count("*") * 0.5).alias("loc"), (F.count("*") * 0.25).alias("ass_a"))
    rows = rows.withColumns({"ass_re": F.col("ass_a"), "ass_pr": F.col("ass_a"), "alpha": F.explode(F.array(F.lit(5), F.lit(50)))})
    return H.hota_combine(rows).select("alpha", "tp", "fn", "fp", F.round("hota", 9).alias("hota"), F.round("loc_a", 9).alias("loc_a"))


_EXHAUSTIVE = "(SELECT a.i AS annotator, n.image_id, (n.image_id + a.i) % 5 <> 0 AS is_instance_exhaustive FROM np n CROSS JOIN (VALUES (0), (1), (2)) AS a(i))"


@register(f"SELECT DISTINCT image_id FROM {_EXHAUSTIVE} WHERE annotator = 0 AND is_instance_exhaustive AND image_id NOT IN (SELECT image_id FROM {_EXHAUSTIVE} WHERE annotator <> 0 AND NOT is_instance_exhaustive)")
def exhaustive_images(spark, d):
    rows = view(spark, d, "np").select("image_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("annotator"))
    return R.exhaustive_images(rows.withColumn("is_instance_exhaustive", (F.col("image_id") + F.col("annotator")) % 5 != 0))


_F1 = "CASE WHEN (image_id + a.i * 3) % 4 = 0 THEN NULL ELSE (image_id * (a.i + 1)) % 10 END"
_STEP = "CASE WHEN {0} IS NOT NULL AND {1} IS NOT NULL THEN {1} > {0} ELSE {1} IS NULL END"


@register(f"""SELECT image_id, CASE WHEN {_STEP.format('m', 'f2')} THEN 2 ELSE b END AS annotator FROM (SELECT *, CASE WHEN {_STEP.format('f0', 'f1')} THEN 1 ELSE 0 END AS b, CASE WHEN {_STEP.format('f0', 'f1')} THEN f1 ELSE f0 END AS m FROM (
  SELECT image_id, {_F1.replace('a.i', '0')} AS f0, {_F1.replace('a.i', '1')} AS f1, {_F1.replace('a.i', '2')} AS f2 FROM (SELECT DISTINCT image_id FROM np)))""")
def best_annotator(spark, d):
    rows = view(spark, d, "np").select("image_id").distinct().withColumn("annotator", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return R.best_annotator(rows.withColumn("mean_f1", F.when((F.col("image_id") + F.col("annotator") * 3) % 4 != 0, (F.col("image_id") * (F.col("annotator") + 1)) % 10))).select("image_id", "annotator")


@register("""SELECT image_id, det_id, ann_id FROM (SELECT p.image_id, p.det_id, p.ann_id, merit, quantile_cont(merit, 0.9) OVER (PARTITION BY p.image_id, p.ann_id) AS cut FROM (
  SELECT g.image_id, g.ann_id, t.det_id, 0.3 * t.score + 0.7 * i / (g.w * g.h + t.w * t.h - i) AS merit FROM gt_boxes g JOIN dt_boxes t ON g.image_id = t.image_id, LATERAL (SELECT """ + _BOTH.format("g", "t") + """ AS i)) p) WHERE merit > cut AND merit > 0.4""")
def one_to_many_match(spark, d):
    from .operators.tables import candidate_pairs

    dt = view(spark, d, "dt_boxes")
    pairs = candidate_pairs(view(spark, d, "gt_boxes"), dt, "image_id").join(dt.select("det_id", F.col("score").alias("prob")), "det_id")
    rows = pairs.select("image_id", F.col("det_id").alias("query"), F.col("ann_id").alias("target"), "prob", "iou")
    return M.one_to_many_match(rows, "image_id", 10, top=1).select("image_id", F.col("query").alias("det_id"), F.col("target").alias("ann_id"))


_FRAME = """(SELECT g.image_id AS frame, t.det_id, g.ann_id AS track_id, i / (g.w * g.h + t.w * t.h - i) AS iou FROM gt_boxes g JOIN dt_boxes t ON g.image_id = t.image_id, LATERAL (SELECT """ + _BOTH.format("g", "t") + """ AS i))"""


@register(f"""SELECT * FROM (WITH p AS MATERIALIZED {_FRAME}, near AS MATERIALIZED (SELECT * FROM p WHERE iou >= 0.5),
  new AS MATERIALIZED (SELECT t.image_id AS frame, t.det_id FROM dt_boxes t LEFT JOIN (SELECT DISTINCT frame, det_id FROM near) n ON n.frame = t.image_id AND n.det_id = t.det_id WHERE t.score >= 0.7 AND n.det_id IS NULL),
  best AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY frame, det_id ORDER BY iou DESC, track_id) AS k FROM p WHERE iou >= 0.8)
  SELECT frame, 'new' AS kind, det_id, CAST(NULL AS BIGINT) AS track_id FROM new UNION ALL SELECT frame, 'matched', det_id, track_id FROM near
  UNION ALL SELECT g.image_id, 'unmatched', NULL, g.ann_id FROM gt_boxes g LEFT JOIN (SELECT DISTINCT frame, track_id FROM near) n ON n.frame = g.image_id AND n.track_id = g.ann_id WHERE g.iscrowd = 0 AND n.track_id IS NULL
  UNION ALL SELECT image_id, 'empty', NULL, ann_id FROM gt_boxes WHERE iscrowd = 1
  UNION ALL SELECT q.frame, 'sure', q.det_id, q.track_id FROM best q JOIN dt_boxes t ON t.image_id = q.frame AND t.det_id = q.det_id LEFT JOIN new n ON n.frame = q.frame AND n.det_id = q.det_id WHERE k = 1 AND t.score >= 0.8 AND n.det_id IS NULL)""")
def associate(spark, d):
    from .operators.tables import candidate_pairs

    gt, dt = view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes")
    pairs = candidate_pairs(gt, dt, "image_id").select(F.col("image_id").alias("frame"), "det_id", F.col("ann_id").alias("track_id"), "iou")
    dets = dt.select(F.col("image_id").alias("frame"), "det_id", "score")
    tracks = gt.select(F.col("image_id").alias("frame"), F.col("ann_id").alias("track_id"), (F.col("iscrowd") == 1).alias("is_empty"))
    return M.associate(dets, tracks, pairs)


@register()
def filtered_assignment(spark, d):
    from .operators.tables import candidate_pairs

    pairs = candidate_pairs(view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes"), "image_id", "category_id")
    costs = pairs.withColumn("cost", F.when(F.col("iou") > 0, 1 - F.col("iou")).otherwise(1e8))
    return M.filtered_assignment(costs, "image_id", "det_id", "ann_id", "cost", 2)


@register()
def oracle_cgf1(spark, d):
    """Three annotators, of whom the second and third miss some objects."""
    gt = view(spark, d, "gt_boxes")
    images = view(spark, d, "np").select("image_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("annotator")).withColumn("is_instance_exhaustive", (F.col("image_id") + F.col("annotator")) % 5 != 0)
    rows = F1.oracle_cgf1(images, [gt, gt.filter("ann_id % 13 <> 0"), gt.filter("ann_id % 11 <> 0")], view(spark, d, "dt_boxes"))
    return F1.concept_f1(rows)


def _by_image(spark, d, runs=None):
    return F1.image_eval(view(spark, d, "image_np"), view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes"), runs=runs)


def _runs(spark, d):
    return view(spark, d, "mask_runs"), view(spark, d, "dt_runs")


@register()
def evaluate_cgf1_masks(spark, d):
    return F1.concept_f1(_by_image(spark, d, _runs(spark, d)))


@register()
def demo_metrics(spark, d):
    return F1.demo_metrics(_by_image(spark, d))


def _edge(runs):
    """The first and last pixel of each run stand for the boundary."""
    ends = F.explode(F.array("row_start", F.col("row_start") + F.col("run_len") - 1))
    return runs.select("image_id", "ann_id", "col", ends.alias("row_start"), F.lit(1).cast("long").alias("run_len"))


@register()
def demo_summary(spark, d):
    gt, dt, runs = view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes"), _runs(spark, d)
    edges = tuple(_edge(r) for r in runs)
    wide = tuple(e.withColumns({"row_start": F.col("row_start") - 2, "run_len": F.lit(5).cast("long")}) for e in edges)
    return F1.demo_summary(_by_image(spark, d, runs), F1.region_boundary(gt, dt, runs, edges, wide))


def _track_cgf1(spark, d):
    gt = view(spark, d, "gt_tracks")
    declared = gt.select("video_id", F.lit(9).cast("long").alias("category_id")).distinct()
    return F1.evaluate_track_cgf1(gt, view(spark, d, "dt_tracks"), declared)


@register()
def evaluate_track_cgf1(spark, d):
    return _track_cgf1(spark, d)[0]


@register()
def pair_f1(spark, d):
    return _track_cgf1(spark, d)[1]


_MASK_PAIRS = """(SELECT g.video_id, g.category_id, g.frame_idx, g.track_id AS gt_id, t.track_id AS dt_id, sum(least(g.row_start + g.run_len, t.row_start + t.run_len) - greatest(g.row_start, t.row_start)) AS i
  FROM gt_track_runs g JOIN dt_track_runs t ON g.video_id = t.video_id AND g.category_id = t.category_id AND g.frame_idx = t.frame_idx AND g.col = t.col AND g.row_start < t.row_start + t.run_len AND t.row_start < g.row_start + g.run_len GROUP BY ALL)"""


@register(f"""SELECT p.video_id, p.category_id, p.frame_idx, p.gt_id, p.dt_id, round(i / (ga + da - i), 9) AS sim FROM {_MASK_PAIRS} p
  JOIN (SELECT video_id, category_id, frame_idx, track_id AS gt_id, sum(run_len) AS ga FROM gt_track_runs GROUP BY ALL) USING (video_id, category_id, frame_idx, gt_id)
  JOIN (SELECT video_id, category_id, frame_idx, track_id AS dt_id, sum(run_len) AS da FROM dt_track_runs GROUP BY ALL) USING (video_id, category_id, frame_idx, dt_id)""")
def mask_frame_pairs(spark, d):
    out = K.mask_frame_pairs(view(spark, d, "gt_track_runs"), view(spark, d, "dt_track_runs"), ["video_id", "category_id"])
    return out.withColumn("sim", F.round("sim", 9))


@register()
def evaluate_track_map_masks(spark, d):
    return A.evaluate_track_map(view(spark, d, "gt_track_runs"), view(spark, d, "dt_track_runs"), masks=True)


@register()
def evaluate_track_cgf1_masks(spark, d):
    gt = view(spark, d, "gt_track_runs")
    declared = gt.select("video_id", F.lit(9).cast("long").alias("category_id")).distinct()
    return F1.evaluate_track_cgf1(gt, view(spark, d, "dt_track_runs"), declared, masks=True)[0]


@register()
def evaluate_hota_masks(spark, d):
    return H.evaluate_hota(view(spark, d, "gt_track_runs"), view(spark, d, "dt_track_runs"), masks=True).filter("level <> 'sequence'")


def _other_classes(spark, d):
    """Predictions of which some carry another class than what they lie over."""
    dt = view(spark, d, "dt_tracks")
    return dt.withColumn("category_id", F.when(F.col("track_id") % 5 == 0, F.col("category_id") % 4 + 1).otherwise(F.col("category_id")))


@register()
def teta_sequence(spark, d):
    counts = E.teta_counts(view(spark, d, "gt_tracks"), _other_classes(spark, d))
    return E.teta_summary(E.teta_combine(counts, "video_id", "category_id"), "video_id", "category_id")


@register()
def evaluate_teta(spark, d):
    return E.evaluate_teta(view(spark, d, "gt_tracks"), _other_classes(spark, d), "track", exhaustive=True)


@register()
def evaluate_video_suite(spark, d):
    """Every video evaluation's headline metrics as one table of metric and value."""
    gt, dt = view(spark, d, "gt_tracks"), view(spark, d, "dt_tracks")
    parts = [A.mean_precision(A.evaluate_track_map(gt, dt, by)).filter("area_range = 'all'").select(F.explode(F.array(*(F.struct(F.lit(f"{name}_{c}").alias("metric"), F.col(c).alias("value")) for c in ("ap", "ap50", "ap75", "ar")))).alias("m")).select("m.*") for by, name in ((True, "track"), (False, "phrase"))]
    cgf1 = F1.summarize(_track_cgf1(spark, d)[0])
    parts.append(cgf1.select(F.explode(F.array(*(F.struct(F.lit(f"track_{c}").alias("metric"), F.col(c).alias("value")) for c in cgf1.columns))).alias("m")).select("m.*"))
    levels = H.alpha_means(H.evaluate_hota(gt, dt, "phrase").filter("level = 'detection_average'"), "level")
    parts.append(levels.select(F.explode(F.array(*(F.struct(F.lit(f"phrase_{c}").alias("metric"), F.col(c).alias("value")) for c in levels.columns if c != "level"))).alias("m")).select("m.*"))
    teta = E.evaluate_teta(gt, dt)
    parts.append(teta.select(F.explode(F.array(*(F.struct(F.lit(c if c == "teta" else f"teta_{c}").alias("metric"), F.col(c).alias("value")) for c in teta.columns))).alias("m")).select("m.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@register("SELECT video_id, track_id, frame_idx FROM gt_tracks WHERE video_id NOT IN (SELECT video_id FROM gt_tracks WHERE track_id % 7 = 0)")
def tagged_only(spark, d):
    """Videos all of whose tracks are tagged hard: those without a track number that 7 divides."""
    gt = view(spark, d, "gt_tracks").withColumn("tags", F.when(F.col("track_id") % 7 == 0, F.array(F.lit("easy"))).otherwise(F.array(F.lit("easy"), F.lit("hard"))))
    return H.tagged_only(gt, "hard").select("video_id", "track_id", "frame_idx")

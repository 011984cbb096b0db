"""Registered queries over annotation tables derived from the given ones, with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import boxes as B
from .operators import curation as C, matching as M, tables as T
from .plans.concept_f1 import concept_f1, image_eval, summarize
from .views import register, registered, registered_sql, view

_IOU = """(SELECT g.image_id, g.category_id, g.ann_id, d.det_id, g.w * g.h AS ga, d.w * d.h AS da,
  greatest(least(g.x + g.w, d.x + d.w) - greatest(g.x, d.x), 0.0) * greatest(least(g.y + g.h, d.y + d.h) - greatest(g.y, d.y), 0.0) AS i
  FROM gt_boxes g JOIN dt_boxes d ON g.image_id = d.image_id AND g.category_id = d.category_id)"""

@register()
def evaluate_cgf1(spark, d):
    return concept_f1(image_eval(view(spark, d, "image_np"), view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes")))


@register()
def summarize_cgf1(spark, d):
    return summarize(evaluate_cgf1(spark, d))


@register()
def mean_target_iou(spark, d):
    gt = view(spark, d, "gt_boxes")
    matched = M.optimal_match(T.candidate_pairs(gt, view(spark, d, "dt_boxes"), "image_id"), "image_id", "ann_id", "det_id", "iou")
    return T.mean_target_iou(view(spark, d, "image_np"), gt, matched)


@register()
def optimal_match(spark, d):
    return M.optimal_match(T.candidate_pairs(view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes"), "image_id"), "image_id", "ann_id", "det_id", "iou")


@register("SELECT image_id, det_id, score FROM dt_boxes WHERE score >= 0.5")
def score_filter(spark, d):
    return T.score_filter(view(spark, d, "dt_boxes"), 0.5).select("image_id", "det_id", "score")


@register("SELECT image_id, ann_id FROM gt_boxes WHERE iscrowd = 0")
def drop_crowd_gt(spark, d):
    return T.drop_crowd(view(spark, d, "gt_boxes")).select("image_id", "ann_id")


@register("SELECT image_id, category_id, det_id FROM dt_boxes d WHERE EXISTS (SELECT 1 FROM gt_boxes g WHERE g.iscrowd = 0 AND g.image_id = d.image_id AND g.category_id = d.category_id)")
def positive_split(spark, d):
    return T.positive_split(view(spark, d, "dt_boxes"), T.drop_crowd(view(spark, d, "gt_boxes")), "image_id", "category_id").select("image_id", "category_id", "det_id")


@register("SELECT det_id FROM dt_boxes WHERE (x + w / 2) / 640 > 0.025 AND (x + w / 2) / 640 < 0.975 AND (y + h / 2) / 480 > 0.025 AND (y + h / 2) / 480 < 0.975")
def away_from_border(spark, d):
    return view(spark, d, "dt_boxes").filter(B.away_from_border(B.box(), F.lit(640), F.lit(480))).select("det_id")


@register(f"SELECT image_id, category_id, ann_id, det_id, round(i / (ga + da - i), 9) AS iou FROM {_IOU} WHERE i / (ga + da - i) >= 0.5")
def candidate_pairs(spark, d):
    pairs = T.candidate_pairs(view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes"), "image_id", "category_id")
    return pairs.filter("iou >= 0.5").withColumn("iou", F.round("iou", 9))


@register(f"SELECT image_id, count(*) AS n_pairs, round(avg(i / (ga + da - i)), 6) AS mean_iou FROM {_IOU} WHERE i > 0 GROUP BY image_id")
def mean_iou(spark, d):
    pairs = T.candidate_pairs(view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes"), "image_id", "category_id").filter("iou > 0")
    return pairs.groupBy("image_id").agg(F.count("*").alias("n_pairs"), F.round(F.avg("iou"), 6).alias("mean_iou"))


@register("SELECT i.image_id, count(g.ann_id) AS n_annotations FROM (SELECT DISTINCT image_id FROM image_np) i LEFT JOIN gt_boxes g ON g.image_id = i.image_id GROUP BY i.image_id")
def annotations_by_image(spark, d):
    images = view(spark, d, "image_np").select("image_id").distinct()
    return images.join(view(spark, d, "gt_boxes"), "image_id", "left").groupBy("image_id").agg(F.count("ann_id").alias("n_annotations"))


@register("SELECT image_id, det_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, det_id) AS rank FROM dt_boxes) WHERE rank <= 3")
def top_detections(spark, d):
    return T.top_detections(view(spark, d, "dt_boxes"), 3).select("image_id", "det_id", "score", "rank")


@register("SELECT video_id, frame_idx, track_id, dense_rank() OVER (PARTITION BY video_id, category_id ORDER BY track_id) - 1 AS label FROM dt_tracks")
def relabel_contiguous(spark, d):
    tracks = view(spark, d, "dt_tracks")
    return tracks.withColumn("label", T.relabel_contiguous(tracks, "track_id", "video_id", "category_id")).select("video_id", "frame_idx", "track_id", "label")


_SHARDS = "(SELECT image_id, det_id, 0 AS shard FROM dt_boxes UNION ALL SELECT image_id, det_id + 7 AS det_id, 1 AS shard FROM dt_boxes WHERE category_id < 3)"


@register(f"SELECT image_id, det_id, shard FROM (SELECT *, min(shard) OVER (PARTITION BY image_id) AS first FROM {_SHARDS}) WHERE shard = first")
def dedup_shards(spark, d):
    a = view(spark, d, "dt_boxes").select("image_id", "category_id", "det_id")
    b = a.filter("category_id < 3").select("image_id", (F.col("det_id") + 7).alias("det_id"), F.lit(1).alias("shard"))
    return T.dedup_shards(a.select("image_id", "det_id", F.lit(0).alias("shard")).unionByName(b), "image_id", "shard")


@register("SELECT video_id, count(*) AS n_boxes, count(DISTINCT track_id) AS n_ids, count(DISTINCT frame_idx) AS n_frames FROM dt_tracks GROUP BY video_id")
def count_metrics(spark, d):
    return T.count_metrics(view(spark, d, "dt_tracks"))


_BOTH = """(SELECT video_id, count(*) FILTER (s = 0) AS dets, count(*) FILTER (s = 1) AS gt_dets, count(DISTINCT track_id) FILTER (s = 0) AS ids,
  count(DISTINCT track_id) FILTER (s = 1) AS gt_ids, count(DISTINCT frame_idx) AS frames FROM (SELECT video_id, frame_idx, track_id, 1 AS s FROM gt_tracks
  UNION ALL SELECT video_id, frame_idx, track_id, 0 AS s FROM dt_tracks) GROUP BY video_id)"""


@register(f"SELECT * FROM {_BOTH} UNION ALL SELECT NULL, {', '.join(f'CAST(sum({c}) AS BIGINT)' for c in ('dets', 'gt_dets', 'ids', 'gt_ids', 'frames'))} FROM {_BOTH}")
def count_both(spark, d):
    return T.count_both(view(spark, d, "gt_tracks"), view(spark, d, "dt_tracks"))


@register("SELECT coalesce(g.image_id, t.image_id) AS image_id, coalesce(g.category_id, t.category_id) AS category_id, coalesce(g.a, 0) AS in_gt, coalesce(t.b, 0) AS in_dt FROM (SELECT DISTINCT image_id, category_id, 1 AS a FROM gt_boxes) g FULL JOIN (SELECT DISTINCT image_id, category_id, 1 AS b FROM dt_boxes) t ON g.image_id = t.image_id AND g.category_id = t.category_id")
def pair_universe(spark, d):
    return T.pair_universe(view(spark, d, "gt_boxes"), view(spark, d, "dt_boxes"), "image_id", "category_id")


_MATCHED = "(SELECT video_id, track_id, frame_idx, (x + y + frame_idx) % 5 <> 0 AS matched FROM gt_tracks)"


@register(f"""SELECT video_id, track_id, frame_idx, matched, streak, max(streak) OVER (PARTITION BY video_id, track_id ORDER BY frame_idx) >= 3 AS confirmed FROM (
  SELECT *, CAST(sum(CASE WHEN matched THEN 1 ELSE 0 END) OVER (PARTITION BY video_id, track_id, island ORDER BY frame_idx) AS BIGINT) AS streak FROM (
  SELECT *, sum(CASE WHEN matched THEN 0 ELSE 1 END) OVER (PARTITION BY video_id, track_id ORDER BY frame_idx) AS island FROM {_MATCHED}))""")
def confirm_tracks(spark, d):
    frames = view(spark, d, "gt_tracks").select("video_id", "track_id", "frame_idx", ((F.col("x") + F.col("y") + F.col("frame_idx")) % 5 != 0).alias("matched"))
    return T.confirm_tracks(frames, 3)


@register("""SELECT b.video_id, b.category_id, gt_track, dt_track, round(i / (ga + da - i), 9) AS iou FROM (
  SELECT g.video_id, g.category_id, g.track_id AS gt_track, t.track_id AS dt_track,
  sum(greatest(least(g.x + g.w, t.x + t.w) - greatest(g.x, t.x), 0.0) * greatest(least(g.y + g.h, t.y + t.h) - greatest(g.y, t.y), 0.0)) AS i
  FROM gt_tracks g JOIN dt_tracks t ON g.video_id = t.video_id AND g.category_id = t.category_id AND g.frame_idx = t.frame_idx GROUP BY ALL) b
  JOIN (SELECT video_id, category_id, track_id AS gt_track, sum(w * h) AS ga FROM gt_tracks GROUP BY ALL) USING (video_id, category_id, gt_track)
  JOIN (SELECT video_id, category_id, track_id AS dt_track, sum(w * h) AS da FROM dt_tracks GROUP BY ALL) USING (video_id, category_id, dt_track) WHERE i > 0""")
def track_box_iou(spark, d):
    return T.track_box_iou(view(spark, d, "gt_tracks"), view(spark, d, "dt_tracks")).withColumn("iou", F.round("iou", 9))


@register("SELECT image_id, ann_id, CAST(sum(run_len) AS BIGINT) AS area, min(col) AS x0, min(row_start) AS y0, max(col) AS x1, max(row_start + run_len - 1) AS y1 FROM mask_runs GROUP BY image_id, ann_id")
def mask_box(spark, d):
    return T.mask_boxes(view(spark, d, "mask_runs"))


@register("""SELECT p.image_id, p.ann_id AS a, q.ann_id AS b, CAST(sum(least(p.row_start + p.run_len, q.row_start + q.run_len) - greatest(p.row_start, q.row_start)) AS BIGINT) AS pixels
  FROM mask_runs p JOIN mask_runs q ON p.image_id = q.image_id AND p.col = q.col AND p.ann_id < q.ann_id
  AND p.row_start < q.row_start + q.run_len AND q.row_start < p.row_start + p.run_len GROUP BY ALL""")
def run_overlap_join(spark, d):
    return T.mask_overlaps(view(spark, d, "mask_runs"))


@register("""SELECT conv_id, turn, role, text FROM (SELECT *, max(CASE WHEN turn > 1 AND role = 'assistant' AND contains(text, 'de') AND contains(text, 'en') THEN turn END)
  OVER (PARTITION BY conv_id) AS last FROM conversations) WHERE turn < 2 OR turn >= last""")
def compact_history(spark, d):
    return T.compact_history(spark.read.parquet(f"{d}/conversations.parquet"), "de", "en")


@register("SELECT det_id, category_id FROM dt_boxes WHERE category_id IN (SELECT category_id FROM gt_boxes WHERE iscrowd = 1)")
def category_subset(spark, d):
    return C.category_subset(view(spark, d, "dt_boxes"), view(spark, d, "gt_boxes").filter("iscrowd = 1")).select("det_id", "category_id")


@register("SELECT det_id FROM dt_boxes WHERE w > 30 AND h > 30")
def valid_box(spark, d):
    return view(spark, d, "dt_boxes").filter(C.valid_box(B.box(), 30)).select("det_id")


@register("SELECT det_id FROM dt_boxes WHERE x >= -2 AND y >= -2 AND x + w < 642 AND y + h < 482")
def inside_box(spark, d):
    return view(spark, d, "dt_boxes").filter(C.inside_box(B.box(), F.lit(640), F.lit(480), 2)).select("det_id")


@register("""SELECT * FROM gt_tracks WHERE video_id NOT IN (SELECT video_id FROM (SELECT video_id, frame_idx, count(*) AS n,
  min(frame_idx) OVER (PARTITION BY video_id) AS first FROM gt_tracks GROUP BY video_id, frame_idx) WHERE frame_idx = first AND n > 4)""")
def max_tracks_per_video(spark, d):
    return C.max_tracks_per_video(view(spark, d, "gt_tracks"), 4)


@register("SELECT ann_id, CAST(CASE category_id WHEN 3 THEN 1 WHEN 4 THEN 2 ELSE category_id END AS BIGINT) AS category_id FROM gt_boxes")
def merge_categories(spark, d):
    gt = view(spark, d, "gt_boxes").withColumn("category_id", F.col("category_id").cast("long"))
    targets = gt.filter("category_id > 2").select("category_id", (F.col("category_id") - 2).alias("target")).distinct()
    return C.merge_categories(gt, targets).select("ann_id", "category_id")


_COUNTS = "SELECT '{0}' AS table_name, count(*) AS n_before, count(*) FILTER (image_id IN (SELECT image_id FROM dt_boxes)) AS n_after, count(*) FILTER (image_id NOT IN (SELECT image_id FROM dt_boxes)) AS n_removed FROM {0}"


@register(f"{_COUNTS.format('image_np')} UNION ALL {_COUNTS.format('gt_boxes')}")
def availability_filter(spark, d):
    return C.availability({n: view(spark, d, n) for n in ("image_np", "gt_boxes")}, view(spark, d, "dt_boxes"), "image_id")


_KEPT = "SELECT '{0}' AS table_name, image_id, {1} AS row_id FROM {0} WHERE image_id IN (SELECT image_id FROM dt_boxes WHERE score >= 0.5)"


@register(f"{_KEPT.format('image_np', 'phrase_id')} UNION ALL {_KEPT.format('gt_boxes', 'ann_id')}")
def available_tables(spark, d):
    """Images and annotations of the images that have a sure prediction."""
    kept = C.available_tables({n: view(spark, d, n) for n in ("image_np", "gt_boxes")}, view(spark, d, "dt_boxes").filter("score >= 0.5"), "image_id")
    rows = [kept[n].select(F.lit(n).alias("table_name"), "image_id", F.col(c).alias("row_id")) for n, c in (("image_np", "phrase_id"), ("gt_boxes", "ann_id"))]
    return rows[0].unionByName(rows[1])


@register("""SELECT video_id, frame_idx, ref_frame, rank FROM (SELECT *, row_number() OVER (PARTITION BY video_id, frame_idx ORDER BY later, distance, ref_frame) AS rank FROM (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY video_id, frame_idx, ref_frame < frame_idx ORDER BY distance) > 1 THEN 1 ELSE 0 END AS later FROM (
  SELECT video_id, frame_idx, ref_frame, abs(frame_idx - ref_frame) AS distance FROM (SELECT DISTINCT video_id, frame_idx FROM gt_tracks)
  JOIN (SELECT DISTINCT video_id, frame_idx AS ref_frame FROM dt_tracks) USING (video_id)))) WHERE rank <= 3""")
def nearest_frames(spark, d):
    return C.nearest_frames(view(spark, d, "gt_tracks"), view(spark, d, "dt_tracks"), 3)


@register(f"""SELECT image_id, ann_id, det_id FROM (SELECT *, row_number() OVER (PARTITION BY ann_id ORDER BY CASE WHEN top > 0 THEN iou ELSE score END DESC, det_id) AS rank FROM (
  SELECT p.image_id, ann_id, p.det_id, round(i / (ga + da - i), 9) AS iou, score, max(round(i / (ga + da - i), 9)) OVER (PARTITION BY ann_id) AS top
  FROM {_IOU} p JOIN dt_boxes s ON p.image_id = s.image_id AND p.det_id = s.det_id)) WHERE rank = 1""")
def best_candidate(spark, d):
    dt = view(spark, d, "dt_boxes")
    pairs = T.candidate_pairs(view(spark, d, "gt_boxes"), dt, "image_id", "category_id").withColumn("iou", F.round("iou", 9))
    return C.best_candidate(pairs.join(dt.select("image_id", "det_id", "score"), ["image_id", "det_id"]), "ann_id", "det_id").select("image_id", "ann_id", "det_id")


@register("SELECT video_id, frame_idx, track_id % 3 AS track_id, count(*) AS n_rows FROM dt_tracks GROUP BY 1, 2, 3 HAVING count(*) > 1")
def repeated_ids(spark, d):
    return C.repeated_ids(view(spark, d, "dt_tracks").withColumn("track_id", F.col("track_id") % 3))


@register("SELECT video_id, track_id, sum(w * h) / 8 AS mean_area, sum(w * h) / count(*) AS mean_seen_area FROM dt_tracks GROUP BY video_id, track_id")
def track_area(spark, d):
    return C.track_area(view(spark, d, "dt_tracks"), 8)


@register("""SELECT phrase_id, count(*) AS n_images, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_masks, count(n) AS n_positive, count(*) - count(n) AS n_negative
  FROM image_np LEFT JOIN (SELECT image_id, count(*) AS n FROM gt_boxes GROUP BY image_id) USING (image_id) GROUP BY phrase_id""")
def benchmark_profile(spark, d):
    return C.benchmark_profile(view(spark, d, "image_np"), view(spark, d, "gt_boxes"), "phrase_id")


@register("""SELECT image_id, col, min(row_start) AS row_start, max(row_end) - min(row_start) AS run_len FROM (
  SELECT *, sum(CASE WHEN reach >= row_start THEN 0 ELSE 1 END) OVER (PARTITION BY image_id, col ORDER BY row_start, row_end ROWS UNBOUNDED PRECEDING) AS part FROM (
  SELECT image_id, col, row_start, row_start + run_len AS row_end, max(row_start + run_len) OVER (PARTITION BY image_id, col ORDER BY row_start, row_start + run_len
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM mask_runs)) GROUP BY image_id, col, part""")
def mask_union(spark, d):
    return C.mask_union(view(spark, d, "mask_runs"), "image_id")


@register("SELECT conv_id, count(*) FILTER (role = 'assistant') AS n_items FROM conversations GROUP BY conv_id")
def count_items(spark, d):
    return C.count_items(spark.read.parquet(f"{d}/conversations.parquet"), "assistant")


@register("SELECT image_id, det_id, round(x, 5) AS x, round(y, 5) AS y, round(w, 5) AS w, round(h, 5) AS h, round(score, 5) AS score FROM dt_boxes")
def write_predictions(spark, d):
    return C.write_form(view(spark, d, "dt_boxes")).select("image_id", "det_id", "x", "y", "w", "h", "score")


# each module puts its own queries in the register
for _module in ("curation", "metrics", "reshape", "shapes"):
    import_module(f".queries_{_module}", __package__)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return registered()


def oracle_sql() -> dict[str, str]:
    return registered_sql()

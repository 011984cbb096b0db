"""Queries over boxes and masks, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import boxes as B, text as X
from .operators import curation as C, masks as K, suppression as S
from .views import register, view


def _rounded(df, *names: str):
    return df.withColumns({n: F.round(n, 6) for n in names})


def _named(values, names):
    return [v.cast("double").alias(n) for v, n in zip(values, names, strict=True)]


@register("SELECT ann_id, x + w AS x1, y + h AS y1, x + w / 2 AS cx, y + h / 2 AS cy, TRUE AS back FROM gt_boxes")
def box_convert(spark, d):
    """All conversions; `back` says that going there and back gives the box again."""
    b = B.box()
    there = [B.corners_to_box(B.to_corners(b)), B.centre_to_box(B.to_centre(b)), B.corners_to_box(B.centre_to_corners(B.corners_to_centre(B.to_corners(b))))]
    same = F.lit(True)
    for other in there:
        for u, v in zip(b, other, strict=True):
            same = same & (F.abs(u - v) < 1e-9)
    return view(spark, d, "gt_boxes").select("ann_id", B.to_corners(b)[2].alias("x1"), B.to_corners(b)[3].alias("y1"), B.to_centre(b)[0].alias("cx"), B.to_centre(b)[1].alias("cy"), same.alias("back"))


@register("""SELECT ann_id, w * h AS area, x + w / 2 AS cx, x * 2 AS sx, h * 3 AS sh, least(greatest(x - 50, 0.0), 300.0) AS c0, least(greatest(y - 50 + h, 0.0), 200.0) AS c3 FROM gt_boxes""")
def box_area(spark, d):
    b = B.box()
    scaled, moved = B.scale(b, 2, 3), B.to_corners((F.col("x") - 50, F.col("y") - 50, F.col("w"), F.col("h")))
    cut = B.clip(moved, F.lit(200.0), F.lit(300.0))
    return view(spark, d, "gt_boxes").select("ann_id", B.area(b).alias("area"), B.centre(b)[0].alias("cx"), scaled[0].alias("sx"), scaled[3].alias("sh"), cut[0].alias("c0"), cut[3].alias("c3"))


_PAIR = """(SELECT g.image_id, g.ann_id, t.det_id, g.w * g.h AS ga, t.w * t.h AS da, greatest(least(g.x + g.w, t.x + t.w) - greatest(g.x, t.x), 0.0) * greatest(least(g.y + g.h, t.y + t.h) - greatest(g.y, t.y), 0.0) AS i,
  (greatest(g.x + g.w, t.x + t.w) - least(g.x, t.x)) * (greatest(g.y + g.h, t.y + t.h) - least(g.y, t.y)) AS hull, g.x + g.w / 2 - t.x - t.w / 2 AS ex, g.y + g.h / 2 - t.y - t.h / 2 AS ey FROM gt_boxes g JOIN dt_boxes t ON g.image_id = t.image_id)"""


def _pairs(spark, d):
    g = view(spark, d, "gt_boxes").select("image_id", "ann_id", *(F.col(c).alias(f"gt_{c}") for c in "xywh"))
    return g.join(view(spark, d, "dt_boxes").select("image_id", "det_id", *(F.col(c).alias(f"dt_{c}") for c in "xywh")), "image_id")


@register(f"SELECT ann_id, det_id, round(i / (ga + da - i), 6) AS iou, round(i / (ga + da - i) - (hull - (ga + da - i)) / hull, 6) AS giou, round(i / ga, 6) AS ioa, round(i / da, 6) AS ioa_second FROM {_PAIR}")
def box_similarity(spark, d):
    g, t = B.box("gt_"), B.box("dt_")
    out = _pairs(spark, d).select("ann_id", "det_id", B.iou(g, t).alias("iou"), B.giou(g, t).alias("giou"), B.ioa(g, t).alias("ioa"), B.ioa(g, t, True).alias("ioa_second"))
    return _rounded(out, "iou", "giou", "ioa", "ioa_second")


@register(f"SELECT ann_id, det_id, round(i / (ga + da - i), 6) AS iou, round(i / ga, 6) AS ioa, i AS inter, ga + da - i AS union_area FROM {_PAIR}")
def sql_functions(spark, d):
    """The box functions called from SQL."""
    B.register_sql_functions(spark)
    a, b = ", ".join(f"gt_{c}" for c in "xywh"), ", ".join(f"dt_{c}" for c in "xywh")
    return spark.sql(f"SELECT ann_id, det_id, round(box_iou({a}, {b}), 6) AS iou, round(box_ioa({a}, {b}), 6) AS ioa, box_inter({a}, {b}) AS inter, box_union({a}, {b}) AS union_area FROM {{pairs}}", pairs=_pairs(spark, d))


@register(f"SELECT ann_id, det_id, round(greatest(0, 1 - sqrt(ex * ex + ey * ey) / 40), 6) AS similarity FROM {_PAIR}")
def euclidean_similarity(spark, d):
    out = _pairs(spark, d).select("ann_id", "det_id", B.euclidean_similarity(B.centre(B.box("gt_")), B.centre(B.box("dt_")), 40.0).alias("similarity"))
    return _rounded(out, "similarity")


@register("SELECT ann_id, 100 - x AS to_left, 90 - y AS to_top, x + w - 100 AS to_right, y + h - 90 AS to_bottom FROM gt_boxes")
def point_box_distance(spark, d):
    out = B.point_box_distance(F.lit(100.0), F.lit(90.0), B.to_corners(B.box()))
    return view(spark, d, "gt_boxes").select("ann_id", *_named(out, ("to_left", "to_top", "to_right", "to_bottom")))


@register("""SELECT ann_id, round(x - (abs(cos(radians(a))) * w + abs(sin(radians(a))) * h) / 2, 6) AS x0, round(y + (abs(cos(radians(a))) * h + abs(sin(radians(a))) * w) / 2, 6) AS y1,
  a - 360 * floor((a + 180) / 360) AS angle FROM (SELECT *, CAST(ann_id % 720 - 360 AS DOUBLE) AS a FROM gt_boxes)""")
def rotated_boxes(spark, d):
    rows = view(spark, d, "gt_boxes").withColumn("a", (F.col("ann_id") % 720 - 360).cast("double"))
    c = B.rotated_to_corners((*B.box(), F.col("a")))
    return _rounded(rows.select("ann_id", c[0].alias("x0"), c[3].alias("y1"), B.normalize_angle(F.col("a")).alias("angle")), "x0", "y1")


@register("SELECT ann_id, w * h / 2 AS triangle, w * h AS square FROM gt_boxes")
def polygon_area(spark, d):
    x, y, w, h = B.box()
    triangle = B.polygon_area(F.array(x, x + w, x), F.array(y, y, y + h))
    square = B.polygon_area(F.array(x, x + w, x + w, x), F.array(y, y, y + h, y + h))
    return view(spark, d, "gt_boxes").select("ann_id", triangle.alias("triangle"), square.alias("square"))


@register("SELECT det_id, round(least(greatest(x / 640, 0.0), 1.0), 9) AS rx, round(least(greatest(h / 480, 0.0), 1.0), 9) AS rh, least(greatest(x, 0.0), 640.0) AS px, least(greatest(y + h, 0.0), 480.0) AS py1 FROM dt_boxes")
def normalize_boxes(spark, d):
    b = B.box()
    n = B.normalize(b, F.lit(640.0), F.lit(480.0))
    p = B.scale_to_image(tuple(v / s for v, s in zip(b, (640.0, 480.0, 640.0, 480.0), strict=True)), F.lit(640.0), F.lit(480.0))
    return view(spark, d, "dt_boxes").select("det_id", F.round(n[0], 9).alias("rx"), F.round(n[3], 9).alias("rh"), F.round(p[0], 6).alias("px"), F.round(p[3], 6).alias("py1"))


@register("""SELECT ann_id, least(greatest(x - 40, 0.0), 200.0) AS cropped, 640 - x - w AS flipped, x + 7 AS padded, least(greatest(round(x + w / 2 - w * 0.75, 6), 0.0), 640.0) AS grown,
  CAST(CASE WHEN w < h THEN 100 WHEN h = 100 THEN w ELSE floor(100 * w / h) END AS BIGINT) AS new_width FROM gt_boxes WHERE w <> h""")
def transform_boxes(spark, d):
    c = B.to_corners(B.box())
    crop, flip, pad = B.crop(c, F.lit(40.0), F.lit(0.0), F.lit(200.0), F.lit(480.0)), B.flip(c, F.lit(640.0)), B.pad(c, F.lit(7.0), F.lit(0.0))
    grown = B.rescale(c, 1.5, F.lit(640.0), F.lit(480.0))
    wide, _ = B.resize_target(F.col("w"), F.col("h"), 100)
    return view(spark, d, "gt_boxes").filter("w <> h").select("ann_id", crop[0].alias("cropped"), flip[0].alias("flipped"), pad[0].alias("padded"), F.round(grown[0], 6).alias("grown"), wide.cast("long").alias("new_width"))


@register("SELECT ann_id, CAST(CASE WHEN ok THEN j * 4 + i ELSE 0 END AS BIGINT) AS cell, ok AS valid FROM (SELECT *, i >= 0 AND j >= 0 AND i < 4 AND j < 4 AS ok FROM (SELECT ann_id, CASE WHEN x = 300 THEN 3 ELSE floor((x - 100) * 4 / 200) END AS i, CASE WHEN y = 250 THEN 3 ELSE floor((y - 50) * 4 / 200) END AS j FROM gt_boxes))")
def keypoints_to_cells(spark, d):
    cell, valid = B.keypoint_cell(F.col("x"), F.col("y"), (F.lit(100.0), F.lit(50.0), F.lit(300.0), F.lit(250.0)), 4)
    return view(spark, d, "gt_boxes").select("ann_id", cell.alias("cell"), valid.alias("valid"))


@register("SELECT det_id, round(1 / (1 + exp(-(score * 8 - 4))) * (1 / (1 + exp(-(h / 10 - 3)))), 6) AS score, round((0.4 - 0.05) * 640, 6) AS x0 FROM dt_boxes")
def detection_scores(spark, d):
    corners = B.decode_box((F.lit(0.4), F.lit(0.5), F.lit(0.1), F.lit(0.2)), F.lit(640.0), F.lit(480.0))
    out = view(spark, d, "dt_boxes").select("det_id", B.detection_score(F.col("score") * 8 - 4, F.col("h") / 10 - 3).alias("score"), corners[0].alias("x0"))
    return _rounded(out, "score", "x0")


_PATH = "concat('set ', CAST(doc_id % 7 AS STRING), '/part', CAST(doc_id % 100 AS STRING), '/Frame', CAST(doc_id AS STRING), '.v2.JPG')"


@register(f"SELECT doc_id, concat('Frame', CAST(doc_id AS STRING), '.v2') AS stem, 'jpg' AS extension, concat('set ', CAST(doc_id % 7 AS STRING), '/part', CAST(doc_id % 100 AS STRING)) AS folder, replace({_PATH}, '/', '_') AS flat, concat(lpad(CAST(doc_id AS STRING), 6, '0'), '_', lang) AS numbered, lower(trim(concat(' ', lang))) = lower(trim(upper(lang))) AS same FROM documents WHERE doc_id < 1000000")
def string_functions(spark, d):
    rows = spark.read.parquet(f"{d}/documents.parquet").filter("doc_id < 1000000").selectExpr("doc_id", "lang", f"{_PATH} AS path")
    p = F.col("path")
    return rows.select("doc_id", X.stem(p).alias("stem"), X.extension(p).alias("extension"), X.folder(p).alias("folder"), X.flat_path(p).alias("flat"), X.numbered(F.col("doc_id"), F.col("lang")).alias("numbered"), X.same_phrase(F.concat(F.lit(" "), "lang"), F.upper("lang")).alias("same"))


@register("SELECT doc_id, row_number() OVER (ORDER BY doc_id % 100, doc_id) AS place FROM documents")
def natural_sort(spark, d):
    """Names whose digit groups sort as numbers."""
    from .operators.reshape import numbers

    rows = spark.read.parquet(f"{d}/documents.parquet").selectExpr("doc_id", "concat(if(doc_id % 2 = 0, 'Part', 'part'), doc_id % 100, '/f', doc_id) AS path").withColumn("key", X.natural_key(F.col("path")))
    return rows.join(numbers(rows, "key", parts=16), "key").select("doc_id", F.col("number").alias("place"))


_MET = """(SELECT p.image_id, p.ann_id AS a, q.ann_id AS b, sum(least(p.row_start + p.run_len, q.row_start + q.run_len) - greatest(p.row_start, q.row_start)) AS pixels
  FROM mask_runs p JOIN dt_runs q ON p.image_id = q.image_id AND p.col = q.col AND p.row_start < q.row_start + q.run_len AND q.row_start < p.row_start + p.run_len GROUP BY ALL)"""


@register(f"""SELECT m.image_id, a, b, CAST(pixels AS BIGINT) AS pixels, round(pixels / (aa + ba - pixels), 6) AS iou, round(pixels / least(aa, ba), 6) AS iom FROM {_MET} m
  JOIN (SELECT image_id, ann_id AS a, sum(run_len) AS aa FROM mask_runs GROUP BY ALL) USING (image_id, a) JOIN (SELECT image_id, ann_id AS b, sum(run_len) AS ba FROM dt_runs GROUP BY ALL) USING (image_id, b)""")
def mask_similarity(spark, d):
    return _rounded(K.mask_similarity(view(spark, d, "mask_runs"), view(spark, d, "dt_runs")), "iou", "iom")


@register("""SELECT video_id, gt_track, dt_track, round(i / (ga + da - i), 6) AS iou FROM (
  SELECT p.image_id % 97 AS video_id, p.ann_id AS gt_track, q.ann_id AS dt_track, sum(least(p.row_start + p.run_len, q.row_start + q.run_len) - greatest(p.row_start, q.row_start)) AS i
  FROM mask_runs p JOIN dt_runs q ON p.image_id = q.image_id AND p.col = q.col AND p.row_start < q.row_start + q.run_len AND q.row_start < p.row_start + p.run_len GROUP BY ALL)
  JOIN (SELECT ann_id AS gt_track, sum(run_len) AS ga FROM mask_runs GROUP BY ALL) USING (gt_track) JOIN (SELECT ann_id AS dt_track, sum(run_len) AS da FROM dt_runs GROUP BY ALL) USING (dt_track)""")
def track_mask_iou(spark, d):
    gt, dt = (view(spark, d, n).select((F.col("image_id") % 97).alias("video_id"), F.col("ann_id").alias("track_id"), F.col("image_id").alias("frame_idx"), "col", "row_start", "run_len") for n in ("mask_runs", "dt_runs"))
    return _rounded(K.track_mask_iou(gt, dt), "iou")


@register("SELECT image_id, ann_id, col, row_start, run_len, dense_rank() OVER (PARTITION BY image_id, ann_id ORDER BY col // 5) AS component, CAST(sum(run_len) OVER (PARTITION BY image_id, ann_id, col // 5) AS BIGINT) AS size FROM mask_runs WHERE col % 5 <> 0")
def mask_components(spark, d):
    """Masks cut at every fifth column."""
    return K.mask_components(view(spark, d, "mask_runs").filter("col % 5 <> 0"))


@register()
def clean_masks(spark, d):
    runs = view(spark, d, "mask_runs").filter("col % 5 <> 0 or row_start % 4 = 0")
    sizes = runs.groupBy("image_id", "ann_id").agg(F.lit(480).cast("long").alias("h"), F.lit(460).alias("w"))
    return K.clean_masks(runs, sizes, 60)


_PIXELS = """(SELECT image_id, col, y, arg_max(ann_id, score * 1e9 - ann_id % 100) AS ann_id FROM (SELECT image_id, ann_id, col, (ann_id * 7) % 10 AS score, unnest(range(row_start, row_start + run_len)) AS y FROM mask_runs) GROUP BY ALL)"""


def _scored(spark, d):
    runs = view(spark, d, "mask_runs")
    return runs, runs.select("image_id", "ann_id", ((F.col("ann_id") * 7) % 10).alias("score")).distinct()


@register(f"SELECT image_id, ann_id, count(*) AS area FROM {_PIXELS} GROUP BY image_id, ann_id")
def resolve_overlaps(spark, d):
    runs, scores = _scored(spark, d)
    return S.resolve_overlaps(runs, scores, "image_id").groupBy("image_id", "ann_id").agg(F.sum("run_len").alias("area"))


@register(f"SELECT r.image_id, r.ann_id, coalesce(l.n, 0) >= 0.9 * r.n AS kept FROM (SELECT image_id, ann_id, sum(run_len) AS n FROM mask_runs GROUP BY ALL) r LEFT JOIN (SELECT image_id, ann_id, count(*) AS n FROM {_PIXELS} GROUP BY ALL) l ON l.image_id = r.image_id AND l.ann_id = r.ann_id")
def drop_shrunk(spark, d):
    runs, scores = _scored(spark, d)
    return S.drop_shrunk(runs, scores, "image_id", threshold=0.9)


@register("""SELECT m.image_id, m.ann_id, list_contains(kept, m.ann_id) AS kept FROM (SELECT DISTINCT image_id, ann_id FROM mask_runs) m JOIN (
  WITH RECURSIVE a AS MATERIALIZED (SELECT image_id, ann_id, sum(run_len) AS area FROM mask_runs GROUP BY ALL),
  e AS MATERIALIZED (SELECT p.image_id, p.ann_id AS a, q.ann_id AS b, sum(least(p.row_start + p.run_len, q.row_start + q.run_len) - greatest(p.row_start, q.row_start)) AS pixels FROM mask_runs p JOIN mask_runs q ON p.image_id = q.image_id AND p.col = q.col AND p.ann_id <> q.ann_id AND p.row_start < q.row_start + q.run_len AND q.row_start < p.row_start + p.run_len GROUP BY ALL),
  f AS MATERIALIZED (SELECT e.image_id, e.a, e.b FROM e JOIN a x ON x.image_id = e.image_id AND x.ann_id = e.a JOIN a y ON y.image_id = e.image_id AND y.ann_id = e.b WHERE pixels > 0.3 * least(x.area, y.area)),
  r AS MATERIALIZED (SELECT image_id, ann_id, row_number() OVER (PARTITION BY image_id ORDER BY (ann_id * 7) % 10 DESC, ann_id) AS k FROM a),
  g AS MATERIALIZED (SELECT r.image_id, r.k, any_value(r.ann_id) AS ann_id, list(f.a) FILTER (f.a IS NOT NULL) AS enemies FROM r LEFT JOIN f ON f.image_id = r.image_id AND f.b = r.ann_id GROUP BY r.image_id, r.k),
  s AS (SELECT image_id, k, [ann_id] AS kept FROM g WHERE k = 1 UNION ALL SELECT g.image_id, g.k, CASE WHEN list_has_any(s.kept, coalesce(g.enemies, [])) THEN s.kept ELSE list_append(s.kept, g.ann_id) END FROM s JOIN g ON g.image_id = s.image_id AND g.k = s.k + 1)
  SELECT image_id, arg_max(kept, k) AS kept FROM s GROUP BY image_id) n ON n.image_id = m.image_id""")
def remove_contained(spark, d):
    runs, scores = _scored(spark, d)
    return S.remove_contained(scores, runs).select("image_id", "ann_id", "kept")


@register("SELECT image_id, ann_id, 5 AS n, TRUE AS inside FROM (SELECT DISTINCT image_id, ann_id FROM mask_runs)")
def sample_points(spark, d):
    """Five points of every mask, all of them inside."""
    runs = view(spark, d, "mask_runs")
    points = K.sample_points(runs, 5, 9)
    inside = points.join(runs.withColumnRenamed("col", "x"), ["image_id", "ann_id", "x"], "left")
    return inside.groupBy("image_id", "ann_id").agg(F.countDistinct("point").cast("int").alias("n"), F.bool_and(F.col("row_start").isNotNull() & (F.col("y") >= F.col("row_start")) & (F.col("y") < F.col("row_start") + F.col("run_len"))).alias("inside"))


@register("SELECT image_id, ann_id, 6 AS n, TRUE AS inside, TRUE AS right_label FROM gt_boxes")
def sample_points_in_box(spark, d):
    boxes = view(spark, d, "gt_boxes").select("image_id", "ann_id", F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + F.col("w")).alias("x1"), (F.col("y") + F.col("h")).alias("y1"))
    points = K.sample_points_in_box(boxes, view(spark, d, "mask_runs"), 6, 2).join(boxes, ["image_id", "ann_id"])
    inside = (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1"))
    label = (F.col("label") == 1) == (F.col("x") < F.col("x0") + 10)  # the masks are the boxes' first ten columns
    return points.groupBy("image_id", "ann_id").agg(F.count("*").cast("int").alias("n"), F.bool_and(inside).alias("inside"), F.bool_and(label).alias("right_label"))


@register("""SELECT image_id, ann_id, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f FROM (SELECT g.image_id, g.ann_id,
  CASE WHEN t.n IS NULL THEN 1.0 ELSE coalesce(i, 0) / t.n END AS p, CASE WHEN t.n IS NULL THEN 0.0 ELSE coalesce(i, 0) / g.n END AS r FROM (SELECT image_id, ann_id, sum(run_len) AS n FROM mask_runs GROUP BY ALL) g
  LEFT JOIN (SELECT image_id, ann_id, sum(run_len) AS n FROM dt_runs GROUP BY ALL) t ON t.image_id = g.image_id AND t.ann_id = g.ann_id LEFT JOIN (SELECT image_id, a, pixels AS i FROM """ + _MET + """ WHERE a = b) m ON m.image_id = g.image_id AND m.a = g.ann_id)""")
def boundary_f_measure(spark, d):
    """The runs of either side stand for its boundary and for its widened boundary."""
    gt, dt = view(spark, d, "mask_runs"), view(spark, d, "dt_runs")
    out = K.boundary_f_measure(gt.select("image_id", "ann_id").distinct(), gt, dt, gt, dt)
    return _rounded(out, "precision", "recall", "f")


@register("SELECT image_id, ann_id, col, row_start, run_len FROM mask_runs WHERE ann_id % 2 = 0 UNION ALL SELECT image_id, ann_id, CAST(x AS BIGINT) + i AS col, CAST(y AS BIGINT), CAST(h AS BIGINT) FROM (SELECT *, unnest(range(0, CAST(w AS BIGINT))) AS i FROM gt_boxes) WHERE ann_id % 2 = 1")
def ingest_masks(spark, d):
    """Masks as counts for even ids, and as boxes for odd ones."""
    runs = view(spark, d, "mask_runs").filter("ann_id % 2 = 0").withColumn("low", F.col("col") * 480 + F.col("row_start"))
    counts = runs.groupBy("image_id", "ann_id").agg(F.array_sort(F.collect_list(F.struct("low", "run_len"))).alias("runs"))
    gaps = F.flatten(F.transform("runs", lambda r, i: F.array(r["low"] - F.when(i > 0, F.col("runs")[i - 1]["low"] + F.col("runs")[i - 1]["run_len"]).otherwise(0), r["run_len"])))
    kind = "struct<x:double,y:double,w:double,h:double>"
    counted = counts.select("image_id", "ann_id", F.lit(480).cast("long").alias("h"), gaps.alias("counts"), F.lit(None).cast(kind).alias("box"))
    boxes = view(spark, d, "gt_boxes").filter("ann_id % 2 = 1").select("image_id", "ann_id", F.lit(480).cast("long").alias("h"), F.lit(None).cast("array<bigint>").alias("counts"), F.struct(*"xywh").alias("box"))
    return K.ingest_masks(counted.unionByName(boxes))


@register("SELECT det_id FROM dt_boxes WHERE greatest(x, y, w, h) > 0 AND w > 0 AND h > 0")
def nonempty_box(spark, d):
    return view(spark, d, "dt_boxes").filter(C.valid_box(B.box()) & S.is_valid()).select("det_id")


@register("SELECT det_id FROM dt_boxes WHERE round(x - (w * 0.6 + h * 0.8) / 2, 9) >= -2 AND round(y - (h * 0.6 + w * 0.8) / 2, 9) >= -2 AND round(x + (w * 0.6 + h * 0.8) / 2, 9) < 642 AND round(y + (h * 0.6 + w * 0.8) / 2, 9) < 482")
def inside_rotated_box(spark, d):
    return view(spark, d, "dt_boxes").filter(B.inside_rotated((*B.box(), F.degrees(F.acos(F.lit(0.6)))), F.lit(640), F.lit(480), 2)).select("det_id")

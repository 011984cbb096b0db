"""Queries over ids, documents, files and frame streams, and the SQL of those that have one."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .operators import reshape as R
from .shared import shared_folder
from .sources import documents as D, metrics as W, text as X
from .streaming import lifecycle as L, tables as V
from .views import register, view


def _folder(spark, name: str) -> str:
    """A new folder for files that a query writes and reads: where the session shares them."""
    return f"{shared_folder(spark)}/files/{uuid.uuid4().hex}/{name}"


@register("SELECT det_id, CASE WHEN det_id % 5 <> 0 THEN x END AS x, 1.0 AS score FROM dt_boxes")
def null_empty_detections(spark, d):
    dt = view(spark, d, "dt_boxes").withColumn("area", F.when(F.col("det_id") % 5 != 0, F.col("w") * F.col("h")).otherwise(0.0))
    return R.null_empty_detections(dt).select("det_id", "x", "score")


@register("SELECT image_id, shard FROM (SELECT DISTINCT image_id, CASE WHEN image_id % 3 = 0 THEN 1 ELSE 0 END AS shard FROM dt_boxes)")
def merge_eval_rows(spark, d):
    ids = view(spark, d, "dt_boxes").select("image_id").distinct()
    return R.merge_eval_rows(ids.filter("image_id % 3 <> 0").withColumn("shard_no", F.lit(0)), ids.withColumn("shard_no", F.lit(1))).select("image_id", F.col("shard_no").alias("shard"))


_SHORT = "(SELECT DISTINCT track_id % 1000 AS track_id, video_id % 50 AS video_id FROM gt_tracks)"


@register(f"""SELECT video_id, s.track_id AS old_track_id, CASE WHEN n > 1 THEN (SELECT max(track_id) FROM {_SHORT}) + row_number() OVER (PARTITION BY n > 1 ORDER BY s.track_id, video_id) ELSE s.track_id END AS track_id
  FROM {_SHORT} s JOIN (SELECT track_id, count(*) AS n FROM {_SHORT} GROUP BY 1) c ON c.track_id = s.track_id""")
def unique_track_ids(spark, d):
    short = view(spark, d, "gt_tracks").select((F.col("track_id") % 1000).alias("track_id"), (F.col("video_id") % 50).alias("video_id")).distinct()
    return R.unique_track_ids(short).select("video_id", "old_track_id", "track_id")


@register("SELECT video_id, frame_idx, track_id AS old_track_id, dense_rank() OVER (ORDER BY video_id, track_id) AS track_id, CAST(1 AS BIGINT) AS category_id FROM gt_tracks")
def class_agnostic(spark, d):
    return R.class_agnostic(view(spark, d, "gt_tracks")).select("video_id", "frame_idx", "old_track_id", "track_id", "category_id")


@register("SELECT DISTINCT video_id, concat(lpad(CAST(video_id AS STRING), 6, '0'), '_frame0.jpg') AS first_file, CAST(1 AS BIGINT) AS category_id FROM gt_tracks WHERE video_id < 1000000")
def single_category(spark, d):
    tracks = view(spark, d, "gt_tracks").filter("video_id < 1000000")
    videos = tracks.select("video_id").distinct().withColumn("file_names", F.array(F.lit("frame0.jpg"), F.lit("frame1.jpg")))
    rows, named = R.single_category(tracks, videos)
    return named.join(rows.select("video_id", "category_id").distinct(), "video_id").select("video_id", F.col("file_names")[0].alias("first_file"), "category_id")


@register("SELECT ann_id + 1 AS id, image_id, category_id FROM gt_boxes")
def reindex_from_one(spark, d):
    """Annotation ids with one row of id 0; images and categories begin at 1."""
    anns = view(spark, d, "gt_boxes").select(F.col("ann_id").alias("id"), "image_id", "category_id")
    low = anns.agg(F.min("id").alias("low"))
    anns = anns.join(F.broadcast(low)).withColumn("id", F.col("id") - F.col("low")).drop("low")
    images, categories = (anns.select(F.col(c).alias("id")).distinct() for c in ("image_id", "category_id"))
    out = R.reindex_from_one(images.filter("id > 0"), anns, categories)[1]
    return out.join(F.broadcast(low)).select((F.col("id") + F.col("low")).alias("id"), "image_id", "category_id")


@register("SELECT DISTINCT image_id FROM dt_boxes WHERE image_id NOT IN (SELECT image_id FROM gt_boxes WHERE iscrowd = 1)")
def unknown_images(spark, d):
    return R.unknown_images(view(spark, d, "dt_boxes"), view(spark, d, "gt_boxes").filter("iscrowd = 1"))


@register("SELECT ann_id, CASE WHEN ann_id % 2 = 0 THEN 640 ELSE 100 END AS width FROM gt_boxes")
def fill_from_parent(spark, d):
    rows = view(spark, d, "gt_boxes").select("ann_id", "image_id", F.when(F.col("ann_id") % 2 == 1, 100).alias("width"))
    return R.fill_from_parent(rows, view(spark, d, "image_np").select("image_id", "width").distinct(), "image_id", "width").select("ann_id", "width")


@register("SELECT i.image_id, coalesce(n, 0) AS n, n IS NOT NULL AS is_predicted FROM (SELECT DISTINCT image_id FROM image_np) i LEFT JOIN (SELECT image_id, count(*) AS n FROM dt_boxes GROUP BY 1) USING (image_id)")
def add_unpredicted_images(spark, d):
    results = view(spark, d, "dt_boxes").groupBy("image_id").agg(F.count("*").alias("n"))
    return R.add_unpredicted_images(results, view(spark, d, "image_np")).na.fill(0, ["n"])


_SEEN = "(SELECT image_id, category_id FROM gt_boxes UNION SELECT image_id, category_id FROM dt_boxes)"


@register(f"""SELECT image_id AS video_id, category_id, row_number() OVER (ORDER BY image_id, category_id) AS pair_id, FALSE AS is_declared_only FROM {_SEEN}
  UNION ALL SELECT image_id, 9 AS category_id, (SELECT count(*) FROM {_SEEN}) + row_number() OVER (ORDER BY image_id), TRUE FROM (SELECT DISTINCT image_id FROM gt_boxes)""")
def numbered_pairs(spark, d):
    gt, dt = (view(spark, d, n).withColumnRenamed("image_id", "video_id") for n in ("gt_boxes", "dt_boxes"))
    declared = gt.select("video_id", F.lit(9).cast("long").alias("category_id")).unionByName(gt.select("video_id", F.col("category_id").cast("long").alias("category_id")))
    return R.numbered_pairs(gt, dt, declared)


@register(f"SELECT row_number() OVER (ORDER BY image_id, category_id) AS video_id, image_id AS old_video_id, category_id AS old_category_id FROM {_SEEN}")
def paired_videos(spark, d):
    gt, dt = (view(spark, d, n).withColumnRenamed("image_id", "video_id") for n in ("gt_boxes", "dt_boxes"))
    pairs = R.numbered_pairs(gt, dt, gt)
    videos = gt.select("video_id").unionByName(dt.select("video_id")).distinct()
    return R.paired_videos(videos, pairs)


_FRAME_IDS = "SELECT DISTINCT video_id, frame_idx, video_id * 10 + frame_idx AS image_id FROM gt_tracks"


@register("SELECT video_id, frame_idx, track_id, video_id * 10 + frame_idx AS image_id FROM gt_tracks")
def frame_lookup(spark, d):
    tracks = view(spark, d, "gt_tracks")
    frames = tracks.select("video_id", "frame_idx", (F.col("video_id") * 10 + F.col("frame_idx")).alias("image_id")).distinct()
    return R.frame_lookup(tracks, frames).select("video_id", "frame_idx", "track_id", "image_id")


@register("SELECT doc_id, concat('a_b_', CAST(doc_id AS STRING), '.txt') AS flat_path, quality FROM documents JOIN labels USING (doc_id)")
def metadata_join(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.col("doc_id").alias("stem"), F.format_string("a/b/%d.txt", "doc_id").alias("path"))
    labels = spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("stem"), "quality")
    return R.metadata_join(docs, labels).select("doc_id", "flat_path", "quality")


@register("SELECT track_id, category_id, concat('thing ', CAST(category_id AS STRING)) AS name FROM gt_tracks WHERE frame_idx = 2 AND video_id = (SELECT min(video_id) FROM gt_tracks)")
def frame_annotations(spark, d):
    tracks = view(spark, d, "gt_tracks")
    categories = tracks.select("category_id").distinct().withColumn("name", F.format_string("thing %d", "category_id"))
    first = tracks.agg(F.min("video_id")).first()[0]
    return R.frame_annotations(tracks, categories, first, 2).select("track_id", "category_id", "name")


def _masklets(spark, d):
    box = F.struct(*"xywh")
    rows = view(spark, d, "gt_tracks").groupBy("video_id", "category_id", "track_id").agg(F.map_from_entries(F.collect_list(F.struct("frame_idx", box))).alias("at"))
    boxes = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.try_element_at("at", i))
    areas = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.when(i % 2 == 0, F.lit(7.0)))
    return rows.select("video_id", "category_id", "track_id", boxes.alias("boxes"), areas.alias("areas"))


@register("SELECT row_number() OVER (ORDER BY video_id, category_id, track_id, frame_idx) AS id, track_id, frame_idx, video_id * 10 + frame_idx AS image_id, CASE WHEN frame_idx % 2 = 0 THEN 7.0 ELSE w * h END AS area FROM gt_tracks")
def tracks_to_frames(spark, d):
    frames = view(spark, d, "gt_tracks").select("video_id", "frame_idx", (F.col("video_id") * 10 + F.col("frame_idx")).alias("image_id")).distinct()
    return R.tracks_to_frames(_masklets(spark, d), frames).select("id", "track_id", "frame_idx", "image_id", "area")


@register("SELECT image_id AS video_id, coalesce(n, 0) AS n_tracks, coalesce(m, 0) AS n_boxes FROM (SELECT DISTINCT image_id FROM image_np) LEFT JOIN (SELECT video_id AS image_id, count(DISTINCT track_id) AS n, count(*) AS m FROM gt_tracks GROUP BY 1) USING (image_id)")
def frames_to_tracks(spark, d):
    out = R.frames_to_tracks(view(spark, d, "gt_tracks"), view(spark, d, "image_np").withColumnRenamed("image_id", "video_id"))
    boxes = F.aggregate("tracks", F.lit(0).cast("long"), lambda t, x: t + F.size(x["boxes"]))
    return out.select("video_id", F.size("tracks").cast("long").alias("n_tracks"), boxes.alias("n_boxes"))


@register(f"SELECT video_id, frame_idx, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx) - 1 AS timestep FROM ({_FRAME_IDS})")
def timesteps(spark, d):
    frames = view(spark, d, "gt_tracks").select("video_id", "frame_idx", (F.col("video_id") * 10 + F.col("frame_idx")).alias("image_id")).distinct()
    return R.timesteps(frames).select("video_id", "frame_idx", "timestep")


@register("SELECT datapoint_id, query_no, i AS frame_idx FROM dp_queries CROSS JOIN (SELECT unnest(range(0, 3)) AS i) WHERE input_x IS NULL")
def tile_image(spark, d):
    return R.tile_image(view(spark, d, "dp_queries").withColumnRenamed("input_x", "input_box"), 3).select("datapoint_id", "query_no", "frame_idx")


@register("SELECT image_id, category_id, x, y, w, h, score FROM dt_boxes")
def to_prediction_rows(spark, d):
    b = F.array("x", "y", F.col("x") + F.col("w"), F.col("y") + F.col("h"))
    rows = view(spark, d, "dt_boxes").groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("det_id", b.alias("box"), "score", "category_id"))).alias("all"))
    return R.to_prediction_rows(rows.select("image_id", F.col("all.box").alias("boxes"), F.col("all.score").alias("scores"), F.col("all.category_id").alias("labels")))


@register("SELECT t.video_id, t.track_id, i AS frame_idx, t.score, b.x FROM (SELECT video_id, track_id, max(score) AS score FROM dt_tracks GROUP BY ALL) t CROSS JOIN (SELECT unnest(range(0, 8)) AS i) LEFT JOIN dt_tracks b ON b.video_id = t.video_id AND b.track_id = t.track_id AND b.frame_idx = i")
def pad_track_frames(spark, d):
    return R.pad_track_frames(view(spark, d, "dt_tracks"), 8).select("video_id", "track_id", "frame_idx", "score", "x")


@register("""SELECT (dense_rank() OVER (ORDER BY image_id) - 1) * 2 + (category_id - 1) // 2 AS datapoint_id, image_id, category_id, concat('thing ', CAST(category_id AS STRING)) AS query_text, coalesce(n, 0) AS n_objects
  FROM (SELECT DISTINCT image_id FROM image_np) CROSS JOIN (SELECT DISTINCT category_id FROM gt_boxes) LEFT JOIN (SELECT image_id, category_id, CAST(count(*) AS INT) AS n FROM gt_boxes GROUP BY ALL) USING (image_id, category_id)""")
def build_queries(spark, d):
    gt = view(spark, d, "gt_boxes")
    images = view(spark, d, "image_np").select("image_id", "width", "height").distinct()
    cats = gt.select("category_id").distinct().withColumn("name", F.format_string("thing %d", "category_id"))
    return R.build_queries(images, gt, cats, chunk_size=2).drop("objects")


@register("SELECT video_id, category_id, i AS frame_idx, i AS query_processing_order, concat('f', CAST(i AS STRING)) AS file_name FROM (SELECT DISTINCT video_id, category_id FROM gt_tracks) CROSS JOIN (SELECT unnest(range(0, 3)) AS i)")
def expand_video_queries(spark, d):
    pairs = view(spark, d, "gt_tracks").select("video_id", "category_id", F.lit("thing").alias("noun_phrase")).distinct()
    videos = pairs.select("video_id").distinct().withColumn("file_names", F.array(*(F.lit(f"f{i}") for i in range(3))))
    return R.expand_video_queries(videos, pairs).select("video_id", "category_id", "frame_idx", "query_processing_order", "file_name")


@register("""SELECT d.video_id, d.frame_idx, d.track_id FROM dt_tracks d WHERE EXISTS (SELECT 1 FROM gt_tracks g WHERE g.video_id = d.video_id AND g.frame_idx = d.frame_idx AND g.category_id = d.category_id) OR d.category_id = 1""")
def non_exhaustive_cleanup(spark, d):
    """No category is declared loose: predictions go where the frame has none of the category,
    but for category 1, which the videos declare negative."""
    gt, dt = (view(spark, d, n) for n in ("gt_tracks", "dt_tracks"))
    negatives = dt.select("video_id").distinct().withColumn("category_id", F.lit(1))
    return R.non_exhaustive_cleanup(gt, dt, negatives, negatives.limit(0)).select("video_id", "frame_idx", "track_id")


@register("SELECT video_id, frame_idx, track_id, x / 640 AS x FROM dt_tracks WHERE track_id % 3 <> 0 AND NOT (track_id % 4 = 0 AND frame_idx = 2)")
def visible_objects(spark, d):
    t = view(spark, d, "dt_tracks").withColumns({"area": F.col("w") * F.col("h"), "frame_w": F.lit(640.0), "frame_h": F.lit(480.0)})
    removed = t.filter("track_id % 3 = 0").select("video_id", "track_id").distinct()
    suppressed = t.filter("track_id % 4 = 0 and frame_idx = 2").select("video_id", "frame_idx", "track_id")
    return R.visible_objects(t, removed, suppressed).select("video_id", "frame_idx", "track_id", "x")


@register("SELECT video_id, track_id, frame_idx FROM dt_tracks WHERE track_id % 10 <> 0 AND score * 4 - 2 >= 0")
def track_presence(spark, d):
    t = view(spark, d, "dt_tracks").withColumns({"logit": F.col("score") * 4 - 2, "track_id": F.when(F.col("track_id") % 10 == 0, -1).otherwise(F.col("track_id"))})
    return R.track_presence(t, 0.5).select("video_id", "track_id", "frame_idx")


@register("""SELECT t.video_id, t.track_id, round(t.score, 6) AS score, l.label, 8 - t.n AS n_padded FROM (SELECT video_id, track_id, avg(score * (frame_idx + 1)) AS score, count(*) AS n FROM dt_tracks GROUP BY ALL) t
  JOIN (SELECT *, row_number() OVER (PARTITION BY video_id, track_id ORDER BY n DESC, label) AS k FROM (SELECT video_id, track_id, (frame_idx + track_id) % 3 AS label, count(*) AS n FROM dt_tracks GROUP BY ALL)) l ON l.video_id = t.video_id AND l.track_id = t.track_id AND k = 1""")
def track_rollup(spark, d):
    t = view(spark, d, "dt_tracks").withColumns({"label": (F.col("frame_idx") + F.col("track_id")) % 3, "score": F.col("score") * (F.col("frame_idx") + 1)})
    out = R.track_rollup(t, 8)
    return out.select("video_id", "track_id", F.round("score", 6).alias("score"), "label", F.size(F.filter("frame_scores", lambda s: s == -1e8)).cast("long").alias("n_padded"))


@register("SELECT image_id, count(*) FILTER (1 / (1 + exp(-(score * 6 - 3))) * 0.5 > 0.3) AS n_objects FROM dt_boxes GROUP BY image_id")
def object_count(spark, d):
    return R.object_count(view(spark, d, "dt_boxes").select("image_id", (F.col("score") * 6 - 3).alias("logit"), F.lit(0.0).alias("presence_logit")), 0.3)


_METER = "SELECT category_id, round(sum(score * w), 6) AS total, sum(w) AS count, round(sum(score * w) / sum(w), 6) AS mean, arg_max(score, det_id) AS last FROM dt_boxes GROUP BY category_id"


def _meter_rows(spark, d):
    return view(spark, d, "dt_boxes").select("category_id", F.col("score").alias("value"), F.col("w").alias("n"), F.col("det_id").alias("step"))


@register(_METER)
def weighted_meter(spark, d):
    return R.weighted_meter(_meter_rows(spark, d), "category_id").withColumns({c: F.round(c, 6) for c in ("total", "mean")})


@register("SELECT datapoint_id, query_no, dense_rank() OVER (PARTITION BY datapoint_id ORDER BY stage DESC) - 1 AS stage FROM dp_queries WHERE stage > 0 OR datapoint_id % 2 = 0")
def remap_stages(spark, d):
    return R.remap_stages(view(spark, d, "dp_queries").filter("stage > 0 or datapoint_id % 2 = 0"), reverse=True).select("datapoint_id", "query_no", "stage")


@register("SELECT video_id, 3 AS n, TRUE AS even FROM (SELECT DISTINCT video_id FROM gt_tracks)")
def strided_frames(spark, d):
    """Three of the frames of each video, at equal distances of 2."""
    frames = view(spark, d, "gt_tracks").select("video_id").distinct().withColumn("frame_idx", F.explode(F.sequence(F.lit(0), F.lit(7))))
    out = R.strided_frames(frames, 3, 2, 11).groupBy("video_id").agg(F.count("*").cast("int").alias("n"), F.max("frame_idx").alias("hi"), F.min("frame_idx").alias("lo"))
    return out.select("video_id", "n", (F.col("hi") - F.col("lo") == 4).alias("even"))


@register("SELECT video_id, i AS place, 2 - i AS frame_idx FROM (SELECT DISTINCT video_id FROM gt_tracks) CROSS JOIN (SELECT unnest(range(0, 3)) AS i)")
def frame_order(spark, d):
    videos = view(spark, d, "gt_tracks").groupBy("video_id").agg(F.lit(8).alias("n_frames"))
    return R.frame_order(videos, 3, 5, reverse=True)


@register("SELECT CAST(least(count(DISTINCT image_id), 100) AS BIGINT) AS n FROM dt_boxes")
def limit_ids(spark, d):
    return R.limit_ids(view(spark, d, "dt_boxes"), 100).agg(F.count("*").alias("n"))


@register("SELECT image_id AS video_id, det_id FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, det_id) AS k FROM dt_boxes) WHERE k + image_id % 3 <= 4")
def keep_top_new(spark, d):
    dets = view(spark, d, "dt_boxes").select(F.col("image_id").alias("video_id"), "det_id", "score")
    return R.keep_top_new(dets, dets.select("video_id", (F.col("video_id") % 3).alias("n_objects")).distinct(), 4).select("video_id", "det_id")


@register("SELECT source, lang, round(avg(quality), 6) AS mean, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((source, lang), (source), ())")
def dataset_macro_average(spark, d):
    rows = spark.read.parquet(f"{d}/documents.parquet").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    out = rows.groupingSets([["source", "lang"], ["source"], []], "source", "lang").agg(F.round(F.avg("quality"), 6).alias("mean"), F.count("*").alias("n"))
    return out.select("source", "lang", "mean", "n")


#: Images and videos of a written document at most (where ids are 0 to n), so that documents grow in number and not in size.
DOCUMENT_IMAGES, DOCUMENT_VIDEOS = 20_000, 2_000


def _shard(key: str, size: int):
    """part and shard of an id: ten parts, each in documents of `size` ids in a row."""
    return (F.col(key) % 10).alias("part"), F.floor(F.col(key) / (10 * size)).alias("shard")


def _documents(spark, d, path, size=DOCUMENT_IMAGES):
    """The boxes written as documents, for each of ten parts of the images one or more; the first
    of a part has the categories."""
    images = view(spark, d, "image_np").groupBy("image_id").agg(F.min("phrase_id").alias("phrase_id"))
    image = F.struct(F.col("image_id").alias("id"), F.format_string("f/%d.jpg", "image_id").alias("file_name"), F.lit(640).alias("width"), F.lit(480).alias("height"), F.format_string("thing %d", F.col("phrase_id") % 7).alias("text_input"), (F.col("phrase_id") % 7).cast("string").alias("queried_category"), F.lit(1).alias("is_instance_exhaustive"))
    gt = view(spark, d, "gt_boxes")
    annotation = F.struct(F.col("ann_id").alias("id"), "image_id", "category_id", F.array(*"xywh").alias("bbox"), (F.col("w") * F.col("h")).alias("area"), "iscrowd")
    docs = images.groupBy(*_shard("image_id", size)).agg(F.collect_list(image).alias("images"))
    docs = docs.join(gt.groupBy(*_shard("image_id", size)).agg(F.collect_list(annotation).alias("annotations")), ["part", "shard"], "left")
    cats = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.struct(i.alias("id"), F.format_string("c%d", i).alias("name")))
    first = images.groupBy((F.col("image_id") % 10).alias("part")).agg(F.min(_shard("image_id", size)[1]).alias("first"))
    docs = docs.join(F.broadcast(first), "part").withColumn("categories", F.when(F.col("shard") == F.col("first"), cats).otherwise(F.slice(cats, 1, 0)))
    docs.drop("part", "shard", "first").write.option("maxRecordsPerFile", 1).json(path)


@register("SELECT image_id, count(g.ann_id) AS n, round(sum(g.w * g.h), 3) AS area FROM (SELECT DISTINCT image_id FROM image_np) LEFT JOIN gt_boxes g USING (image_id) GROUP BY image_id")
def read_coco(spark, d):
    path = _folder(spark, "coco")
    _documents(spark, d, path)
    images, annotations, _ = D.read_coco(spark, path)
    return images.select("image_id").join(annotations.drop("dataset"), "image_id", "left").groupBy("image_id").agg(F.count("ann_id").alias("n"), F.round(F.sum(F.col("w") * F.col("h")), 3).alias("area"))


@register("SELECT image_id, count(g.ann_id) AS n, round(sum(g.w * g.h), 3) AS area FROM (SELECT DISTINCT image_id FROM image_np) LEFT JOIN gt_boxes g USING (image_id) GROUP BY image_id")
def read_coco_large(spark, d):
    """The same by byte ranges."""
    path = _folder(spark, "coco")
    _documents(spark, d, path)
    images, annotations, _ = D.read_coco(spark, path, large=True)
    return images.select("image_id").join(annotations.drop("dataset"), "image_id", "left").groupBy("image_id").agg(F.count("ann_id").alias("n"), F.round(F.sum(F.col("w") * F.col("h")), 3).alias("area"))


@register("SELECT 'images' AS kind, count(*) AS n FROM (SELECT DISTINCT image_id FROM image_np) UNION ALL SELECT 'annotations', count(*) FROM gt_boxes UNION ALL SELECT 'categories', count(DISTINCT image_id % 10) * 4 FROM image_np")
def read_annotation_collection(spark, d):
    """Two folders of documents as one collection: even and odd parts of the boxes' documents."""
    path = _folder(spark, "collection")
    _documents(spark, d, f"{path}/all")
    docs = spark.read.text(f"{path}/all").withColumn("part", F.monotonically_increasing_id() % 2)
    for part in (0, 1):
        docs.filter(F.col("part") == part).select("value").write.option("maxRecordsPerFile", 1).text(f"{path}/{part}")
    found = D.read_annotation_collection(spark, [f"{path}/0", f"{path}/1"])
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in found.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def _video_documents(spark, d, path, size=DOCUMENT_VIDEOS):
    """The tracks written as documents, for each of ten parts of the videos one or more."""
    frames = view(spark, d, "gt_tracks").groupBy("video_id", "category_id", "track_id").agg(F.map_from_entries(F.collect_list(F.struct("frame_idx", F.array(*"xywh")))).alias("at"))
    boxes = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.try_element_at("at", i))
    annotation = F.struct(F.col("track_id").alias("id"), "video_id", "category_id", F.format_string("c%d", "category_id").alias("noun_phrase"), boxes.alias("bboxes"), F.transform(boxes, lambda b: b[2] * b[3]).alias("areas"), F.lit(0).alias("iscrowd"))
    video = F.struct(F.col("video_id").alias("id"), F.format_string("v%d", "video_id").alias("video_name"), F.lit(8).alias("length"))
    pair = F.struct((F.col("video_id") * 10 + F.col("category_id")).alias("id"), "video_id", "category_id", F.format_string("c%d", "category_id").alias("noun_phrase"), F.col("n").cast("int").alias("num_masklets"))
    pairs = frames.groupBy("video_id", "category_id").agg(F.count("*").alias("n"))
    docs = frames.groupBy(*_shard("video_id", size)).agg(F.collect_set(video).alias("videos"), F.collect_list(annotation).alias("annotations")).join(pairs.groupBy(*_shard("video_id", size)).agg(F.collect_list(pair).alias("video_np_pairs")), ["part", "shard"])
    cats = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.struct(i.alias("id"), F.format_string("c%d", i).alias("name")))
    docs.withColumn("categories", cats).drop("part", "shard").write.option("maxRecordsPerFile", 1).json(path)


@register("SELECT video_id, category_id, count(DISTINCT track_id) AS n_masklets, count(*) AS n_boxes, round(sum(w * h), 3) AS area FROM gt_tracks GROUP BY ALL")
def read_video_annotations(spark, d):
    path = _folder(spark, "videos")
    _video_documents(spark, d, path)
    _, annotations, _, pairs = D.read_video_annotations(spark, path)
    there = annotations.select("video_id", "category_id", F.explode(F.filter("boxes", lambda b: b.isNotNull())).alias("b"))
    boxes = there.groupBy("video_id", "category_id").agg(F.count("*").alias("n_boxes"), F.round(F.sum(F.col("b.w") * F.col("b.h")), 3).alias("area"))
    return pairs.select("video_id", "category_id", F.col("num_masklets").cast("long").alias("n_masklets")).join(boxes, ["video_id", "category_id"])


@register("SELECT i.image_id, CAST(t.threshold AS DOUBLE) AS threshold, coalesce(n.n_gt, 0) AS n_gt FROM (SELECT DISTINCT image_id FROM image_np) i CROSS JOIN (VALUES (0.5), (0.75)) AS t(threshold) LEFT JOIN (SELECT image_id, count(*) AS n_gt FROM gt_boxes WHERE iscrowd = 0 GROUP BY image_id) n USING (image_id)")
def write_image_metrics(spark, d):
    """Image rows with their number of objects, written and read back."""
    path = _folder(spark, "image_metrics")
    n = view(spark, d, "gt_boxes").filter("iscrowd = 0").groupBy("image_id").agg(F.count("*").alias("n_gt"))
    rows = view(spark, d, "image_np").select("image_id").distinct().join(n, "image_id", "left").na.fill(0)
    W.write_image_metrics(rows.withColumn("threshold", F.explode(F.array(F.lit(0.5), F.lit(0.75)))), path)
    return spark.read.schema("image_id long, threshold double, n_gt long").json(path)


@register("SELECT image_id, concat('thing ', CAST(min(phrase_id) % 7 AS STRING)) AS phrase, CAST(min(phrase_id) % 7 AS INT) AS category_id FROM image_np GROUP BY image_id")
def read_image_phrases(spark, d):
    path = _folder(spark, "phrases")
    _documents(spark, d, path)
    return D.read_image_phrases(spark, path).select("image_id", "phrase", "category_id")


@register("SELECT det_id, round(x, 5) AS x, round(w * h, 3) AS area, row_number() OVER (ORDER BY image_id, category_id, score, x, y, w, h) AS place FROM dt_boxes")
def load_predictions(spark, d):
    dt = view(spark, d, "dt_boxes")
    rows = dt.select("image_id", "category_id", "score", F.array(*"xywh").alias("bbox"), F.col("det_id").alias("given"))
    out = D.load_predictions(rows, dt.select("image_id").distinct())
    return out.select(F.col("given").alias("det_id"), F.round("x", 5).alias("x"), F.round("area", 3).alias("area"), F.col("det_id").alias("place"))


@register("SELECT video_id, track_id, sum(w * h) / 8 AS area FROM dt_tracks GROUP BY video_id, track_id")
def load_track_predictions(spark, d):
    t = view(spark, d, "dt_tracks")
    at = t.groupBy("video_id", "category_id", "track_id").agg(F.max("score").alias("score"), F.map_from_entries(F.collect_list(F.struct("frame_idx", F.array(*"xywh")))).alias("at"))
    rows = at.select("video_id", "category_id", "track_id", "score", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.try_element_at("at", i)).alias("bboxes"))
    return D.load_track_predictions(rows, t.select("video_id").distinct()).select("video_id", "track_id", "area")


@register("SELECT CAST(l_linenumber AS BIGINT) AS time, l_orderkey AS id, CASE l_returnflag WHEN 'A' THEN 'one' WHEN 'N' THEN 'two' ELSE 'three' END AS flag, l_returnflag = 'R' AS is_crowd, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL")
def read_detection_text(spark, d):
    path = _folder(spark, "text")
    spark.read.parquet(f"{d}/lineitem.parquet").select(F.concat_ws(",", "l_linenumber", "l_orderkey", "l_returnflag", "l_linestatus", F.lit(""))).write.text(path)
    rows = X.read_detection_text(spark, path, 4, 0, 1, remove_negative_ids=True, valid={3: ["f"]}, crowd={2: ["r"]}, convert={2: {"A": "one", "N": "two", "R": "three"}})
    return rows.groupBy("time", "id", F.col("c2").alias("flag"), "is_crowd").agg(F.count("*").alias("n"))


@register("SELECT source, 'ap50' AS key, round(avg(n_chars), 6) AS value FROM documents GROUP BY source")
def read_dataset_stats(spark, d):
    path = _folder(spark, "stats")
    means = spark.read.parquet(f"{d}/documents.parquet").groupBy("source").agg(F.round(F.avg("n_chars"), 6).alias("mean"))
    folder = F.base64(F.encode(F.coalesce("source", F.lit("~")), "UTF-8"))
    means.select(F.regexp_replace(folder, "[=/+]", "_").alias("set"), F.to_json(F.struct(F.col("mean").alias("x_ap50"), F.lit("other").alias("name"), "source")).alias("value")).write.partitionBy("set").text(path)
    stats = W.read_dataset_stats(spark, f"{path}/*/*", "ap50")
    names = means.select("source", F.concat(F.lit("set="), F.regexp_replace(folder, "[=/+]", "_")).alias("dataset"))
    return stats.join(names, "dataset").select("source", F.lit("ap50").alias("key"), "value")


@register("SELECT conv_id, max(turn) AS value FROM conversations GROUP BY conv_id")
def read_last_metrics(spark, d):
    """A log for each conversation, a line for each turn."""
    path = _folder(spark, "logs")
    turns = spark.read.parquet(f"{d}/conversations.parquet").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(F.lit('{"turn": '), t.cast("string"), F.lit(', "conv": '), F.col("conv_id").cast("string"), F.lit("}"))), "\n")
    turns.select(lines.alias("value")).repartition(8).write.option("maxRecordsPerFile", 1).text(path)
    found = W.read_last_metrics(spark, path, ["turn", "conv"]).groupBy("path").pivot("key", ["turn", "conv"]).agg(F.first("value"))
    return found.select(F.col("conv").cast("long").alias("conv_id"), F.col("turn").cast("int").alias("value"))


@register("SELECT video_id, category_id, count(*) AS n, min(frame_idx) AS first FROM gt_tracks GROUP BY ALL")
def write_metrics(spark, d):
    path = _folder(spark, "metrics")
    rows = view(spark, d, "gt_tracks").groupBy("video_id", "category_id").agg(F.count("*").alias("n"), F.min("frame_idx").cast("long").alias("first"))
    long = rows.unpivot(["video_id", "category_id"], ["n", "first"], "metric", "value")
    W.write_metrics(long.groupBy("metric").agg(F.sum("value").alias("value")), long, path)
    return spark.read.json(f"{path}/video_np_results").select("video_id", "category_id", "n", F.col("first").cast("int").alias("first"))


def _by_sequence(spark, d):
    rows = view(spark, d, "gt_tracks").groupBy((F.col("video_id") % 20).cast("string").alias("seq"), F.col("frame_idx").alias("alpha")).agg(F.round(F.avg("w"), 4).alias("hota"), F.count("*").cast("double").alias("tp"))
    whole = rows.groupBy("alpha").agg(F.round(F.avg("hota"), 4).alias("hota"), F.sum("tp").alias("tp")).withColumn("seq", F.lit("COMBINED"))
    return rows.unionByName(whole)


@register("SELECT CAST(video_id % 20 AS STRING) AS seq, CAST(frame_idx AS STRING) AS alpha, 'tp' AS field, CAST(count(*) AS DOUBLE) AS value FROM gt_tracks GROUP BY ALL UNION ALL SELECT 'COMBINED_SEQ', CAST(frame_idx AS STRING), 'tp', count(*) FROM gt_tracks GROUP BY ALL")
def read_detailed(spark, d):
    path = _folder(spark, "detailed")
    W.write_detailed(_by_sequence(spark, d), path, ["hota", "tp"])
    return W.read_detailed(spark, path).filter("field = 'tp' and alpha <> 'AUC'").select("seq", "alpha", "field", "value")


@register()
def write_summary(spark, d):
    path = _folder(spark, "summary")
    W.write_summary(_by_sequence(spark, d).filter("seq = 'COMBINED'").drop("seq"), path, ["tp", "hota"])
    return spark.read.csv(path, header=True, sep=" ")


def _life(spark, d):
    """Frames of tracks as events: a track is matched where it has a box, and its overlaps are the
    track before it in the video, in even frames."""
    tracks = view(spark, d, "dt_tracks").filter("track_id - video_id * 100 < 100000000")
    each = tracks.groupBy("video_id", "track_id").agg(F.collect_set("frame_idx").alias("seen"), F.min("frame_idx").alias("first"))
    rows = each.withColumn("frame_idx", F.explode(F.sequence(F.lit(0), F.lit(7)))).filter("frame_idx >= first")
    older = F.when((F.col("frame_idx") % 2 == 0) & (F.col("track_id") % 3 == 0), F.array(F.col("track_id") - 1)).otherwise(F.array().cast("array<bigint>"))
    return rows.select(F.col("video_id").cast("long").alias("video_id"), F.col("frame_idx").cast("long").alias("frame_idx"), F.col("track_id").cast("long").alias("object_id"), F.array_contains("seen", F.col("frame_idx")).alias("matched"), (F.col("track_id") % 17 == 0).alias("is_empty"), older.alias("overlaps"), (F.col("frame_idx") == 7).alias("is_last"))


_RULES = L.Rules(start_delay=6, unmatched=2, overlap=3, keep_init=1, keep_max=2, keep_min=-1, confirm=2, delay=2)


@register()
def track_lifecycle(spark, d):
    return L.track_frames(_life(spark, d), _RULES)


@register()
def track_lifecycle_stream(spark, d):
    """The same from a stream of files of whole videos."""
    path = _folder(spark, "life")
    rows = _life(spark, d)
    rows.repartition(4, "video_id").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    return V.run_available(L.track_stream(stream, _RULES), path)


@register("SELECT image_id AS video_id, category_id AS frame_idx, det_id, row_number() OVER (PARTITION BY image_id ORDER BY category_id, det_id) AS object_id FROM dt_boxes")
def assign_object_ids(spark, d):
    dets = view(spark, d, "dt_boxes").select(F.col("image_id").alias("video_id"), F.col("category_id").alias("frame_idx"), "det_id", "score")
    return V.assign_object_ids(dets)


@register(_METER)
def streaming_meter(spark, d):
    """The meter on a stream of files; the last value of each key stands."""
    path = _folder(spark, "meter")
    rows = _meter_rows(spark, d)
    rows.repartition(3).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    out = V.run_available(V.streaming_meter(stream, "category_id"), path, "update")
    last = out.groupBy("category_id").agg(F.max_by(F.struct("total", "count", "mean", "last"), "batch").alias("m")).select("category_id", "m.*")
    return last.withColumns({c: F.round(c, 6) for c in ("total", "mean")})


@register("SELECT video_id, category_id, track_id, CAST(min(shard) AS BIGINT) AS shard FROM (SELECT DISTINCT image_id AS video_id, category_id, det_id AS track_id, image_id % 2 AS shard FROM dt_boxes) GROUP BY ALL")
def stream_dedup(spark, d):
    """A stream in which every odd video comes again from a later shard."""
    path = _folder(spark, "shards")
    t = view(spark, d, "dt_boxes").select(F.col("image_id").alias("video_id"), F.col("category_id").cast("long").alias("category_id"), F.col("det_id").alias("track_id"), (F.col("image_id") % 2).cast("long").alias("shard"), F.timestamp_seconds("category_id").alias("ts"))
    t.unionByName(t.withColumn("shard", F.col("shard") + 2)).repartition(4, "video_id").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(t.schema).parquet(f"{path}/in")
    return V.run_available(V.stream_dedup(stream), path).select("video_id", "category_id", "track_id", "shard")



"""Ids, clean-up and changes of form of annotation and prediction documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.boxes import box, intersection, iou, known
from ..shared import settled
from .matching import optimal_match

#: Rows of a table that may go to every executor.
SMALL_TABLE = 10_000


def _raise_unless(bad: DataFrame, message: str) -> None:
    first = bad.first()
    if first is not None:
        raise ValueError(f"{message}: {first.asDict()}")


def _present() -> Column:
    """A box that is neither null nor all zero."""
    return known() & F.coalesce((F.col("w") * F.col("h") > 0) & (F.greatest(*(F.col(c) for c in "xywh")) > 0), F.lit(False))


def present(dt: DataFrame) -> Column:
    """_present, and where there is a column area, one above 0."""
    return _present() & (F.lit(True) if "area" not in dt.columns else F.coalesce(F.col("area") > 0, F.lit(False)))


def null_empty_detections(dt: DataFrame) -> DataFrame:
    """Boxes of no area, null or all zero become null (and area, where there is one); score
    becomes 1."""
    there = present(dt)
    columns = [c for c in ("x", "y", "w", "h", "area") if c in dt.columns]
    return dt.withColumn("there", there).withColumns({c: F.when(F.col("there"), F.col(c)) for c in columns}).withColumn("score", F.lit(1.0)).drop("there")


def merge_eval_rows(*shards: DataFrame) -> DataFrame:
    """Union of the shards' rows, of each image_id those of the first shard only, one row."""
    rows = shards[0].withColumn("shard", F.lit(0))
    for i, other in enumerate(shards[1:], 1):
        rows = rows.unionByName(other.withColumn("shard", F.lit(i)))
    rank = F.row_number().over(Window.partitionBy("image_id").orderBy("shard", *[c for c in shards[0].columns if c != "image_id"]))
    return rows.withColumn("place", rank).filter("place = 1").drop("place", "shard")


def unique_track_ids(anns: DataFrame) -> DataFrame:
    """Tracks whose id is used in several videos get new ids from the greatest on, one for
    each video; adds old_track_id."""
    videos = anns.select("track_id", "video_id").distinct()
    shared = videos.groupBy("track_id").agg(F.count("*").alias("n")).filter("n > 1").select("track_id")
    again = videos.join(shared, "track_id")
    top = anns.agg(F.max("track_id").alias("top"))
    numbered = again.join(numbers(again, "track_id", "video_id"), ["track_id", "video_id"]).join(F.broadcast(top))
    new = numbered.select("track_id", "video_id", (F.col("top") + F.col("number")).alias("new_id"))
    out = anns.join(new, ["track_id", "video_id"], "left")
    return out.withColumns({"old_track_id": F.col("track_id"), "track_id": F.coalesce("new_id", "track_id")}).drop("new_id")


def numbers(rows: DataFrame, *keys: str, parts: int = 256) -> DataFrame:
    """The distinct keys with `number`, 1 to n in their order. Keys are cut into ranges, each
    numbered by itself after the sizes of those before it, so that no task has all."""
    distinct = rows.select(*keys).distinct()
    ranged = distinct.repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id())
    own = ranged.withColumn("own", F.row_number().over(Window.partitionBy("part").orderBy(*keys)))
    own = settled(own)  # range ends are drawn from a sample, so that the parts must not be made twice
    sizes = own.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "base")
    return own.join(F.broadcast(bases), "part").select(*keys, (F.col("base") + F.col("own")).alias("number"))


def rows_before(rows: DataFrame, key: str, parts: int = 256) -> DataFrame:
    """Each key with `before`, the number of rows of smaller keys: counted in ranges as in `numbers`."""
    ranged = rows.groupBy(key).agg(F.count("*").alias("n")).repartitionByRange(parts, key).withColumn("part", F.spark_partition_id())
    upto = Window.partitionBy("part").orderBy(key)
    own = settled(ranged.withColumn("own", F.sum("n").over(upto) - F.col("n")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = own.groupBy("part").agg(F.sum("n").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "base")
    return own.join(F.broadcast(bases), "part").select(key, (F.col("base") + F.col("own")).alias("before"))


def class_agnostic(tracks: DataFrame) -> DataFrame:
    """Tracks numbered 1 to n over all videos, in one category; adds old_track_id."""
    new = numbers(tracks, "video_id", "track_id")
    out = tracks.join(new, ["video_id", "track_id"])
    return out.withColumns({"old_track_id": F.col("track_id"), "track_id": F.col("number"), "category_id": F.lit(1).cast("long")}).drop("number")


def single_category(rows: DataFrame, videos: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows in category 1, and videos whose file names begin with their zero-padded id."""
    named = F.transform("file_names", lambda f: F.concat(F.lpad(F.col("video_id").cast("string"), 6, "0"), F.lit("_"), f))
    return rows.withColumn("category_id", F.lit(1).cast("long")), videos.withColumn("file_names", named)


def reindex_from_one(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables whose ids begin at 0 have 1 added to them and to what refers to them."""
    def shift(table: DataFrame, name: str) -> DataFrame:
        return F.broadcast(table.agg(F.coalesce((F.min("id") == 0).cast("int"), F.lit(0)).alias(name)))

    s = [shift(t, n) for t, n in ((images, "s_image"), (annotations, "s_ann"), (categories, "s_cat"))]
    both = annotations.join(s[0]).join(s[1]).join(s[2])
    both = both.withColumns({"id": F.col("id") + F.col("s_ann"), "image_id": F.col("image_id") + F.col("s_image"), "category_id": F.col("category_id") + F.col("s_cat")})
    return (images.join(s[0]).withColumn("id", F.col("id") + F.col("s_image")).select(*images.columns), both.select(*annotations.columns), categories.join(s[2]).withColumn("id", F.col("id") + F.col("s_cat")).select(*categories.columns))


def assert_unique_ids(gt: DataFrame, dt: DataFrame) -> None:
    """Raise if a track is twice in a frame on either side."""
    for name, df in (("ground truth", gt), ("predictions", dt)):
        twice = df.groupBy("video_id", "frame_idx", "track_id").agg(F.count("*").alias("n")).filter("n > 1").orderBy("video_id", "frame_idx", "track_id")
        _raise_unless(twice, f"{name} has a track twice in a frame")


def unknown_images(predictions: DataFrame, images: DataFrame) -> DataFrame:
    """Image ids of predictions that no image has."""
    return predictions.select("image_id").distinct().join(images.select("image_id"), "image_id", "left_anti")


def assert_known_images(predictions: DataFrame, images: DataFrame) -> None:
    _raise_unless(unknown_images(predictions, images), "prediction on an unknown image")


def exhaustive_images(images: DataFrame) -> DataFrame:
    """Ids of the images (annotator, image_id, is_instance_exhaustive) that annotator 0 marks
    exhaustive and no other marks as not."""
    first = images.filter("annotator = 0 and is_instance_exhaustive").select("image_id").distinct()
    return first.join(images.filter("annotator <> 0 and not is_instance_exhaustive"), "image_id", "left_anti")


def fill_from_parent(rows: DataFrame, parents: DataFrame, key: str, *columns: str) -> DataFrame:
    """Nulls in columns filled from the parent row of the same key."""
    named = parents.select(key, *(F.col(c).alias(f"parent_{c}") for c in columns))
    out = rows.join(named, key, "left").withColumns({c: F.coalesce(c, f"parent_{c}") for c in columns})
    return out.select(*rows.columns)


def add_unpredicted_images(results: DataFrame, images: DataFrame) -> DataFrame:
    """A row for each image: its results, or nulls where it has none; adds is_predicted."""
    return images.select("image_id").distinct().join(results.withColumn("is_predicted", F.lit(True)), "image_id", "left").na.fill(False, ["is_predicted"])


def numbered_pairs(gt: DataFrame, dt: DataFrame, declared: DataFrame) -> DataFrame:
    """All pairs of video and category of either side, numbered from 1 in order, and after
    them the declared ones that neither side has; is_declared_only tells these."""
    keys = ["video_id", "category_id"]
    seen = gt.select(*keys).unionByName(dt.select(*keys)).distinct()
    first = numbers(seen, *keys).withColumn("is_declared_only", F.lit(False))
    more = numbers(declared.select(*keys).join(seen, keys, "left_anti"), *keys)
    total = F.broadcast(seen.agg(F.count("*").alias("total")))
    more = more.join(total).select(*keys, (F.col("number") + F.col("total")).alias("number"), F.lit(True).alias("is_declared_only"))
    return first.unionByName(more).withColumnRenamed("number", "pair_id")


def paired_videos(videos: DataFrame, pairs: DataFrame) -> DataFrame:
    """A copy of the video for each pair it is in: pair_id as video_id, old ids kept."""
    out = videos.join(pairs.select("video_id", "category_id", "pair_id"), "video_id")
    return out.withColumns({"old_video_id": F.col("video_id"), "old_category_id": F.col("category_id"), "video_id": F.col("pair_id")}).drop("pair_id", "category_id")


def frame_lookup(predictions: DataFrame, frames: DataFrame) -> DataFrame:
    """predictions with the image_id of their (video_id, frame_idx); a frame without an image
    is an error when the rows are read."""
    out = predictions.join(frames.select("video_id", "frame_idx", "image_id"), ["video_id", "frame_idx"], "left")
    ok = F.assert_true(F.col("image_id").isNotNull(), F.concat(F.lit("no image of frame "), F.concat_ws("/", "video_id", "frame_idx")))
    return out.withColumn("image_id", F.when(ok.isNull(), F.col("image_id")))


def metadata_join(images: DataFrame, metadata: DataFrame, key: str = "stem") -> DataFrame:
    """Images that have metadata, with it and the flattened path of the file."""
    return images.join(metadata, key).withColumn("flat_path", F.replace("path", F.lit("/"), F.lit("_")))


def frame_annotations(annotations: DataFrame, categories: DataFrame, video_id: int, frame_idx: int) -> DataFrame:
    """Masks and phrases that a frame shows, in the order of the phrases."""
    rows = annotations.filter((F.col("video_id") == video_id) & (F.col("frame_idx") == frame_idx))
    return rows.join(categories.select("category_id", "name"), "category_id").orderBy("name", "track_id")


def tracks_to_frames(tracks: DataFrame, frames: DataFrame, predicted: bool = False) -> DataFrame:
    """Masklet rows (video_id, category_id, track_id, areas array, boxes array of structs x, y,
    w, h; index = frame) -> one row for each frame with a box: id from 1, image_id, area as
    given or, if not above 0, w * h. Predictions leave out all-zero boxes too."""
    rows = tracks.select("video_id", "category_id", "track_id", "areas", F.posexplode("boxes").alias("frame_idx", "box")).filter("box is not null")
    if predicted:
        rows = rows.filter("not (box.x = 0 and box.y = 0 and box.w = 0 and box.h = 0)")
    given = F.try_element_at("areas", F.col("frame_idx") + 1)
    rows = rows.withColumn("area", F.when(given > 0, given.cast("double")).otherwise(F.col("box.w") * F.col("box.h"))).select("video_id", "category_id", "track_id", "frame_idx", "box.*", "area")
    rows = frame_lookup(rows, frames)
    # ids rise by video first, so that rows are numbered where their video lies
    within = F.row_number().over(Window.partitionBy("video_id").orderBy("category_id", "track_id", "frame_idx"))
    placed = rows.withColumn("within", within).join(rows_before(rows, "video_id"), "video_id")
    return placed.withColumn("id", F.col("before") + F.col("within")).drop("before", "within")


def frames_to_tracks(rows: DataFrame, videos: DataFrame) -> DataFrame:
    """For each video its tracks: struct of track_id, category_id, mean area and the boxes in
    frame order; a video without tracks has none."""
    entry = F.struct("frame_idx", "x", "y", "w", "h")
    each = rows.groupBy("video_id", "track_id", "category_id").agg(F.array_sort(F.collect_list(entry)).alias("boxes"), F.avg(F.col("w") * F.col("h")).alias("area"))
    each = each.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("track_id", "category_id", "area", "boxes"))).alias("tracks"))
    return videos.select("video_id").distinct().join(each, "video_id", "left").withColumn("tracks", F.coalesce("tracks", F.array().cast(each.schema["tracks"].dataType)))


def timesteps(frames: DataFrame) -> DataFrame:
    """Images of a video numbered from 0 in frame order."""
    order = Window.partitionBy("video_id").orderBy("frame_idx", "image_id")
    return frames.withColumn("timestep", F.row_number().over(order) - 1)


def tile_image(rows: DataFrame, n: int, keep_geometry: bool = False) -> DataFrame:
    """n copies of the rows of still images, one for each frame; rows with an input box go
    unless they are kept."""
    kept = rows if keep_geometry or "input_box" not in rows.columns else rows.filter("input_box is null")
    return kept.withColumn("frame_idx", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def to_prediction_rows(grouped: DataFrame) -> DataFrame:
    """image_id, boxes (arrays of x0, y0, x1, y1), scores, labels -> a row for each detection.
    Arrays of different lengths are an error; empty ones give no row."""
    same = (F.size("boxes") == F.size("scores")) & (F.size("boxes") == F.size("labels"))
    checked = grouped.withColumn("ok", F.assert_true(same, F.lit("boxes, scores and labels differ in number"))).filter("ok is null")
    rows = checked.select("image_id", F.inline(F.arrays_zip("boxes", "scores", "labels")))
    b = F.col("boxes")
    return rows.select("image_id", F.col("labels").alias("category_id"), b[0].alias("x"), b[1].alias("y"), (b[2] - b[0]).alias("w"), (b[3] - b[1]).alias("h"), F.col("scores").alias("score"))


def pad_track_frames(rows: DataFrame, n_frames: int) -> DataFrame:
    """For each object (video_id, track_id, with one score and category) a row for each frame,
    null where it has no box."""
    objects = rows.groupBy("video_id", "track_id").agg(F.max("score").alias("score"), F.min("category_id").alias("category_id"))
    grid = objects.withColumn("frame_idx", F.explode(F.sequence(F.lit(0), F.lit(n_frames - 1))))
    return grid.join(rows.select("video_id", "track_id", "frame_idx", *"xywh"), ["video_id", "track_id", "frame_idx"], "left")


def build_queries(images: DataFrame, annotations: DataFrame, categories: DataFrame, include_negatives: bool = True, chunk_size: int | None = None, prompts: DataFrame | None = None) -> DataFrame:
    """A row for each image and category: datapoint_id (image index times the number of
    chunks, plus the category's chunk), text, object ids and boxes over the image size.
    Categories are broadcast up to SMALL_TABLE of them; prompts (category_id, prompt) stand in for names, and
    must be one for each category. Without include_negatives empty cells go."""
    cats = categories.withColumn("place", F.row_number().over(Window.orderBy("category_id")) - 1)
    n = cats.count()
    if prompts is not None:
        if prompts.count() != n:
            raise ValueError("prompts must be as many as categories")
        cats = cats.join(prompts, "category_id").withColumn("name", F.col("prompt")).drop("prompt")
    size = chunk_size or max(1, n)
    cats = cats.withColumn("chunk", F.floor(F.col("place") / size))
    cells = images.join(numbers(images, "image_id"), "image_id").withColumn("index", F.col("number") - 1).join(F.broadcast(cats) if n <= SMALL_TABLE else cats)
    u = F.col("width"), F.col("height")
    rel = [F.least(F.greatest(F.col(c) / side, F.lit(0.0)), F.lit(1.0)) for c, side in zip("xywh", (*u, *u), strict=True)]
    anns = annotations.join(images.select("image_id", "width", "height"), "image_id").select("image_id", "category_id", "ann_id", F.struct("ann_id", *(r.alias(c) for r, c in zip(rel, "xywh", strict=True))).alias("object"))
    anns = anns.groupBy("image_id", "category_id").agg(F.array_sort(F.collect_list("object")).alias("objects"))
    out = cells.join(anns, ["image_id", "category_id"], "left" if include_negatives else "inner")
    return out.select((F.col("index") * -(-n // size) + F.col("chunk")).alias("datapoint_id"), "image_id", "category_id", F.col("name").alias("query_text"), F.coalesce(F.size("objects"), F.lit(0)).alias("n_objects"), "objects")


def expand_video_queries(videos: DataFrame, pairs: DataFrame) -> DataFrame:
    """A row for each pair (video_id, category_id, noun_phrase) and frame of its video."""
    rows = pairs.join(videos.select("video_id", "file_names"), "video_id")
    rows = rows.select("video_id", "category_id", "noun_phrase", F.posexplode("file_names").alias("frame_idx", "file_name"))
    return rows.withColumns({"query_processing_order": F.col("frame_idx"), "image_id": F.col("frame_idx")})


def non_exhaustive_cleanup(gt: DataFrame, dt: DataFrame, negatives: DataFrame, not_exhaustive: DataFrame, least: float = 0.5) -> DataFrame:
    """Predictions without those that match no ground truth of their frame and category
    (1:1, IoU from `least` on) where the video does not declare the category negative and the
    frame has none of it, or where the category is declared not exhaustive for the video.
    negatives, not_exhaustive: video_id, category_id."""
    on = ["video_id", "frame_idx", "category_id"]
    a = gt.select(*on, F.col("track_id").alias("gt_id"), *(F.col(c).alias(f"gt_{c}") for c in "xywh"))
    b = dt.select(*on, F.col("track_id").alias("dt_id"), *(F.col(c).alias(f"dt_{c}") for c in "xywh"))
    pairs = a.join(b, on).select(*on, "gt_id", "dt_id", iou(box("gt_"), box("dt_")).alias("iou")).filter(F.col("iou") >= least)
    matched = optimal_match(pairs, on, "gt_id", "dt_id", "iou").select(*on, F.col("dt_id").alias("track_id"), F.lit(True).alias("matched"))
    keys = ["video_id", "category_id"]
    rows = dt.join(matched, [*on, "track_id"], "left")
    rows = rows.join(gt.select(*on).distinct().withColumn("has_gt", F.lit(True)), on, "left")
    rows = rows.join(negatives.select(*keys).distinct().withColumn("negative", F.lit(True)), keys, "left")
    rows = rows.join(not_exhaustive.select(*keys).distinct().withColumn("loose", F.lit(True)), keys, "left")
    go = F.col("matched").isNull() & ((F.col("has_gt").isNull() & F.col("negative").isNull()) | F.col("loose").isNotNull())
    return rows.filter(~go).select(*dt.columns)


def visible_objects(objects: DataFrame, *hidden: DataFrame) -> DataFrame:
    """Objects (video_id, frame_idx, track_id, area, x, y, w, h, frame_w, frame_h) with a mask
    whose id no hidden table (video_id, track_id, and frame_idx where it is by frame) has,
    with the box over the frame's size."""
    rows = objects.filter("area > 0")
    for table in hidden:
        rows = rows.join(table, [c for c in ("video_id", "frame_idx", "track_id") if c in table.columns], "left_anti")
    return rows.withColumns({c: F.col(c) / F.col(side) for c, side in (("x", "frame_w"), ("y", "frame_h"), ("w", "frame_w"), ("h", "frame_h"))})


def track_presence(scores: DataFrame, threshold: float) -> DataFrame:
    """Object slots (track_id, logit) of frames that count as tracked."""
    return scores.filter((F.col("track_id") != -1) & (1 / (1 + F.exp(-F.col("logit"))) >= threshold))


def track_rollup(frames: DataFrame, n_frames: int) -> DataFrame:
    """video_id, track_id, score (mean where tracked), label (the most common, the smallest of
    equals), and scores of all frames, -1e8 where there is none. frames: video_id, track_id,
    frame_idx, score, label."""
    keys = ["video_id", "track_id"]
    label = frames.groupBy(*keys, "label").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.max(F.struct("n", (-F.col("label")).alias("minus"))).alias("m"))
    rolled = frames.groupBy(*keys).agg(F.avg("score").alias("score"), F.map_from_entries(F.collect_list(F.struct("frame_idx", "score"))).alias("by_frame")).join(label, keys)
    padded = F.transform(F.sequence(F.lit(0), F.lit(n_frames - 1)), lambda i: F.coalesce(F.try_element_at("by_frame", i), F.lit(-1e8)))
    return rolled.select(*keys, "score", (-F.col("m.minus")).alias("label"), padded.alias("frame_scores"))


def object_count(scores: DataFrame, threshold: float) -> DataFrame:
    """Detections of each image whose score, times that of presence, is above the threshold.
    scores: image_id, logit, presence_logit."""
    score = (1 / (1 + F.exp(-F.col("logit")))) * (1 / (1 + F.exp(-F.col("presence_logit"))))
    return scores.groupBy("image_id").agg(F.count_if(score > threshold).alias("n_objects"))


def weighted_meter(values: DataFrame, *by: str) -> DataFrame:
    """Sum, count, weighted mean and last value of (value, n, step)."""
    total, n = F.sum(F.col("value") * F.col("n")), F.sum("n")
    return values.groupBy(*by).agg(total.alias("total"), n.alias("count"), F.when(n != 0, total / F.when(n != 0, n)).alias("mean"), F.max_by("value", "step").alias("last"))


def stage_consistency(queries: DataFrame) -> DataFrame:
    """Datapoints whose stages have different numbers of queries, with the most common one."""
    stages = queries.groupBy("datapoint_id", "query_processing_order").agg(F.count("*").alias("n"))
    often = stages.groupBy("datapoint_id", "n").agg(F.count("*").alias("times")).groupBy("datapoint_id").agg(F.max(F.struct("times", F.col("n").alias("of"))).alias("most"), F.count("*").alias("kinds"))
    return often.filter("kinds > 1").select("datapoint_id", F.col("most.of").alias("most_common"), "kinds")


def remap_stages(frames: DataFrame, reverse: bool = False, wanted: int | None = None) -> DataFrame:
    """Stages of each datapoint (column stage) as 0 to k - 1, in reverse if asked for; with
    wanted, fewer stages than that are an error when the rows are read."""
    order = F.desc("stage") if reverse else F.col("stage").asc()
    out = frames.withColumn("new_stage", F.dense_rank().over(Window.partitionBy("datapoint_id").orderBy(order)) - 1)
    if wanted is not None:
        have = F.max("new_stage").over(Window.partitionBy("datapoint_id")) + 1
        ok = F.assert_true(F.col("have") == wanted, F.lit("a requested stage is missing"))
        out = out.withColumn("have", have).withColumn("stage", F.when(ok.isNull(), F.col("new_stage"))).drop("have", "new_stage")
        return out
    return out.withColumn("stage", F.col("new_stage")).drop("new_stage")


def strided_frames(frames: DataFrame, n: int, stride: int, seed: int) -> DataFrame:
    """n frames of each video, `stride` apart (less where the video is too short), from a start
    that the seed draws. A video of fewer than n frames is an error when the rows are read."""
    own = Window.partitionBy("video_id")
    rows = frames.withColumns({"place": F.row_number().over(own.orderBy("frame_idx")) - 1, "total": F.count("*").over(own)})
    ok = F.assert_true(F.col("total") >= n, F.concat(F.lit("too few frames in video "), F.col("video_id").cast("string")))
    step = F.least(F.lit(stride), F.floor((F.col("total") - 1) / max(1, n - 1))) if n > 1 else F.lit(1)
    rows = rows.withColumn("step", F.when(ok.isNull(), step))
    span = F.col("step") * (n - 1)
    rows = rows.withColumn("start", F.pmod(F.xxhash64(F.lit(seed), "video_id"), F.col("total") - span))
    away = F.col("place") - F.col("start")
    return rows.filter((away >= 0) & (away <= span) & (away % F.col("step") == 0)).select(*frames.columns)


def frame_order(videos: DataFrame, start: int, most: int, reverse: bool = False) -> DataFrame:
    """The frames of each video (video_id, n_frames) in the order they are worked on."""
    last = F.col("n_frames") - 1
    if reverse:
        low = F.greatest(F.lit(start - most), F.lit(0))
        steps = F.when(F.lit(start) > low, F.sequence(F.lit(start - 1), F.least(low, F.lit(max(start - 1, 0))), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    else:
        steps = F.when(last >= start, F.sequence(F.lit(start), F.greatest(F.least(F.lit(start + most), last), F.lit(start)).cast("int"))).otherwise(F.array().cast("array<int>"))
    return videos.select("video_id", F.posexplode(steps).alias("place", "frame_idx"))


def limit_ids(rows: DataFrame, n: int, key: str = "image_id") -> DataFrame:
    """n of the distinct ids, the same on every run: those of least hash of id and n."""
    return rows.select(key).distinct().orderBy(F.xxhash64(F.col(key), F.lit(n)), key).limit(n)


def keep_top_new(dets: DataFrame, existing: DataFrame, most: int) -> DataFrame:
    """New detections (video_id, det_id, score) of highest score, so many as leave a video with
    no more than `most` objects. existing: video_id, n_objects."""
    order = Window.partitionBy("video_id").orderBy(F.desc("score"), "det_id")
    rows = dets.join(existing, "video_id", "left").na.fill(0, ["n_objects"]).withColumn("rank", F.row_number().over(order))
    return rows.filter(F.col("rank") + F.col("n_objects") <= most).select(*dets.columns)


def best_annotator(evals: DataFrame) -> DataFrame:
    """Of the evaluations of each image (image_id, annotator, mean_f1; null where there is no
    F1) the one taken: from annotator 0 on the next of strictly higher F1 replaces the one
    so far; where either has none, the next replaces it only if it has none itself."""
    row = F.struct("annotator", "mean_f1")

    def better(old: Column, new: Column) -> Column:
        both = old["mean_f1"].isNotNull() & new["mean_f1"].isNotNull()
        take = F.when(both, new["mean_f1"] > old["mean_f1"]).otherwise(new["mean_f1"].isNull())
        return F.when(old["annotator"].isNull() | take, new).otherwise(old)

    rows = evals.groupBy("image_id").agg(F.array_sort(F.collect_list(row)).alias("all"))
    kind = rows.schema["all"].dataType.elementType
    none = F.lit(None).cast(kind)
    return rows.select("image_id", F.aggregate("all", none, better).alias("best")).select("image_id", "best.annotator", "best.mean_f1")




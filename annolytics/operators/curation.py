"""Filters, frame selection, clean-up and profiles of annotation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.boxes import Box, to_corners


def category_subset(df: DataFrame, ids: DataFrame, unknown: bool = False) -> DataFrame:
    """Rows whose category_id is in ids, or with unknown those whose is not."""
    return df.join(ids.select("category_id").distinct(), "category_id", "left_anti" if unknown else "left_semi")


def valid_box(b: Box, threshold: float = 0.0) -> Column:
    return (b[2] > threshold) & (b[3] > threshold)


def inside_box(b: Box, width: Column, height: Column, tolerance: float = 0.0) -> Column:
    x0, y0, x1, y1 = to_corners(b)
    return (x0 >= -tolerance) & (y0 >= -tolerance) & (x1 < width + tolerance) & (y1 < height + tolerance)


def max_tracks_per_video(tracks: DataFrame, n: int) -> DataFrame:
    """Tracks of videos whose first frame has at most n objects; n of 0 or less is off."""
    if n <= 0:
        return tracks
    first = tracks.groupBy("video_id", "frame_idx").agg(F.count("*").alias("n")).groupBy("video_id").agg(F.min_by("n", "frame_idx").alias("n"))
    return tracks.join(first.filter(F.col("n") > n).select("video_id"), "video_id", "left_anti")


def merge_categories(df: DataFrame, targets: DataFrame) -> DataFrame:
    """category_id replaced by `target` of targets (category_id, target), where there is one."""
    return df.join(targets.select("category_id", "target"), "category_id", "left").withColumn("category_id", F.coalesce("target", "category_id")).drop("target")


def availability(tables: dict[str, DataFrame], available: DataFrame, key: str) -> DataFrame:
    """For each table the rows before, after and removed when keys that are not available go."""
    keys = available.select(key).distinct().withColumn("there", F.lit(True))
    counts = []
    for name, df in tables.items():
        kept = df.select(key).join(keys, key, "left").agg(F.count("*").alias("n_before"), F.count("there").alias("n_after"))
        counts.append(kept.select(F.lit(name).alias("table_name"), "n_before", "n_after", (F.col("n_before") - F.col("n_after")).alias("n_removed")))
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


def available_tables(tables: dict[str, DataFrame], available: DataFrame, key: str) -> dict[str, DataFrame]:
    """The tables without the rows whose key is not available, all columns as they are."""
    keys = available.select(key).distinct()
    return {name: df.join(keys, key, "left_semi").select(*df.columns) for name, df in tables.items()}


def nearest_frames(targets: DataFrame, references: DataFrame, k: int, keep_first: bool = False) -> DataFrame:
    """For each target (video_id, frame_idx) up to k reference frames of its video: the
    latest before it, the earliest not before it, then the closest (ties: the earlier).
    With keep_first the earliest one before it, or else the last one after it, comes first.

    The k closest are among the k last before and the k first not before a target. A reference
    knows its neighbours in order, and those of the last one before a target are the target's:
    no target is joined with references.
    """
    if k < 2:
        raise ValueError("k must be 2 or more")
    sides = [df.select("video_id", F.col("frame_idx").alias("at"), F.lit(i == 0).alias("is_target"), F.lit(i == 1).alias("is_ref")).distinct() for i, df in enumerate((targets, references))]
    frames = sides[0].unionByName(sides[1]).repartition("video_id").groupBy("video_id", "at").agg(F.max("is_target").alias("is_target"), F.max("is_ref").alias("is_ref"))
    own, video = Window.partitionBy("video_id", "is_ref").orderBy("at"), Window.partitionBy("video_id")
    steps = {f"upto{i}": F.lag("at", i).over(own) if i else F.col("at") for i in range(k)} | {f"after{i}": F.lead("at", i + 1).over(own) for i in range(k)}
    rows = frames.withColumns({n: F.when(F.col("is_ref"), c) for n, c in steps.items()})
    upto_now = video.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    first = F.min(F.when(F.col("is_ref"), F.struct("at", *(f"after{i}" for i in range(k - 1))))).over(video)
    last = F.last(F.when(F.col("is_ref"), F.struct(*steps)), ignorenulls=True).over(upto_now)
    rows = rows.withColumns({"first": first, "last": last, "highest": F.max(F.when(F.col("is_ref"), F.col("at"))).over(video)}).filter("is_target and first is not null")
    # before the first reference there is none, and it and those after it are the ones that follow
    none = F.col("last").isNull()
    before = [F.col(f"last.upto{i}") for i in range(k)]
    after = [F.when(none, F.col("first.at") if i == 0 else F.col(f"first.after{i - 1}")).otherwise(F.col(f"last.after{i}")) for i in range(k)]
    pinned = F.when(none, F.col("highest")).otherwise(F.col("first.at"))

    def place(frame: Column, later: int) -> Column:
        level = F.when(frame == pinned, F.lit(-1)).otherwise(F.lit(later)) if keep_first else F.lit(later)
        # what is not there comes last and is left out at the end
        return F.struct(F.when(frame.isNull(), F.lit(2)).otherwise(level).alias("later"), F.abs(F.col("at") - frame).alias("distance"), frame.alias("ref_frame"))

    options = [place(frame, min(i, 1)) for side in (before, after) for i, frame in enumerate(side)]
    wanted = F.array_distinct(F.array(*options, place(pinned, -1))) if keep_first else F.array(*options)
    out = rows.select("video_id", F.col("at").alias("frame_idx"), F.posexplode(F.slice(F.sort_array(wanted), 1, k)).alias("pos", "ref")).filter("ref.later < 2")
    return out.select("video_id", "frame_idx", "ref.ref_frame", (F.col("pos") + 1).alias("rank"))


def best_candidate(candidates: DataFrame, group: str, item: str) -> DataFrame:
    """Of the candidates (iou, score) of each group that of highest iou, or, if all have
    none, of highest score; ties to the smaller item."""
    any_iou = F.max("iou").over(Window.partitionBy(group)) > 0
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("merit"), item))
    return candidates.withColumn("merit", F.when(any_iou, F.col("iou")).otherwise(F.col("score"))).withColumn("rank", rank).filter("rank = 1").drop("rank", "merit")


def repeated_ids(tracks: DataFrame) -> DataFrame:
    """Track ids that occur more than once in a frame, with their number."""
    return tracks.groupBy("video_id", "frame_idx", "track_id").agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def track_area(tracks: DataFrame, n_frames: int) -> DataFrame:
    """Mean area of each track over all n_frames (absent as 0), and over those it is in."""
    area = F.sum(F.col("w") * F.col("h"))
    return tracks.groupBy("video_id", "track_id").agg((area / n_frames).alias("mean_area"), (area / F.count("*")).alias("mean_seen_area"))


def benchmark_profile(images: DataFrame, gt: DataFrame, domain: str) -> DataFrame:
    """For each domain: images, masks, and images with and without any."""
    masks = gt.groupBy("image_id").agg(F.count("*").alias("n"))
    rows = images.join(masks, "image_id", "left")
    return rows.groupBy(domain).agg(F.count("*").alias("n_images"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_masks"), F.count("n").alias("n_positive"), (F.count("*") - F.count("n")).alias("n_negative"))


def mask_union(runs: DataFrame, *keys: str) -> DataFrame:
    """Runs of the union of all masks of a key: runs of a column that overlap or touch are one."""
    end = F.col("row_start") + F.col("run_len")
    order = Window.partitionBy(*keys, "col").orderBy("row_start", "row_end")
    rows = runs.select(*keys, "col", "row_start", end.alias("row_end"))
    reach = F.max("row_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("new", F.when(reach >= F.col("row_start"), 0).otherwise(1))
    rows = rows.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = rows.groupBy(*keys, "col", "part").agg(F.min("row_start").alias("row_start"), F.max("row_end").alias("row_end"))
    return out.select(*keys, "col", "row_start", (F.col("row_end") - F.col("row_start")).alias("run_len"))


def count_items(turns: DataFrame, role: str) -> DataFrame:
    return turns.groupBy("conv_id").agg(F.count_if(F.col("role") == role).alias("n_items"))


def write_form(predictions: DataFrame, digits: int = 5) -> DataFrame:
    """Predictions as they are written: box and score rounded."""
    return predictions.withColumns({c: F.round(c, digits) for c in ("x", "y", "w", "h", "score")})

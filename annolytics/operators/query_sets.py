"""Curation of training samples. A sample is a datapoint: queries (datapoint_id, query_no, stage,
query_text, flags, input box), objects (datapoint_id, object_id, frame, box, area, iscrowd)
and targets (datapoint_id, query_no, object_id). A filter gives the queries or objects that
stay; `compact` then drops what nothing uses and numbers the rest anew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

QUERY, OBJECT = ["datapoint_id", "query_no"], ["datapoint_id", "object_id"]
GEOMETRIC = "geometric"


def _draw(seed: int, *keys: str) -> Column:
    """A number in [0, 1) that the seed and keys decide."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 40)) / float(1 << 40)


def drop_queries_by_text(queries: DataFrame, terms: Sequence[str]) -> DataFrame:
    return queries.filter(~F.coalesce(F.col("query_text").isin(list(terms)), F.lit(False)))


def cap_queries(queries: DataFrame, targets: DataFrame, n: int, keep_positive: bool, seed: int) -> DataFrame:
    """At most n queries of each datapoint, drawn by seed; with keep_positive those with
    targets first."""
    order = [F.xxhash64(F.lit(seed), *QUERY), "query_no"]
    rows = queries
    if keep_positive:
        positive = targets.select(*QUERY).distinct().withColumn("positive", F.lit(0))
        rows = queries.join(positive, QUERY, "left")
        order = [F.coalesce("positive", F.lit(1)), *order]
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("datapoint_id").orderBy(*order)))
    return rows.filter(F.col("rank") <= n).select(*queries.columns)


def cap_queries_video(queries: DataFrame, targets: DataFrame, n: int, keep_positive: bool, seed: int) -> DataFrame:
    """The cap drawn among the queries of stage 0; their positions stay in every stage. A
    datapoint with at most n queries in every stage is left as it is."""
    place = F.row_number().over(Window.partitionBy("datapoint_id", "stage").orderBy("query_no"))
    placed = queries.withColumn("place", place)
    large = placed.filter(F.col("place") > n).select("datapoint_id").distinct()
    first = cap_queries(placed.filter("stage = 0"), targets, n, keep_positive, seed).select("datapoint_id", "place")
    kept = placed.join(large, "datapoint_id", "left_semi").join(first, ["datapoint_id", "place"], "left_semi")
    return kept.select(*queries.columns).unionByName(queries.join(large, "datapoint_id", "left_anti"))


def semantic_queries_only(queries: DataFrame) -> DataFrame:
    return queries.filter("input_x is null")


def drop_zero_box_queries(queries: DataFrame, targets: DataFrame, objects: DataFrame) -> DataFrame:
    """Queries none of whose targets has a width or height of 0."""
    empty = objects.filter("w = 0 or h = 0").select(*OBJECT)
    return queries.join(targets.join(empty, OBJECT), QUERY, "left_anti")


def drop_crowded_queries(queries: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    crowded = targets.groupBy(*QUERY).agg(F.count("*").alias("n")).filter(F.col("n") > most)
    return queries.join(crowded, QUERY, "left_anti")


def drop_empty_objects(objects: DataFrame, least: float = 1e-6) -> DataFrame:
    return objects.filter(F.col("area") >= least)


def drop_non_exhaustive(queries: DataFrame, kind: str) -> DataFrame:
    """kind `instance`: only queries that are exhaustive; `pixel`: not those marked as not
    pixel-exhaustive, while a null flag stays."""
    if kind == "instance":
        return queries.filter("coalesce(is_exhaustive, 0) = 1")
    return queries.filter("coalesce(is_pixel_exhaustive, 1) = 1")


def drop_invalid_geometric(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Without queries of the text `geometric` that have a box and no target."""
    lone = queries.filter((F.col("query_text") == GEOMETRIC) & F.col("input_x").isNotNull()).join(targets, QUERY, "left_anti")
    return queries.join(lone.select(*QUERY), QUERY, "left_anti")


def drop_crowd_objects(objects: DataFrame) -> DataFrame:
    return objects.filter("iscrowd = 0")


def subsample_queries(queries: DataFrame, n: int, seed: int) -> DataFrame:
    """n positions drawn for each datapoint, the same in every stage; stages of different
    sizes are an error when the rows are read."""
    stage = Window.partitionBy("datapoint_id", "stage")
    rows = queries.withColumns({"place": F.row_number().over(stage.orderBy("query_no")), "size": F.count("*").over(stage)})
    whole = Window.partitionBy("datapoint_id")
    ok = F.assert_true(F.col("least") == F.col("most"), F.lit("stages have different numbers of queries"))
    rows = rows.withColumns({"least": F.min("size").over(whole), "most": F.max("size").over(whole)})
    rows = rows.withColumn("place", F.when(ok.isNull(), F.col("place")))
    drawn = rows.select("datapoint_id", "place").distinct()
    drawn = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("datapoint_id").orderBy(F.xxhash64(F.lit(seed), "datapoint_id", "place"), "place"))).filter(F.col("rank") <= n)
    return rows.join(drawn, ["datapoint_id", "place"], "left_semi").select(*queries.columns)


def compact(queries: DataFrame, targets: DataFrame, objects: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Queries, targets and objects of what is left: objects that a query uses, on frames that
    a query is in, numbered from 0 in their order (new_object_id), and stages numbered from
    0. A datapoint without a query of stage 0 is an error when the rows are read."""
    first = F.min("stage").over(Window.partitionBy("datapoint_id"))
    ok = F.assert_true(F.col("first") == 0, F.concat(F.lit("no first query in datapoint "), F.col("datapoint_id").cast("string")))
    rows = queries.withColumn("first", first).withColumn("checked", F.when(ok.isNull(), F.col("stage")))
    rows = rows.withColumn("stage", F.dense_rank().over(Window.partitionBy("datapoint_id").orderBy("checked")) - 1).select(*queries.columns)
    live = targets.join(queries.select(*QUERY), QUERY, "left_semi").join(objects.select(*OBJECT), OBJECT, "left_semi")
    used = objects.join(live.select(*OBJECT), OBJECT, "left_semi")
    used = used.withColumn("new_object_id", F.row_number().over(Window.partitionBy("datapoint_id").orderBy("object_id")) - 1)
    used = used.withColumn("frame", F.dense_rank().over(Window.partitionBy("datapoint_id").orderBy("frame")) - 1)
    live = live.join(used.select(*OBJECT, "new_object_id"), OBJECT)
    return rows, live, used


def prefix_suffix_text(queries: DataFrame, prefix: str = "", suffix: str = "", only: Sequence[str] | None = None) -> DataFrame:
    """Text put between prefix and suffix, but for `geometric`, and for texts that, trimmed and
    in lower case, are not among `only`, where that is given."""
    apply = F.col("query_text") != GEOMETRIC
    if only is not None:
        apply = apply & F.lower(F.trim("query_text")).isin(list(only))
    return queries.withColumn("query_text", F.when(apply, F.concat(F.lit(prefix), "query_text", F.lit(suffix))).otherwise(F.col("query_text")))


def text_to_visual(queries: DataFrame, targets: DataFrame, objects: DataFrame, p: float, keep_text: bool, seed: int) -> DataFrame:
    """With probability p a first-stage query with targets, not `geometric`, gets the box of
    one of them, drawn by seed, as its input box (input_x, input_y, input_w, input_h, label 1)
    and, unless its text is kept, the text `visual`."""
    order = Window.partitionBy(*QUERY).orderBy(F.xxhash64(F.lit(seed), *QUERY, "object_id"), "object_id")
    one = targets.withColumn("rank", F.row_number().over(order)).filter("rank = 1").join(objects, OBJECT)
    one = one.select(*QUERY, *(F.col(c).alias(f"box_{c}") for c in "xywh"))
    chosen = (F.col("stage") == 0) & (F.col("query_text") != GEOMETRIC) & F.col("box_x").isNotNull() & (_draw(seed, *QUERY) < p)
    rows = queries.join(one, QUERY, "left").withColumn("chosen", F.coalesce(chosen, F.lit(False)))
    given = {f"input_{c}": F.when(F.col("chosen"), F.col(f"box_{c}")).otherwise(F.col(f"input_{c}") if f"input_{c}" in queries.columns else F.lit(None)) for c in "xywh"}
    rows = rows.withColumns({**given, "input_label": F.when(F.col("chosen"), 1)})
    if not keep_text:
        rows = rows.withColumn("query_text", F.when(F.col("chosen"), F.lit("visual")).otherwise(F.col("query_text")))
    return rows.drop("chosen", *(f"box_{c}" for c in "xywh"))


def remove_input_boxes(queries: DataFrame) -> DataFrame:
    return queries.withColumns({c: F.lit(None).cast(queries.schema[c].dataType) for c in queries.columns if c.startswith("input_")})


def overwrite_text(queries: DataFrame, text: str, p: float, seed: int) -> DataFrame:
    return queries.withColumn("query_text", F.when(_draw(seed, *QUERY) < p, F.lit(text)).otherwise(F.col("query_text")))


def normal(seed: int, *keys: str | Column) -> Column:
    """A normal deviate that the seed and keys decide (Box and Muller)."""
    u, v = (F.pmod(F.xxhash64(F.lit(seed), F.lit(i), *keys), F.lit(1 << 40)) / float(1 << 40) for i in (1, 2))
    return F.sqrt(-2 * F.ln(1 - u)) * F.cos(6.283185307179586 * v)


def randomize_input_boxes(boxes: DataFrame, std: float, most: float, least_area: float, seed: int, *keys: str) -> DataFrame:
    """Corners x0, y0, x1, y1 moved by noise of std times the box's size, at most `most`, and
    kept within the image (width, height); a box whose area would not exceed least_area stays."""
    wide, high = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    moved = {}
    for c, side, end in (("x0", wide, "width"), ("y0", high, "height"), ("x1", wide, "width"), ("y1", high, "height")):
        noise = F.least(F.greatest(normal(seed, *keys, F.lit(c)) * std * side, F.lit(-most)), F.lit(most))
        moved[f"new_{c}"] = F.least(F.greatest(F.col(c) + noise, F.lit(0.0)), F.col(end))
    rows = boxes.withColumns(moved)
    fit = (F.col("new_x1") - F.col("new_x0")) * (F.col("new_y1") - F.col("new_y0")) > least_area
    fit = fit & (F.col("new_x1") > F.col("new_x0")) & (F.col("new_y1") > F.col("new_y0"))
    rows = rows.withColumn("fit", fit)
    return rows.withColumns({c: F.when(F.col("fit"), F.col(f"new_{c}")).otherwise(F.col(c)) for c in ("x0", "y0", "x1", "y1")}).select(*boxes.columns)


def datapoint_limits(queries: DataFrame, targets: DataFrame, datapoints: DataFrame, max_targets: int, max_queries: int) -> DataFrame:
    """Each datapoint with the reason to reject it, null if there is none: `no queries`, `too
    many queries`, or `too many targets` of one query."""
    n = queries.groupBy("datapoint_id").agg(F.count("*").alias("n_queries"))
    wide = targets.groupBy(*QUERY).agg(F.count("*").alias("n")).groupBy("datapoint_id").agg(F.max("n").alias("most"))
    rows = datapoints.select("datapoint_id").distinct().join(n, "datapoint_id", "left").join(wide, "datapoint_id", "left")
    reason = F.when(F.col("most") > max_targets, "too many targets").when(F.col("n_queries") > max_queries, "too many queries").when(F.col("n_queries").isNull(), "no queries")
    return rows.select("datapoint_id", reason.alias("reason"))

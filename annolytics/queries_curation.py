"""Queries over training samples: filters of queries and objects, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import query_sets as Q
from .views import register, view

_KEPT = "SELECT datapoint_id, query_no FROM dp_queries q"


def _queries(spark, d):
    return view(spark, d, "dp_queries")


def _targets(spark, d):
    return view(spark, d, "dp_targets")


def _objects(spark, d):
    return view(spark, d, "dp_objects")


def _ids(df):
    return df.select("datapoint_id", "query_no")


@register(f"{_KEPT} WHERE query_text NOT IN ('Dog ', 'thing 3')")
def drop_queries_by_text(spark, d):
    return _ids(Q.drop_queries_by_text(_queries(spark, d), ["Dog ", "thing 3"]))


@register("SELECT datapoint_id, least(count(*), 2) AS n_kept, CAST(least(count(*) FILTER (EXISTS (SELECT 1 FROM dp_targets t WHERE t.datapoint_id = q.datapoint_id AND t.query_no = q.query_no)), 2) AS BIGINT) AS n_positive FROM dp_queries q GROUP BY datapoint_id")
def cap_queries(spark, d):
    targets = _targets(spark, d)
    kept = Q.cap_queries(_queries(spark, d), targets, 2, True, 7)
    positive = targets.select(*Q.QUERY).distinct().withColumn("positive", F.lit(1))
    return kept.join(positive, Q.QUERY, "left").groupBy("datapoint_id").agg(F.count("*").alias("n_kept"), F.count("positive").alias("n_positive"))


@register("SELECT datapoint_id, stage, least(count(*), 1) AS n_kept FROM dp_queries GROUP BY datapoint_id, stage")
def cap_queries_video(spark, d):
    kept = Q.cap_queries_video(_queries(spark, d), _targets(spark, d), 1, True, 7)
    return kept.groupBy("datapoint_id", "stage").agg(F.count("*").alias("n_kept"))


@register(f"{_KEPT} WHERE input_x IS NULL")
def semantic_queries_only(spark, d):
    return _ids(Q.semantic_queries_only(_queries(spark, d)))


@register(f"{_KEPT} WHERE NOT EXISTS (SELECT 1 FROM dp_targets t JOIN dp_objects o USING (datapoint_id, object_id) WHERE t.datapoint_id = q.datapoint_id AND t.query_no = q.query_no AND (o.w = 0 OR o.h = 0))")
def drop_zero_box_queries(spark, d):
    return _ids(Q.drop_zero_box_queries(_queries(spark, d), _targets(spark, d), _objects(spark, d)))


@register(f"{_KEPT} WHERE (SELECT count(*) FROM dp_targets t WHERE t.datapoint_id = q.datapoint_id AND t.query_no = q.query_no) <= 1")
def drop_crowded_queries(spark, d):
    return _ids(Q.drop_crowded_queries(_queries(spark, d), _targets(spark, d), 1))


@register("SELECT datapoint_id, object_id FROM dp_objects WHERE area >= 1e-6")
def drop_empty_objects(spark, d):
    return Q.drop_empty_objects(_objects(spark, d)).select(*Q.OBJECT)


@register(f"{_KEPT} WHERE is_exhaustive = 1")
def drop_non_exhaustive_instance(spark, d):
    return _ids(Q.drop_non_exhaustive(_queries(spark, d), "instance"))


@register(f"{_KEPT} WHERE is_pixel_exhaustive IS NULL OR is_pixel_exhaustive = 1")
def drop_non_exhaustive_pixel(spark, d):
    return _ids(Q.drop_non_exhaustive(_queries(spark, d), "pixel"))


@register(f"{_KEPT} WHERE NOT (query_text = 'geometric' AND input_x IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dp_targets t WHERE t.datapoint_id = q.datapoint_id AND t.query_no = q.query_no))")
def drop_invalid_geometric(spark, d):
    return _ids(Q.drop_invalid_geometric(_queries(spark, d), _targets(spark, d)))


@register("SELECT datapoint_id, object_id FROM dp_objects WHERE iscrowd = 0")
def drop_crowd_objects(spark, d):
    return Q.drop_crowd_objects(_objects(spark, d)).select(*Q.OBJECT)


@register("SELECT datapoint_id, stage, least(count(*), 1) AS n_kept FROM dp_queries GROUP BY datapoint_id, stage")
def subsample_queries(spark, d):
    return Q.subsample_queries(_queries(spark, d), 1, 3).groupBy("datapoint_id", "stage").agg(F.count("*").alias("n_kept"))


_LIVE = """(SELECT t.* FROM dp_targets t JOIN dp_queries q USING (datapoint_id, query_no) JOIN dp_objects o USING (datapoint_id, object_id) WHERE o.iscrowd = 0 AND q.is_exhaustive = 1)"""


@register(f"""SELECT l.datapoint_id, l.query_no, l.object_id, n.new_object_id, n.frame FROM {_LIVE} l JOIN (
  SELECT datapoint_id, object_id, row_number() OVER (PARTITION BY datapoint_id ORDER BY object_id) - 1 AS new_object_id, dense_rank() OVER (PARTITION BY datapoint_id ORDER BY frame) - 1 AS frame
  FROM dp_objects o WHERE EXISTS (SELECT 1 FROM {_LIVE} v WHERE v.datapoint_id = o.datapoint_id AND v.object_id = o.object_id)) n USING (datapoint_id, object_id)""")
def compact_datapoint(spark, d):
    queries = Q.drop_non_exhaustive(_queries(spark, d), "instance")
    _, targets, objects = Q.compact(queries, _targets(spark, d), Q.drop_crowd_objects(_objects(spark, d)))
    return targets.join(objects.select(*Q.OBJECT, "frame"), Q.OBJECT).select("datapoint_id", "query_no", "object_id", "new_object_id", "frame")


@register("SELECT datapoint_id, query_no, CASE WHEN query_text <> 'geometric' AND lower(trim(query_text)) IN ('dog', 'thing 2') THEN concat('a ', query_text, '.') ELSE query_text END AS query_text FROM dp_queries")
def prefix_suffix_text(spark, d):
    return Q.prefix_suffix_text(_queries(spark, d), "a ", ".", ["dog", "thing 2"]).select("datapoint_id", "query_no", "query_text")


_FIRST = "SELECT datapoint_id, query_no, stage = 0 AND query_text <> 'geometric' AND EXISTS (SELECT 1 FROM dp_targets t JOIN dp_objects o USING (datapoint_id, object_id) WHERE t.datapoint_id = q.datapoint_id AND t.query_no = q.query_no) AS chosen FROM dp_queries q"


@register(_FIRST)
def text_to_visual(spark, d):
    out = Q.text_to_visual(_queries(spark, d), _targets(spark, d), _objects(spark, d), 1.0, False, 5)
    return out.select("datapoint_id", "query_no", (F.col("input_label").isNotNull() & (F.col("query_text") == "visual") & F.col("input_x").isNotNull()).alias("chosen"))


@register("SELECT datapoint_id, query_no, CAST(NULL AS DOUBLE) AS input_x, 'thing' AS query_text FROM dp_queries")
def remove_input_boxes(spark, d):
    return Q.overwrite_text(Q.remove_input_boxes(_queries(spark, d)), "thing", 1.0, 1).select("datapoint_id", "query_no", "input_x", "query_text")


@register("SELECT ann_id, w * h > 900 AS may_move, TRUE AS inside FROM gt_boxes")
def randomize_input_boxes(spark, d):
    """Boxes of an area that the noise cannot bring below 0 move by 3 at most and stay inside."""
    b = view(spark, d, "gt_boxes").select("ann_id", "x", "y", F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + F.col("w")).alias("x1"), (F.col("y") + F.col("h")).alias("y1"), "w", "h", F.lit(1000.0).alias("width"), F.lit(1000.0).alias("height"))
    out = Q.randomize_input_boxes(b, 0.1, 3.0, 10.0, 4, "ann_id")
    near = (F.abs(F.col("x0") - F.col("x")) <= 3) & (F.abs(F.col("x1") - F.col("x") - F.col("w")) <= 3) & (F.col("y0") >= 0) & (F.col("y1") <= 1000)
    return out.select("ann_id", (F.col("w") * F.col("h") > 900).alias("may_move"), near.alias("inside"))


@register("""SELECT image_id AS datapoint_id, CASE WHEN most > 2 THEN 'too many targets' WHEN n_queries > 3 THEN 'too many queries' WHEN n_queries IS NULL THEN 'no queries' END AS reason
  FROM (SELECT DISTINCT image_id FROM np) LEFT JOIN (SELECT datapoint_id AS image_id, count(*) AS n_queries FROM dp_queries WHERE is_exhaustive = 1 AND datapoint_id % 4 <> query_no GROUP BY 1) USING (image_id)
  LEFT JOIN (SELECT datapoint_id AS image_id, max(n) AS most FROM (SELECT datapoint_id, query_no, count(*) AS n FROM dp_targets GROUP BY ALL) GROUP BY ALL) USING (image_id)""")
def datapoint_limits(spark, d):
    queries = _queries(spark, d).filter("is_exhaustive = 1 and datapoint_id % 4 <> query_no")
    points = view(spark, d, "np").select(F.col("image_id").alias("datapoint_id"))
    return Q.datapoint_limits(queries, _targets(spark, d), points, 2, 3)


@register("""SELECT datapoint_id, most_common, kinds FROM (SELECT datapoint_id, count(*) AS kinds, arg_max(n, times * 1000 + n) AS most_common FROM (
  SELECT datapoint_id, n, count(*) AS times FROM (SELECT datapoint_id, stage, count(*) AS n FROM dp_queries WHERE datapoint_id % 5 <> query_no GROUP BY ALL) GROUP BY ALL) GROUP BY datapoint_id) WHERE kinds > 1""")
def stage_consistency(spark, d):
    from .operators.reshape import stage_consistency as check

    return check(_queries(spark, d).filter("datapoint_id % 5 <> query_no").withColumnRenamed("stage", "query_processing_order"))

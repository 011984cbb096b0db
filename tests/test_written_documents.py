"""Written documents grow in number, not in size, and hold everything once."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from annolytics import queries_reshape as Q
from annolytics.functions.boxes import inside_rotated
from annolytics.views import view


def test_documents_are_of_bounded_size(spark, sf_dir, tmp_path):
    Q._documents(spark, sf_dir, str(tmp_path / "d"), size=20)
    docs = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "d")).collect()]
    assert len(docs) > 10 and max(len(x["images"]) for x in docs) <= 20
    assert sum(len(x.get("annotations", [])) for x in docs) == view(spark, sf_dir, "gt_boxes").count()
    assert sum(len(x["categories"]) for x in docs) == 40


def test_video_documents_are_of_bounded_size(spark, sf_dir, tmp_path):
    Q._video_documents(spark, sf_dir, str(tmp_path / "d"), size=20)
    docs = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "d")).collect()]
    assert len(docs) > 10 and max(len(x["videos"]) for x in docs) <= 20
    assert sum(len(x["annotations"]) for x in docs) == view(spark, sf_dir, "gt_tracks").select("track_id").distinct().count()


def test_ties_of_rotated_boxes_are_exact(spark):
    # half widths of 0.6 w + 0.8 h: every left edge is -2, every right edge 642
    rows = spark.range(20, 71).select(F.col("id").cast("double").alias("w"), F.col("id").alias("n")).crossJoin(spark.range(20, 51).select(F.col("id").cast("double").alias("h")))
    half = (6 * F.col("w") + 8 * F.col("h")) / 20
    angle = F.degrees(F.acos(F.lit(0.6)))
    left = inside_rotated((half - 2, F.lit(200.0), F.col("w"), F.col("h"), angle), F.lit(640), F.lit(480), 2)
    right = inside_rotated((642 - half, F.lit(200.0), F.col("w"), F.col("h"), angle), F.lit(640), F.lit(480), 2)
    assert rows.select(left.alias("l"), right.alias("r")).distinct().collect() == [(True, False)]

"""Queries take their whole tables, and give all that their plan works out."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as entry
from annolytics.views import view


def test_cleanup_takes_odd_videos_too(spark, sf_dir):
    out = entry.queries()["non_exhaustive_cleanup"](spark, sf_dir)
    # category 1 is declared negative, so that all its predictions stay
    want = view(spark, sf_dir, "dt_tracks").filter("category_id = 1").select("video_id", "frame_idx", "track_id")
    assert want.filter("video_id % 2 = 1").count() > 0
    assert want.exceptAll(out).isEmpty()


def test_hota_gives_sequences_too(spark, sf_dir):
    out = entry.queries()["evaluate_hota"](spark, sf_dir)
    levels = {r.level: r.n for r in out.groupBy("level").agg(F.countDistinct("name").alias("n")).collect()}
    tracks = view(spark, sf_dir, "gt_tracks").select("video_id", "category_id").unionByName(view(spark, sf_dir, "dt_tracks").select("video_id", "category_id"))
    assert levels == {"sequence": tracks.distinct().count(), "class": 4, "class_average": 1, "detection_average": 1}

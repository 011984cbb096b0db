"""The derived tables are dealt by their number of rows, not by bytes."""

from __future__ import annotations

from annolytics import views


def test_tasks_of_a_view_follow_the_rows(spark, sf_dir, monkeypatch):
    few = views.view(spark, sf_dir, "gt_track_runs").groupBy("video_id").count()
    monkeypatch.setattr(views, "PART_ROWS", 100)
    many = views.view(spark, sf_dir, "gt_track_runs").groupBy("video_id").count()
    n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert many.rdd.getNumPartitions() == n // 100 > few.rdd.getNumPartitions()
    assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()

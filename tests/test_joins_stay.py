"""Frames, columns and pairs of a video are joined where its rows lie, not dealt anew for each join."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from annolytics.operators.masks import mask_components
from annolytics.operators.ordered import suppressed

#: Shuffles of the expanded rows that remain: the dealing of the rows by video, and what leaves Python.
MOST = {"track_box_iou": 0, "mask_frame_pairs": 0, "mask_similarity": 0, "nms_tracks": 2}


@pytest.mark.parametrize("name", sorted(MOST))
def test_joins_shuffle_no_expanded_rows(spark, sf_dir, name, capsys):
    entry.queries()[name](spark, sf_dir).explain()
    plan = capsys.readouterr().out.split("== Initial Plan ==")[0]
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len([keys for keys in dealt if not keys.startswith("l_orderkey")]) <= MOST[name]


def test_corpus_queries_deal_by_all_keys(spark, sf_dir):
    entry.queries()["track_box_iou"](spark, sf_dir)
    entry.queries()["op3_sharding"](spark, sf_dir)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_pass_follows_its_order_in_every_group(spark):
    rows = spark.range(4000).select((F.col("id") % 7).alias("g"), F.col("id").alias("a"), (F.col("id") + 7).alias("b"), (-F.col("id")).alias("s"))
    gone = {tuple(r) for r in suppressed(rows.repartition(3), ["g"], "a", "b", [F.desc("s"), "a", "b"]).collect()}
    # along a chain every second item goes
    assert gone == {(i % 7, i + 7) for i in range(4000) if (i // 7) % 2 == 0}


def test_component_sizes_count_what_runs_stand_for(spark):
    runs = spark.createDataFrame([(1, 1, 0, 0, 2, 5, 9), (1, 1, 1, 2, 3, 0, 9), (1, 1, 5, 0, 1, 1, 9)], "image_id long, ann_id long, col long, row_start long, run_len long, beyond long, area long")
    out = {(r.col, r.component, r["size"], r.area) for r in mask_components(runs, "beyond", ("area",)).collect()}
    assert out == {(0, 1, 10, 9), (1, 1, 10, 9), (5, 2, 2, 9)}

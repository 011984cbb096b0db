"""Every query with SQL gives what the SQL gives; the matching operators what a plain search gives."""

from __future__ import annotations

import glob
import itertools
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from annolytics import queries as Q
from annolytics.operators import tables as T
from annolytics.operators.ordered import assign
from annolytics.plans.concept_f1 import concept_f1, image_eval, summarize


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    base = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        base.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = base.execute(Q.oracle_sql()[name])
    names = [c[0] for c in want.description]
    got = Q.queries()[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_assignment_is_the_best():
    rng = np.random.default_rng(4)
    for n, m in [(1, 1), (2, 2), (2, 5), (5, 2), (4, 4), (6, 5)] * 5:
        score = rng.choice([0.0, 0.1, 0.5, 0.8, 0.9], (n, m)) + rng.random((n, m)) * (n % 2)
        small, large = min(n, m), max(n, m)
        table = score if n <= m else score.T
        best = max(sum(table[i, p[i]] for i in range(small)) for p in itertools.permutations(range(large), small))
        got = assign(score)
        assert len(got) == small == len({i for i, _ in got}) == len({j for _, j in got})
        assert sum(score[i, j] for i, j in got) == pytest.approx(best)


def test_concept_f1(spark, sf_dir):
    rows = {r.threshold: r for r in Q.queries()["evaluate_cgf1"](spark, sf_dir).collect()}
    assert len(rows) == 10 and rows[0.5].tp >= rows[0.95].tp
    assert 0 <= rows[0.5].micro_f1 <= 1 and -1 <= rows[0.5].il_mcc <= 1


def test_concept_f1_has_all_outputs(spark):
    boxes = [(1, 1, 0, 0.9, 0.0, 0.0, 10.0, 10.0), (2, 2, 0, 0.9, 0.0, 0.0, 10.0, 10.0), (2, 3, 0, 0.9, 50.0, 0.0, 10.0, 10.0)]
    gt = spark.createDataFrame(boxes, "image_id long, ann_id long, iscrowd int, score double, x double, y double, w double, h double")
    dt = gt.filter("ann_id <> 3").withColumn("image_id", F.when(F.col("ann_id") == 1, 3).otherwise(2)).withColumnRenamed("ann_id", "det_id")
    images = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "image_id long")  # missed, half found, false, empty
    per_image = {r.image_id: r for r in image_eval(images, gt, dt).filter("threshold = 0.5").collect()}
    assert [per_image[i].recall and round(per_image[i].recall, 3) for i in (1, 2, 3, 4)] == [0.0, 0.5, 0.0, None]
    assert [per_image[2].il_tp, per_image[3].il_fp, per_image[1].il_fn, per_image[4].il_tn] == [True] * 4
    row = summarize(concept_f1(image_eval(images, gt, dt))).first()
    assert len(row) == 26 and row.precision_50 == pytest.approx(1 / 2, abs=1e-3) and row.recall == pytest.approx(1 / 3, abs=1e-3)
    assert row.positive_micro_precision_75 == pytest.approx(1, abs=1e-3)
    assert [row.il_precision, row.il_recall, row.il_f1, row.il_fpr] == pytest.approx([0.5] * 4, abs=1e-3)


def test_mean_target_iou_counts_missed_targets(spark):
    gt = spark.createDataFrame([(1, 1, 5.0, 5.0), (1, 2, 5.0, 5.0), (1, 3, 0.0, 5.0), (2, 4, 5.0, 5.0)], "image_id long, ann_id long, w double, h double")
    images = spark.createDataFrame([(1,), (2,), (3,)], "image_id long")
    matched = spark.createDataFrame([(1, 1, 0.8)], "image_id long, ann_id long, iou double")
    assert sorted(map(tuple, T.mean_target_iou(images, gt, matched).collect())) == [(1, 2, 0.4), (2, 1, 0.0), (3, 0, 1.0)]



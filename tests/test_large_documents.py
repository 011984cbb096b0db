"""Documents read by byte ranges give the rows that the whole-document reader gives; equal scores
spread over cells give the same curve."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from annolytics.plans import average_precision as A
from annolytics.sources import documents as D
from annolytics.sources.large import fragments


def coco(seed: int, n: int) -> dict:
    rnd = random.Random(seed)
    words = ["plain", 'a "quoted" one', "a } brace", "back\\slash", '\\"}', "{[", "né", "], \"annotations\": [", ""]
    images = [{"id": i, "file_name": rnd.choice(words), "width": 640, "height": 480, "text_input": rnd.choice([*words, None]), "queried_category": str(i % 3)} for i in range(n)]
    annotations = [{"id": i, "image_id": rnd.randrange(max(n, 1)), "category_id": i % 3, "bbox": [1.5, 2.0, i, 4.0], "area": 8.0, "iscrowd": 0, "source": rnd.choice(words), "segmentation": {"size": [480, 640], "counts": [1, 2, i]}} for i in range(2 * n)]
    return {"info": {"year": 2024, "by": {"name": "x } y"}}, "images": images, "licenses": [], "annotations": annotations, "categories": [{"id": i, "name": rnd.choice(words)} for i in range(3)]}


@pytest.mark.parametrize("indent", [None, 1])
def test_ranges_give_the_rows_of_the_document(spark, tmp_path, indent):
    for i, n in enumerate((40, 0, 3)):
        (tmp_path / f"d{i}.json").write_text(json.dumps(coco(i, n), indent=indent, ensure_ascii=i == 0))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        parts = fragments(spark, str(tmp_path)).groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0]
        got = [sorted(map(str, df.select(*sorted(df.columns)).collect())) for df in D.read_coco(spark, str(tmp_path), large=True)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = [sorted(map(str, df.select(*sorted(df.columns)).collect())) for df in D.read_coco(spark, str(tmp_path))]
    assert parts > 5 and got == want and [len(x) for x in want] == [43, 86, 9]


def test_equal_scores_spread(spark):
    rnd = random.Random(3)
    rows = [(c, i, 100 * i + k, rnd.choice([1.0, 1.0, 1.0, 0.99995, 0.3]), rnd.random() < 0.5) for c in range(2) for i in range(40) for k in range(3)]
    table = spark.createDataFrame([(*r, not r[4]) for r in rows], "category_id int, image_id long, det_id long, score double, is_tp boolean, is_fp boolean")
    want = []
    for c in range(2):
        tp = fp = 0
        for r in sorted((r for r in rows if r[0] == c), key=lambda r: (-r[3], r[1], r[2])):
            tp, fp = tp + r[4], fp + (not r[4])
            want.append((c, r[2], tp, fp))
    for most in (0, 10, 100_000):
        got = A.precision_recall(table, ["category_id"], ["image_id", "det_id"], most)
        assert sorted(map(tuple, got.select("category_id", "det_id", "tp", "fp").collect())) == sorted(want)
    assert set(got.columns) == {*table.columns, "tp", "fp"}

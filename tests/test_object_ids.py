"""Object ids by windows equal those that a loop over frames gives."""

from __future__ import annotations

import random

import pandas as pd
import pytest

from annolytics.streaming.tables import _assign, assign_object_ids


@pytest.mark.parametrize("most", [0, 1, 3, 5])
def test_ids_equal_the_loop_and_need_no_python(spark, most, capsys):
    rng = random.Random(3)
    rows = [(v, rng.randrange(4), i, rng.choice([0.1, 0.5, 0.9])) for i, v in enumerate(rng.choices(range(9), k=90))]
    table = pd.DataFrame(rows, columns=["video_id", "frame_idx", "det_id", "score"])
    want = sorted((int(v), *r) for v, part in table.groupby("video_id") for r in _assign(0, 0, most, part)[2])
    out = assign_object_ids(spark.createDataFrame(rows, "video_id long, frame_idx long, det_id long, score double"), most)
    assert sorted(map(tuple, out.collect())) == want
    out.explain()
    assert "Pandas" not in capsys.readouterr().out

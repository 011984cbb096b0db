"""The life of tracks over whole batches of videos is that of step, frame by frame."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from annolytics.streaming import lifecycle as L

KINDS = pa.schema([("video_id", pa.int64()), ("frame_idx", pa.int64()), ("object_id", pa.int64()), ("matched", pa.bool_()), ("is_empty", pa.bool_()), ("overlaps", pa.list_(pa.int64())), ("is_last", pa.bool_())])
RULES = [L.Rules(), L.Rules(6, 2, 3, 1, 2, -1, False, 2, 2), L.Rules(4, 1, 2, 2, 3, -1, True, 3, 0, True), L.Rules(3, 2, 1, 1, 2, 0, True, 0, 1)]


def videos(seed: int) -> list[list[tuple]]:
    rng = np.random.default_rng(seed)
    out = []
    for video in range(40):
        frames = sorted({int(f) for f in rng.integers(0, 14, 10)})
        rows = [(video, f, None, False, False, None, bool(f == frames[-1] and video % 4) or f == 5 and video % 7 == 0) for f in frames]
        for f in frames:
            for i in sorted(rng.choice(6, rng.integers(0, 6), replace=video % 5 == 0)):
                rows.append((video, f, int(i), bool(rng.random() < 0.6), bool(rng.random() < 0.2), [int(x) for x in rng.integers(0, 3, rng.integers(0, 3))] or None, False))
        out.append(rows)
    return out


@pytest.mark.parametrize("rules", RULES)
def test_batches_live_as_single_videos(rules):
    all_rows, want = [], []
    for rows in videos(5):
        rows = sorted(rows, key=lambda r: (r[1] if not rules.reverse else -r[1], -1 if r[2] is None else r[2], r[3], r[4], r[5] or []))
        all_rows += rows
        want.append(L._work(L.fresh(), rules, rows[0][0], pd.DataFrame(rows, columns=KINDS.names)))
    batch = pa.RecordBatch.from_pylist([dict(zip(KINDS.names, r, strict=True)) for r in all_rows], schema=KINDS)
    got = L._life_of_batch(batch, rules).to_pylist()
    rows = [tuple(r) for df in want for r in df.itertuples(index=False)]
    assert len(rows) > 80 and sorted(tuple(r.values()) for r in got) == sorted(rows)


def test_a_batch_without_objects():
    batch = pa.RecordBatch.from_pylist([dict(zip(KINDS.names, (1, f, None, None, None, None, f == 2), strict=True)) for f in range(3)], schema=KINDS)
    assert L._life_of_batch(batch, RULES[0]).num_rows == 0

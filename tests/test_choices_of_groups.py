"""Choices of a group of keys are those that each key would make for itself."""

from __future__ import annotations

import numpy as np
import pandas as pd

from annolytics.streaming.tables import _choose


def test_groups_choose_as_single_keys():
    rng, idle = np.random.default_rng(8), 50
    held, alone = np.empty((0, 4), np.int64), {}
    expired = 0
    for n in range(30):
        watermark = n * 20
        part = pd.DataFrame(rng.integers(0, 6, (12, 3)), columns=["video_id", "category_id", "shard"]).astype({"category_id": float})
        part.loc[part["category_id"] == 5, "category_id"] = np.nan
        times = watermark + rng.integers(0, 60, 12)
        held, kept = _choose(held, part, times, idle, watermark)
        want = np.zeros(12, bool)
        keys = list(zip(part["video_id"], part["category_id"].fillna(-1), strict=True))
        for key in set(keys):
            own = np.array([k == key for k in keys])
            shard = alone[key][0] if key in alone else part["shard"][own].min()
            alone[key] = (shard, max(times[own].max() + idle, watermark + 1))
            want |= own & (part["shard"] == shard).to_numpy()
        gone = {k for k, (_, until) in alone.items() if until < watermark and k not in set(keys)}
        expired += len(gone)
        alone = {k: v for k, v in alone.items() if k not in gone}
        assert (kept == want).all() and len(held) == len(alone)
    assert expired > 0

"""Reference frames against a plain version, and without a join of targets with references."""

from __future__ import annotations

import random

import pytest

from annolytics.operators.curation import nearest_frames


def plain(at, refs, k, keep_first):
    before, after = [r for r in refs if r < at], [r for r in refs if r >= at]
    first = ([before[0]] if before else after[-1:]) if keep_first else []
    nearest = sorted([*before[-1:], *after[:1]], key=lambda r: (abs(at - r), r))
    out = []
    for r in [*first, *nearest, *sorted(refs, key=lambda r: (abs(at - r), r))]:
        if r not in out:
            out.append(r)
    return out[:k]


@pytest.mark.parametrize("k", (2, 3, 5))
@pytest.mark.parametrize("keep_first", (False, True))
def test_nearest_frames(spark, capsys, k, keep_first):
    rnd = random.Random(k)
    targets = {(v, rnd.randrange(30)) for v in range(12) for _ in range(v)}
    refs = {(v, rnd.randrange(30)) for v in range(11) for _ in range(rnd.randrange(12))}
    tables = [spark.createDataFrame([*rows, *rows], "video_id long, frame_idx int") for rows in (targets, refs)]
    out = nearest_frames(*tables, k, keep_first)
    want = {(v, at, r, i + 1) for v, at in targets for i, r in enumerate(plain(at, sorted(r for w, r in refs if w == v), k, keep_first))}
    assert sorted(map(tuple, out.collect())) == sorted(want)
    out.explain()
    assert "Join" not in capsys.readouterr().out

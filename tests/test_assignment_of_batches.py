"""All groups of a batch are assigned at once, with the pairs that each group gives by itself."""

from __future__ import annotations

import numpy as np

from annolytics.operators.ordered import assign, assign_few, best_pairs


def test_loops_and_arrays_assign_alike():
    rng = np.random.default_rng(4)
    for i in range(300):
        score = rng.integers(0, 4, rng.integers(1, 7, 2)) / 3.0 if i % 2 else rng.random(rng.integers(1, 7, 2))
        assert assign_few(score.tolist()) == assign(score)


def test_groups_of_a_batch_stay_apart():
    rng = np.random.default_rng(6)
    rows = sorted({(int(g), int(a), int(b)) for g, a, b in zip(rng.integers(0, 40, 300), rng.integers(0, 5, 300), rng.integers(0, 6, 300), strict=True)})
    group, left, right = np.array(rows).T
    score = rng.random(len(rows)) + 0.01
    got = best_pairs(group, left, right, score)
    for g in range(40):
        here = np.flatnonzero(group == g)
        table = np.zeros((5, 6))
        table[left[here], right[here]] = score[here]
        assert {(int(left[i]), int(right[i])) for i in got if group[i] == g} == {p for p in assign(table) if table[p] > 0}

"""Connected parts are found for a whole batch at once, not run by run."""

from __future__ import annotations

import numpy as np

from annolytics.operators.ordered import parts


def test_parts_are_named_by_their_least_node():
    rng = np.random.default_rng(3)
    for n in (1, 2, 30, 400):
        a, b = rng.integers(0, n, n // 2), rng.integers(0, n, n // 2)
        want = np.arange(n)
        for _ in range(n):
            for x, y in zip(a, b, strict=True):
                want[[x, y]] = min(want[x], want[y])
        assert (parts(a, b, n) == want).all()
    chain = np.arange(100_000)
    assert not parts(chain[:-1], chain[1:], len(chain)).any()

"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def components(ids: list, links: list[tuple[int, int]]) -> list:
    """Smallest id reachable from each place."""
    parent = list(range(len(ids)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in links:
        parent[top(i)] = top(j)
    low: dict[int, object] = {}
    for i, x in enumerate(ids):
        if x is not None and (low.get(top(i)) is None or x < low[top(i)]):
            low[top(i)] = x
    return [low.get(top(i)) for i in range(len(ids))]


def shingles(text: str | None) -> frozenset:
    words = [w.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))) for w in WORD.findall((text or "").encode())]
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def ngram_rows(docs: list[tuple]) -> list[tuple]:
    sets = [shingles(t) for _, t in docs]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    low = components([d for d, _ in docs], links)
    return sorted(((d, len(s), c) for (d, _), s, c in zip(docs, sets, low, strict=True)), key=str)


def suffix_rows(docs: list[tuple], length: int = 400) -> list[tuple]:
    data = [(t or "").encode() for _, t in docs]
    count = Counter(x[i : i + length] for x in data for i in range(len(x) - length + 1))
    rows = []
    for (d, _), x in zip(docs, data, strict=True):
        gone = np.zeros(len(x) + 1, bool)
        for i in range(len(x) - length + 1):
            if count[x[i : i + length]] > 1:
                gone[i : i + length] = True
        rest = bytes(b for b, g in zip(x, gone, strict=False) if not g)
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
        rows.append((d, len(x), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(rows, key=str)


def embedding_rows(vectors: list[tuple]) -> list[tuple]:
    def usable(v, label) -> bool:
        return label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    groups = defaultdict(list)
    for i, (_, v, label) in enumerate(vectors):
        if usable(v, label):
            groups[label, len(v)].append(i)
    links, degree = [], Counter()
    for at in groups.values():
        m = np.array([vectors[i][1] for i in at], float)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(m @ m.T >= 0.93), strict=True):
            if a != b:
                links.append((at[a], at[b]))
                degree[at[a]] += 1
    low = components([v[0] for v in vectors], links)
    return sorted(((v[0], degree[i], low[i], v[0] is not None and v[0] == low[i]) for i, v in enumerate(vectors)), key=str)

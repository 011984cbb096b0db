"""Vectorised text primitives shared by the corpus operators.

Everything here works on the UTF-8 bytes of many texts laid end to end, as Arrow
hands them to a task, so that no Python object is made per word or per byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: White space that separates words: space and the bytes 9 to 13.
SPACES = bytes([32, 9, 10, 11, 12, 13])
#: Texts are handled in runs of about so many bytes; one longer text is a run of its own.
RUN_BYTES = 2_000_000

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACES)] = False
_RNG = np.random.default_rng(20240607)
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) | np.uint64(1)
for _upper in range(65, 91):  # A-Z count as a-z
    _BYTE_VALUE[_upper] = _BYTE_VALUE[_upper + 32]
_BYTE_VALUE[~_IS_WORD] = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE_MULTIPLIERS = _RNG.integers(1, 2**63, 64, dtype=np.int64).astype(np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def byte_runs(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of a string column: first row, last row + 1, their bytes, and
    the offset of each text in these bytes. A null text has no bytes."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + RUN_BYTES, "right")) - 1)
        last = min(last, len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each word, its hash with A-Z lower-cased, and the index of each
    text's first word (one more entry than texts)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = _IS_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return starts, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    powers = np.full(int(lengths.max()), _STEP, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    hashes = np.add.reduceat(_BYTE_VALUE[data[starts[0] :]] * powers[place], starts - starts[0])
    return starts, mix(hashes), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of `width` words of each text; a text
    of fewer words has its whole sequence as the only one, one without words none."""
    _, hashes, first = words(data, offsets)
    n = len(hashes)
    joined = np.zeros(n, np.uint64)
    for i in range(width):
        joined[: n - i] += hashes[i:] * _SHINGLE_MULTIPLIERS[i] if i < n else 0
    joined = mix(joined)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            sets.append(np.unique(joined[a : b - width + 1]))
        elif b > a:
            whole = (hashes[a:b] * _SHINGLE_MULTIPLIERS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(mix(np.array([whole], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets

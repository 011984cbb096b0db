"""Pack token sequences into sequences of a fixed length, by bounded-space online
best-fit: a fixed number of open bins, found through a bitset keyed by free space; the
fullest closes first.

Documents longer than a sequence are cut into whole sequences and a rest. The pieces
are dealt by hash to groups of about GROUP_ROWS, each packed by one pass of a task that
holds the open bins alone.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import settle, small_batches

LENGTH, END_ID = 2048, 0
OPEN_BINS = 512
GROUP_ROWS = 40_000
VOCABULARY = "word_bpe_49k.json"
#: Characters of text that are coded together, unless a single text is longer.
RUN_CHARS = 2_000_000
#: Words that a worker remembers; beyond them it starts anew.
KNOWN_WORDS = 1_000_000
#: Marks that, at either end of a word, are a token of their own beside its letters.
MARKS = ".,;:!?()[]{}\"-_*&$#%@/+=~"

_PIECE = "doc_id long, doc_key long, piece int, start long, length long, ids_crc32 long"


def laid_out(flat: np.ndarray, first: np.ndarray, size: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices `of` of flat end to end, and where each begins (and the last ends)."""
    upto = np.cumsum(np.append(0, size[of]))
    return flat[np.repeat(first[of] - upto[:-1], size[of]) + np.arange(upto[-1])], upto


class WordCoder:
    """Ids of texts, word by word: the vocabulary's rules never reach across white space, so
    each distinct word is coded once, and texts are put together from the words' ids. A
    word of Latin letters is kept in lower case and apart from the marks around it, as the
    rules would have it; others are coded as they stand."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.parts: dict[str, int] = {"": 0}
        self.of_word = np.zeros((0, 3), np.int64)
        self.flat, self.first, self.size = np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _split(self, word: str) -> tuple[str, str, str]:
        if max(word) <= "ÿ":
            low = word.lower()
            tail = low.rstrip(MARKS)
            stem = tail.lstrip(MARKS)
            if stem.isalpha():
                return low[: len(tail) - len(stem)], stem, low[len(tail) :]
        return "", word, ""

    def _learn(self, new: list[str]) -> None:
        split = [self._split(w) if w else ("", "", "") for w in new]
        parts = list(dict.fromkeys(p for s in split for p in s if p not in self.parts))
        coded = [np.array(c.ids, "<u4") for c in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        sizes = np.array([len(c) for c in coded], np.int64)
        self.first = np.append(self.first, len(self.flat) + np.cumsum(sizes) - sizes)
        self.size = np.append(self.size, sizes)
        self.flat = np.concatenate([self.flat, *coded])
        self.parts.update(zip(parts, range(len(self.parts), len(self.parts) + len(parts)), strict=True))
        self.of_word = np.concatenate([self.of_word, np.array([[self.parts[p] for p in s] for s in split], np.int64).reshape(-1, 3)])
        self.words.update(zip(new, range(len(self.words), len(self.words) + len(new)), strict=True))

    def code(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, each text closed by END_ID, and where each text begins."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.words) > KNOWN_WORDS:
            self._forget()
        new = [w for w in distinct if w not in self.words]
        if new:
            self._learn(new)
        parts = self.of_word[np.fromiter(map(self.words.__getitem__, distinct), np.int64, len(distinct))].ravel()
        flat, upto = laid_out(self.flat, self.first, self.size, parts)
        begin = upto[::3]
        flat, upto = laid_out(flat, begin[:-1], np.diff(begin), coded.indices.to_numpy())
        ends = upto[np.cumsum(pc.list_value_length(split).to_numpy())]
        return np.insert(flat, ends, np.uint32(END_ID)).astype("<u4"), np.append(0, ends + np.arange(1, len(ends) + 1))


@cache
def word_coder(vocabulary: str) -> WordCoder:
    """One for each worker process, whose tasks share what it has learnt."""
    return WordCoder(vocabulary)


def cut_into_pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, length: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """doc_id, doc_key, text -> pieces, with their ids as little-endian bytes if wanted."""
    coder = word_coder(vocabulary)
    names = [x.split()[0] for x in _PIECE.split(", ")] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
    for batch in batches:
        ids, keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.large_string())
        upto, at = np.cumsum(pc.utf8_length(texts).to_numpy()), 0
        while at < len(texts):
            before = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, before + RUN_CHARS, "right")))
            tokens, begins = coder.code(texts[at:end])
            rows = []
            for i, a, b in zip(range(at, end), begins[:-1].tolist(), begins[1:].tolist(), strict=True):
                for piece, start in enumerate(range(a, b, length)):
                    part = tokens[start : min(start + length, b)].tobytes()
                    rows.append((ids[i], keys[i], piece, start - a, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
            at = end


class OpenBins:
    """Open bins by free space. `free` has bit f set while some open bin has f places free."""

    def __init__(self, length: int, most: int):
        self.length, self.most, self.n, self.made, self.free = length, most, 0, 0, 0
        self.bins: dict[int, list[int]] = defaultdict(list)

    def _take(self, space: int) -> int:
        bins = self.bins[space]
        number = bins.pop()
        if not bins:
            self.free ^= 1 << space
        self.n -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """Number of the bin for an item, and where in it the item goes."""
        fits = self.free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.n == self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            space, number = self.length, self.made
            self.made += 1
        left = space - size
        if left:
            self.bins[left].append(number)
            self.free |= 1 << left
            self.n += 1
        return number, self.length - space


def pack_groups(batches: Iterator[pa.RecordBatch], length: int, open_bins: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, whose first columns are group and length -> also sequence_id, offset."""
    group, bins = None, OpenBins(length, open_bins)
    for batch in batches:
        placed = []
        for g, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if g != group:
                group, bins = g, OpenBins(length, open_bins)
            number, offset = bins.place(size)
            placed.append(((g << 32) + number, offset))
        out = np.array(placed, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out[:, 0]), pa.array(out[:, 1])], names=[*batch.schema.names, "sequence_id", "offset"])


def pack_documents(docs: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, vocabulary: str | None = None, with_ids: bool = False, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Sequences of at most `length` tokens that hold every document whole, or, if it is
    longer, in pieces of `length` and a rest.

    docs: doc_id long, text string; other columns are left out. One row per piece:
    doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with_ids the ids
    (unsigned, 32 bits, little-endian). A null text is empty, and an empty one is its end
    token alone; a repeated row is a document of its own; an empty table gives an empty
    result. The same input gives the same result.
    """
    small_batches(docs.sparkSession)
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", text).alias("doc_key"), text.alias("text"))
    pieces = settle(docs.mapInArrow(lambda it: cut_into_pieces(it, vocabulary, length, with_ids), _PIECE + (", ids binary" if with_ids else "")))
    n = pieces.count()
    # an even deal; a group, even a lone one, is a pass over its sizes alone
    groups = max(1, -(-n // group_rows))
    rows = pieces.select(F.pmod(F.xxhash64("doc_key", "piece"), F.lit(groups)).alias("group"), F.col("length").alias("size"), *pieces.columns)
    order = ["group", F.pmod(F.xxhash64("doc_key", F.lit(1)), F.lit(1 << 20)), "doc_id", "doc_key", "piece"]
    rows = rows.repartition("group").sortWithinPartitions(*order)
    schema = f"group long, size long, {_PIECE}{', ids binary' if with_ids else ''}, sequence_id long, offset long"
    return rows.mapInArrow(lambda it: pack_groups(it, length, open_bins), schema).drop("group", "size", "doc_key")

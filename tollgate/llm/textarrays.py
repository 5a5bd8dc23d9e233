"""Words and shingles of whole Arrow text columns as numpy arrays.

Texts are handled in blocks of about a megabyte of UTF-8, so memory does not
grow with the batch.  A word's 64-bit hash is the sum of one pseudo-random
value for each (byte, place in the word), finalised with the length.  The
values have no algebraic structure, so regular words do not collide more often
than others: sets of hashes equal sets of words up to random collisions (for n
distinct words, n * n / 2**65).  All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_STEP = np.uint64(0xD6E8FEB86659FD93)

WHITESPACE = bytes([0x20, *range(0x09, 0x0E)])
#: Bytes outside [0-9a-z] and outside UTF-8 sequences, after lower-casing A-Z.
NON_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _values(key: np.ndarray) -> np.ndarray:
    """Values of keys place * 256 + byte."""
    return mix((key.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F))


_PLACES = 64  # values of the first places of a word are looked up
_TABLE = _values(np.arange(_PLACES << 8))
_LOWER_TABLE = _TABLE.reshape(_PLACES, 256)[:, _ASCII_LOWER].ravel()
_SPANS = 1 << 14  # spans hashed at a time


@dataclass
class Block:
    """Consecutive texts ``first .. first + n`` of a column as one byte array."""

    first: int
    bounds: np.ndarray  # n + 1 byte offsets into data
    data: np.ndarray

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i]:self.bounds[i + 1]].tobytes()


@dataclass
class Words:
    """Words of a block: byte spans, hashes, and word offsets by text."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    offsets: np.ndarray  # n + 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def blocks(column: pa.Array | pa.ChunkedArray, size: int = BLOCK) -> Iterator[Block]:
    """Blocks of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        j = min(j, n)
        yield Block(i, offsets[i:j + 1] - offsets[i], data[offsets[i]:offsets[j]])
        i = j


def span_sums(data: np.ndarray, start: np.ndarray, lower: bool = False) -> np.ndarray:
    """Running sums of the values of (byte, place since the latest ``start``);
    ``start`` ascends."""
    n = len(data)
    place = np.zeros(n, np.int64)
    place[start] = start
    np.maximum.accumulate(place, out=place)
    np.subtract(np.arange(n), place, out=place)
    far = np.flatnonzero(place >= _PLACES)
    key = (place << 8) + (_ASCII_LOWER[data] if lower else data)
    late = _values(key[far])
    key[far] = 0
    values = _TABLE[key]
    values[far] = late
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values, out=sums[1:])
    return sums


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the disjoint, ascending byte spans ``data[start:end]``."""
    size = end - start
    near = np.minimum(size, _PLACES).astype(np.uint8)
    table = (_LOWER_TABLE if lower else _TABLE).reshape(_PLACES, 256)
    sums = np.empty(len(start), np.uint64)
    for at in range(0, len(start), _SPANS):
        # By size, the spans that have a place are the last ones.
        order = np.argsort(near[at:at + _SPANS], kind="stable")
        first, part = start[at + order], np.zeros(len(order), np.uint64)
        shorter = np.cumsum(np.bincount(near[at:at + _SPANS]))[:-1].tolist()
        for place, i in enumerate(shorter):
            part[i:] += table[place].take(data.take(first[i:] + place))
        sums[at + order] = part
    far = np.flatnonzero(size > _PLACES)
    if len(far):
        left = size[far] - _PLACES
        before = np.cumsum(left) - left
        place = np.arange(int(left.sum())) - np.repeat(before, left) + _PLACES
        late = data[np.repeat(start[far], left) + place]
        sums[far] += np.add.reduceat(_values((place << 8) + (_ASCII_LOWER[late] if lower else late)), before)
    return mix(sums + size.astype(np.uint64) * _STEP)


def words(block: Block, separators: bytes = WHITESPACE) -> Words:
    """Maximal runs of non-separator bytes within each text, hashed with A-Z
    lower-cased."""
    is_word = np.ones(256, bool)
    is_word[np.frombuffer(separators, np.uint8)] = False
    inside = np.frombuffer(block.data.tobytes().translate(is_word[_ASCII_LOWER].tobytes()), bool)
    n = len(inside)
    cut = np.zeros(n + 1, bool)
    cut[block.bounds] = True
    before = np.empty(n, bool)
    before[1:] = inside[:-1]
    before[:1] = False
    after = np.empty(n, bool)
    after[:-1] = inside[1:]
    after[n - 1:] = False
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return Words(start, end, span_hashes(block.data, start, end, lower=True), np.searchsorted(start, block.bounds))


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles in text order, and their offsets by text.

    A text with 1 to k-1 words has its whole sequence as one shingle, a text
    without words has none.
    """
    count = w.counts
    per = np.where(count >= k, count - k + 1, (count > 0).astype(count.dtype))
    offsets = np.concatenate([[0], np.cumsum(per)])
    total = int(offsets[-1])
    first = np.repeat(w.offsets[:-1] - offsets[:-1], per) + np.arange(total)
    left = np.repeat(np.minimum(count, k), per)
    h = np.zeros(total, np.uint64)
    padded = np.concatenate([w.hash, np.zeros(k, np.uint64)])
    for j in range(k):
        h = np.where(left > j, h * _STEP + padded[first + j], h)
    return mix(h + left.astype(np.uint64)), offsets


def distinct_by_text(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and their offsets."""
    values = values.copy()
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[offsets[:-1][np.diff(offsets) > 0]] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]

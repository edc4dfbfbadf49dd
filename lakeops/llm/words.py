"""Words of Arrow string columns as numpy arrays.

Everything here works on the UTF-8 bytes of a column, without a Python string per
word. All delimiters are ASCII, and no byte of a multi-byte character is ASCII, so a
word of bytes is a word of code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 2 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_LONG = 64


def class_table(delimiters: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: is it part of a word, and what it reads as."""
    inside = np.ones(256, dtype=bool)
    inside[list(delimiters)] = False
    reads = np.arange(256, dtype=np.uint8)
    if lower:
        reads[ord("A"): ord("Z") + 1] += 32
    return inside, reads


BLANKS = bytes([0x20, *range(0x09, 0x0E)])
NON_ALNUM = bytes(b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A))
SPACED = class_table(BLANKS)
SPACED_LOWER = class_table(BLANKS, lower=True)
ALNUM_LOWER = class_table(NON_ALNUM, lower=True)


@dataclass
class Words:
    """Words of some rows: ``starts``/``ends`` are byte positions in ``data``;
    the words of row r are ``offsets[r]:offsets[r + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends)

    def join(self, chosen: np.ndarray) -> bytes:
        """The chosen words (indexes), one space between them."""
        raw = self.data.tobytes() if len(chosen) * 64 > len(self.data) else None
        spans = zip(self.starts[chosen].tolist(), self.ends[chosen].tolist(), strict=True)
        if raw is not None:
            return b" ".join([raw[a:b] for a, b in spans])
        return b" ".join([self.data[a:b].tobytes() for a, b in spans])


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text each; a longer row stands alone."""
    column = column.cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    row = 0
    while row < len(column):
        upto = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1)
        yield row, min(upto, len(column))
        row = min(upto, len(column))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column (null: empty) and the offset of each row, from 0."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    if last == first:
        return np.zeros(0, dtype=np.uint8), offsets - first
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[first:last], offsets - first


def words(column: pa.Array, table: tuple[np.ndarray, np.ndarray] = SPACED) -> Words:
    """Maximal runs of word bytes in each row."""
    data, offsets = bytes_of(column)
    inside, reads = table
    is_word = inside[data]
    if len(data) == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(offsets), dtype=np.int64))
    before = np.empty_like(is_word)
    before[0] = False
    before[1:] = is_word[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.empty_like(is_word)
    after[-1] = False
    after[:-1] = is_word[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    if reads is not SPACED[1]:
        data = reads[data]
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; the same on every machine."""
    lengths = ends - starts
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    blocks = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    h = mix(lengths.astype(np.uint64) * _GOLDEN + np.uint64(1))
    todo = np.flatnonzero((lengths > 0) & (lengths <= _LONG))
    done = 0
    while len(todo):
        left = lengths[todo] - done
        block = blocks[starts[todo] + done] & _MASKS[np.minimum(left, 8)]
        h[todo] = mix((h[todo] ^ block) * _GOLDEN)
        todo, done = todo[left > 8], done + 8
    for i in np.flatnonzero(lengths > _LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i]: ends[i]].tobytes())
    return h


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k neighbouring hashes: ``len(h) - k + 1`` of them."""
    n = max(0, len(h) - k + 1)
    g = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        g = g * np.uint64(_BASE) + h[j: j + n]
    return mix(g)


class RangeHash:
    """Hashes of arbitrary ranges of a sequence of 64-bit hashes, in constant time."""

    def __init__(self, h: np.ndarray):
        n = len(h)
        powers = np.full(n + 1, np.uint64(_BASE))
        powers[0] = 1
        inverse = np.full(n + 1, np.uint64(pow(_BASE, -1, 1 << 64)))
        inverse[0] = 1
        self.inverse = np.cumprod(inverse, dtype=np.uint64)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(h * np.cumprod(powers, dtype=np.uint64)[:n], out=self.sums[1:], dtype=np.uint64)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _GOLDEN)


def window_minima(g: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` neighbours the position of its leftmost minimum."""
    value, at, have = g, np.arange(len(g)), 1
    while have < width:
        step = min(have, width - have)
        n = len(value) - step
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        left = value[:n] <= value[step: step + n]
        at = np.where(left, at[:n], at[step: step + n])
        value = np.where(left, value[:n], value[step: step + n])
        have += step
    return at

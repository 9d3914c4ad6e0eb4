"""Vectorised work on whole Arrow columns of text: words, shingles and their hashes.

A word is a maximal run of bytes other than the ASCII blanks 0x20 and 0x09-0x0D, with
A-Z in lower case. A text of one to four words has one shingle, of all its words; an
empty text has none. All hashes are 64-bit and do not depend on process or platform.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
WORDS = 5
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(1, 257, dtype=np.uint64)
FOLD[0x41:0x5B] += U(0x20)
BASE = U(0x9E3779B97F4A7C15)
PAD = U(0xD6E8FEB86659FD93)
MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)
PLACES = np.array(
    [0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1342543DE82EF95, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9],
    dtype=np.uint64,
)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE to the powers 0..n-1, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 1024), BASE, dtype=np.uint64)
        grown[0] = U(1)
        _powers = np.multiply.accumulate(grown)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(30))
    x *= MIX[0]
    x ^= x >> U(27)
    x *= MIX[1]
    x ^= x >> U(31)
    return x


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
        column = pc.fill_null(column, b"" if binary else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = at.astype(np.int64)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n, first + 4096)
        yield first, last
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the offsets of the rows among the words."""
    solid = ~SPACE[data]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    start[firsts] = solid[firsts]
    at = np.flatnonzero(start)
    rows = np.searchsorted(at, offsets)
    if not len(at):
        return np.zeros(0, np.uint64), rows
    index = np.flatnonzero(solid)
    begins = np.flatnonzero(start[index])
    lengths = np.diff(np.append(begins, len(index)))
    place = np.arange(len(index)) - np.repeat(begins, lengths)
    value = FOLD[data[index]]
    value *= powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(value, begins)), rows


def shingles(hashes: np.ndarray, rows: np.ndarray, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words within a row, and the offsets of the rows among them."""
    lengths = np.diff(rows)
    short = (lengths > 0) & (lengths < width)
    if short.any():
        padded = np.where(short, width, lengths)
        to = np.concatenate([[0], np.cumsum(padded)])
        wide = np.full(to[-1], PAD, dtype=np.uint64)
        wide[np.arange(len(hashes)) + np.repeat(to[:-1] - rows[:-1], lengths)] = hashes
        hashes, rows, lengths = wide, to, padded
    counts = np.maximum(lengths - width + 1, 0)
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)])
    value = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        value += hashes[k : k + n] * PLACES[k % 5] * U(2 * (k // 5) + 1)
    inside = np.ones(len(hashes), dtype=bool)
    for k in range(1, width):
        last = rows[1:] - k
        inside[last[last >= 0]] = False
    return mix(value[inside[:n]]), np.concatenate([[0], np.cumsum(counts)])


def shingles_of(texts: list[str | None], width: int = WORDS) -> list[np.ndarray]:
    """The shingle hashes of each text, for small inputs and tests."""
    data, offsets = buffers(pa.array(texts, pa.string()))
    values, rows = shingles(*words(data, offsets), width)
    return [values[rows[i] : rows[i + 1]] for i in range(len(texts))]


class MinHash:
    """``count`` universal hash permutations, (a x + b) mod 2**64 with odd a, top 32 bits kept."""

    EMPTY = np.uint32(0xFFFFFFFF)

    def __init__(self, count: int = 128, seed: int = 1):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.count = count
        self.a = draw.integers(0, 1 << 63, count, dtype=np.uint64) * U(2) + U(1)
        self.b = draw.integers(0, 1 << 63, count, dtype=np.uint64) * U(2)

    def signatures(self, values: np.ndarray, rows: np.ndarray, block: int = 1 << 14) -> np.ndarray:
        """One row of minima for each row of shingles; an empty row has the largest value throughout."""
        n = len(rows) - 1
        out = np.full((n, self.count), self.EMPTY, dtype=np.uint32)
        first = 0
        while first < n:
            last = max(first + 1, int(np.searchsorted(rows, rows[first] + block, side="right")) - 1)
            last = min(last, n)
            inner = rows[first : last + 1]
            full = np.flatnonzero(np.diff(inner))
            if len(full):
                part = values[inner[0] : inner[-1]]
                starts = (inner[:-1] - inner[0])[full]
                hashed = np.empty_like(part)
                for k in range(self.count):
                    np.multiply(part, self.a[k], out=hashed)
                    hashed += self.b[k]
                    out[first + full, k] = np.minimum.reduceat(hashed, starts) >> U(32)
            first = last
        return out

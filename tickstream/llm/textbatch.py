"""Words, shingles and rolling hashes of many texts at once, in numpy.

Texts of an Arrow batch are handled as one byte array with offsets. A substring's
hash is a polynomial over 64-bit letter codes, taken from running sums, so any
word, shingle or window costs a few array operations whatever its length. Hashes
are equal for equal bytes on every machine; a chance of 2**-64 per pair is taken.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Work is cut into pieces of about this many bytes, so memory does not follow the
# length of texts or batches.
PIECE_BYTES = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@functools.lru_cache(maxsize=8)
def letter_codes(seed: int, fold: bool) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))
    if fold:
        codes[ord("A"):ord("Z") + 1] = codes[ord("a"):ord("z") + 1]
    return codes


_BASE = {1: 0xD1342543DE82EF95, 2: 0xAF251AF3B0F025B5}


@functools.lru_cache(maxsize=4)
def _powers(seed: int, log_size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    def table(base: int) -> np.ndarray:
        out = np.ones(1, U64)
        factor = base
        while len(out) < 1 << log_size:
            out = np.concatenate([out, out * U64(factor)])
            factor = factor * factor & 0xFFFFFFFFFFFFFFFF
        return out
    base = _BASE[seed]
    return table(base), table(pow(base, -1, 1 << 64))


class Rolling:
    """Hashes of any run of one array of bytes, or of words given by 64-bit hashes."""

    def __init__(self, data: np.ndarray, seed: int = 1, fold: bool = False):
        # One size of table serves all pieces; only longer single texts need another.
        log_size = max(18, len(data).bit_length())
        powers, self.inverse = _powers(seed, log_size)
        self.sums = np.zeros(len(data) + 1, U64)
        codes = mix(data + U64(seed)) if data.dtype == U64 else letter_codes(seed, fold)[data]
        np.cumsum(codes * powers[:len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of about ``limit`` bytes, at least one row each."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b


# Bytes that end a word.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def words(data: np.ndarray, offsets: np.ndarray,
          blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the row each belongs to; ``blank`` marks end bytes."""
    solid = ~blank[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    edges = offsets[1:-1]
    inner = edges[(edges > 0) & (edges < len(data))]
    first[inner] |= solid[inner]
    last[inner - 1] |= solid[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


_STEP = U64(0x9FB21C651E98DF25)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int,
             fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words with their rows, in text order.

    A row with fewer words, but at least one, gives a single run of them all.
    """
    start, end, row = words(data, offsets)
    if not len(start):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    word = Rolling(data, 1, fold)(start, end)
    return runs(word, row, size)


def runs(word: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` word hashes within rows."""
    count = len(word)
    total = np.zeros(max(0, count - size + 1), U64)
    for k in range(size):
        total = mix(total * _STEP + word[k:k + len(total)] + U64(k + 1))
    inside = row[:len(total)] == row[size - 1:] if len(total) else np.zeros(0, bool)
    hashes, rows = total[inside], row[:len(total)][inside]
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if count else np.zeros(0, int)
    lengths = np.diff(np.append(starts, count))
    short = starts[lengths < size]
    if len(short):
        value = np.full(len(short), size, U64)
        lens = lengths[lengths < size]
        for k in range(size - 1):
            more = lens > k
            at = short[more] + k
            value[more] = mix(value[more] * _STEP + word[at] + U64(k + 101))
        hashes, rows = np.concatenate([hashes, value]), np.concatenate([rows, row[short]])
        order = np.argsort(rows, kind="stable")
        hashes, rows = hashes[order], rows[order]
    return hashes, rows


def distinct_in_rows(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct hashes, ascending, with the rows, which must ascend."""
    if not len(hashes):
        return hashes, rows
    hashes = sort_in_rows(hashes, rows)
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])])
    return hashes[new], rows[new]


def sort_in_rows(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The values sorted within each row; one short sort per text beats one long one."""
    values = values.copy()
    cuts = np.flatnonzero(rows[1:] != rows[:-1]) + 1 if len(rows) else []
    for part in np.split(values, cuts):
        part.sort()
    return values


def row_bounds(rows: np.ndarray, count: int) -> np.ndarray:
    """Where each of ``count`` rows begins in an ascending row array, plus the end."""
    return np.searchsorted(rows, np.arange(count + 1))

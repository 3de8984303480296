"""Words, hashes and folds shared by the text operators.

Texts reach Python as Arrow columns. They are read as bytes in blocks of about ``BLOCK`` bytes, so the
memory of a task follows the block and the longest text, never the batch. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 1 << 20

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[0x20, *range(0x09, 0x0E)]] = False
#: Plain words: ASCII letters and digits, and every byte of other characters.
PLAIN_BYTES = np.zeros(256, bool)
PLAIN_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

WORD = r"[^\x20\x09-\x0D]+"

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 2 * BLOCK), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``codes[start:end]`` for every span; equal contents hash equally anywhere."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _power(_BASE, len(codes)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power(_INVERSE, len(codes) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets of the rows, bytes) for runs of rows of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        last = min(n, max(last, row + 1))
        yield row, offsets[row : last + 1] - offsets[row], data[offsets[row] : offsets[last]]
        row = last
    pa.default_memory_pool().release_unused()  # workers live on; what this batch took goes back


def word_spans(data: np.ndarray, offsets: np.ndarray, inside_of: np.ndarray = WORD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each row's words begin in these arrays."""
    inside = inside_of[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(_BYTE_CODES[data], starts, ends)


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive values (rows are not told apart)."""
    at = np.arange(max(0, len(hashes) - size + 1))
    return span_hashes(hashes, at, at + size)


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def held_out(doc_id: str, folds: int) -> Column:
    """True where the fold is 0; a row without id belongs to no fold, so it is false there."""
    return F.coalesce(fold(doc_id, folds) == 0, F.lit(False))

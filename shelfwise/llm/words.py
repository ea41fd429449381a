"""Word and window hashes of whole texts, on Arrow buffers inside tasks.

A text is looked at as its UTF-8 bytes. Words are maximal runs of bytes that
are not separators; each gets a 64-bit hash (a polynomial over the bytes,
mixed). Windows of words get Rabin-Karp hashes: a polynomial over the word
hashes, read off prefix sums, so a window costs two look-ups whatever its
length. Everything is modulo 2**64 and the same on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: White space between words: space, and tab to carriage return.
WHITE_SPACE = np.zeros(256, dtype=bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes of text handled at once; a longer document is a slice of its own.
SLICE_BYTES = 4 << 20

_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(
    1, 2**64, size=256, dtype=np.uint64, endpoint=False)
_BLOCK = 1 << 18
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: np.uint64, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse, for i under ``size``."""
    have = _tables.get(int(base))
    if have is None or len(have[0]) < size:
        size = max(_BLOCK, 1 << int(size - 1).bit_length())
        out = []
        for b in (int(base), pow(int(base), -1, 2**64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        _tables[int(base)] = have = (out[0], out[1])
    return have


def given_back(batches: Iterator) -> Iterator:
    """``batches``, and then the memory they took back to the system.

    A Python worker stays for later tasks, and what its allocators keep for
    themselves is taken from the executor's other work.
    """
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no rows, or several chunks
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes each, or of one longer row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        yield row, end
        row = end


def word_spans(offsets: np.ndarray, data: np.ndarray,
               separators: np.ndarray = WHITE_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the word index at which each row begins."""
    inside = ~separators[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return first, last, np.searchsorted(first, offsets).astype(np.int64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A hash of each byte span; ``fold`` treats A-Z as a-z. Spans are in order."""
    values = _BYTE_VALUES.copy()
    if fold:
        values[ord("A"):ord("Z") + 1] = values[ord("a"):ord("z") + 1]
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        begin = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, begin + _BLOCK, side="right")))
        size = int(ends[upto - 1] - begin)
        power, inverse = _powers(_BYTE_BASE, size)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(values[data[begin:begin + size]] * power[:size], out=sums[1:])
        a, b = starts[at:upto] - begin, ends[at:upto] - begin
        out[at:upto] = (sums[b] - sums[a]) * inverse[a]
        at = upto
    return mix(out)


def word_hashes(offsets: np.ndarray, data: np.ndarray, fold: bool = False,
                separators: np.ndarray = WHITE_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the word index at which each row begins."""
    starts, ends, bounds = word_spans(offsets, data, separators)
    return span_hashes(data, starts, ends, fold), bounds


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive words, row borders ignored."""
    n = len(words)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _powers(_WORD_BASE, n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * power[:n], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * inverse[:n - size + 1])


def window_starts(bounds: np.ndarray, size: int) -> np.ndarray:
    """Word indexes at which a window lies inside one row, in order."""
    n = int(bounds[-1])
    if n < size:
        return np.zeros(0, dtype=np.int64)
    inside = np.ones(n - size + 1, dtype=bool)
    for back in range(1, size):  # a row border after the first word and before the last
        cut = bounds[1:-1] - back
        inside[cut[(cut >= 0) & (cut <= n - size)]] = False
    return np.flatnonzero(inside)

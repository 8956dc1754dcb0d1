"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays.

Texts come as Arrow columns; their UTF-8 bytes are read in place, in pieces of about
half a MB, so memory does not grow with a batch. Equal words have equal hashes wherever
they stand. Two different words or shingles share a hash with chance 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
#: An odd multiplier and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

#: Bytes that belong to words: all but ASCII white space; or letters, digits and non-ASCII.
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Kept(dict):
    """What a process has computed already; left behind when code travels."""

    def __reduce__(self):
        return Kept, ()


_powers = Kept()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit integers over all others; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, places, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + n + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of rows of ``most`` bytes together, or one longer row alone."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the next call."""
    if not _powers or len(_powers[_BASE]) < n:
        for base in (_BASE, _BASE_INVERSE):
            grown = np.full(max(n, 1 << 16), base, np.uint64)
            grown[0] = 1
            _powers[base] = np.cumprod(grown, dtype=np.uint64)
    return _powers[_BASE][:n], _powers[_BASE_INVERSE][:n]


def _word_hashes(data: np.ndarray, starts: np.ndarray, inside: np.ndarray):
    """Hash and first byte of each word; ``starts``: where rows begin."""
    n = len(data)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    rows = starts[starts < n]
    first[rows] = inside[rows]
    rows = rows[rows > 0]
    last[rows - 1] = inside[rows - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    power, inverse = _power(n)
    total = (data + np.uint64(1)) * power
    np.cumsum(total, out=total)
    sums = total[end]
    later = begin > 0
    sums[later] -= total[begin[later] - 1]
    sums *= inverse[begin]
    return mix(sums ^ ((end - begin + 1).astype(np.uint64) * np.uint64(_BASE))), begin


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = SPACED):
    """Hash, row and first byte of each lower-cased word of the given rows.

    ``data`` are the bytes of all rows, ``offsets`` where each begins and the last ends.
    A row longer than a piece is cut where a word has ended.
    """
    data = LOWER[data]
    member = inside[data]
    if len(data) <= 2 * PIECE:
        hashes, begin = _word_hashes(data, offsets[:-1], member)
    else:
        found, at, none = [], 0, np.zeros(0, np.int64)
        while at < len(data):
            cut = len(data)
            if cut - at > PIECE:
                gap = np.flatnonzero(~member[at + PIECE : at + 2 * PIECE])
                while not len(gap) and cut - at > 2 * PIECE:
                    gap = np.flatnonzero(~member[at + PIECE :])[:1]
                    if not len(gap):
                        break
                cut = at + PIECE + int(gap[0]) + 1 if len(gap) else cut
            inner = offsets[(offsets >= at) & (offsets < cut)] - at
            h, b = _word_hashes(data[at:cut], inner if len(inner) else none, member[at:cut])
            found.append((h, b + at))
            at = cut
        hashes = np.concatenate([h for h, _ in found])
        begin = np.concatenate([b for _, b in found])
    row = np.searchsorted(offsets, begin, "right") - 1
    return hashes, row, begin


def shingles(hashes: np.ndarray, row: np.ndarray, n_rows: int, size: int) -> list[np.ndarray]:
    """The distinct shingles of each row, sorted.

    A row with fewer words than ``size`` has one shingle of all its words; a row without
    words has none.
    """
    weights = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    ends = np.searchsorted(row, np.arange(n_rows + 1))
    full = max(len(hashes) - size + 1, 0)
    total = np.zeros(full, np.uint64)
    for k in range(size):
        total += hashes[k : k + full] * weights[k]
    total = mix(total)
    sets = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if b - a >= size:
            own = np.sort(total[a : b - size + 1])
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:
            short = (hashes[a:b] * weights[: b - a]).sum(dtype=np.uint64)
            own = mix(np.array([short ^ np.uint64(b - a)], np.uint64))
        else:
            own = np.zeros(0, np.uint64)
        sets.append(own)
    return sets


def shingle_sets(column: pa.Array, size: int, most: int = PIECE) -> Iterator[list[np.ndarray]]:
    """The shingle sets of a column of texts, rows of ``most`` bytes at a time."""
    data, offsets = texts_of(column)
    for a, b in pieces(offsets, most):
        inner = offsets[a : b + 1] - offsets[a]
        hashes, row, _ = words(data[offsets[a] : offsets[b]], inner)
        yield shingles(hashes, row, b - a, size)

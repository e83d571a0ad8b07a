"""Whole texts as flat byte arrays, so that words are found and hashed without a Python loop per word.

A slice holds the UTF-8 bytes of several rows one after the other. Word classes used
by the operators only test ASCII bytes and take every non-ASCII byte as part of a word,
so they can be tested byte by byte. Slices are small, which bounds the memory of a task;
only a single text longer than a slice makes a longer one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

#: words of ``[^\x20\x09-\x0D]+``
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: words of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing)
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z to a-z, every other byte to itself
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers["base"]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        for name, factor in (("base", _BASE), ("inverse", _INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["base"], _powers["inverse"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(column: pa.Array, limit: int = SLICE_BYTES, max_rows: int = 1 << 16) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive rows; null counts as the empty text.

    Every slice has at most ``max_rows`` rows, and at most ``limit`` bytes unless it is a single row.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(filled):
        return
    _, offset_buffer, data_buffer = filled.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(filled):
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), start + max_rows, len(filled))
        yield start, end, data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def word_spans(in_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (in bytes) of the words; ``in_word`` tells for each byte whether it is part of one."""
    n = len(in_word)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first = in_word.copy()
    first[1:] &= ~in_word[:-1]
    first[cuts] = in_word[cuts]
    last = in_word.copy()
    last[:-1] &= ~in_word[1:]
    last[cuts - 1] = in_word[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_bounds(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each row of the slice the index of its first word, and the number of words at the end."""
    return np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial in its bytes from prefix sums, then mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    base, inverse = _power_table(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * base[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def gram_buckets(data: np.ndarray, offsets: np.ndarray, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash bucket (of a power of two) of every run of ``order`` (up to 7) bytes inside a row."""
    n = max(len(data) - order + 1, 0)
    gram = np.full(n, order, np.uint64)
    for k in range(order):
        gram = (gram << np.uint64(8)) | data[k : n + k]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    inside = np.arange(n) + order <= offsets[1:][row]
    bits = np.uint64(64 - int(buckets).bit_length() + 1)
    return row[inside], ((gram[inside] * np.uint64(_BASE)) >> bits).astype(np.int64)

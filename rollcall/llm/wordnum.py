"""Words of Arrow text columns as 64-bit numbers, vectorised over whole batches.

Texts stay in Arrow's byte buffer; words are found and hashed without making a Python string. All
functions work on slices of a batch of a few megabytes (or one document, if it is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of text that are worked on at once.
SLICE_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column, and the offsets of each (one more than texts). Null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``limit`` bytes each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def find_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (byte positions) of all words, and for each text the number of its first word."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = _SPACE[raw]
    opens = ~space
    opens[1:] &= space[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < len(raw)]
    opens[inner] = ~space[inner]
    starts = np.flatnonzero(opens)
    closes = np.empty_like(space)
    closes[-1] = True
    closes[:-1] = space[1:]
    closes[inner[inner > 0] - 1] = True
    closes &= ~space
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_segments(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit number for each of consecutive segments of small values; no length may be 0.

    A polynomial of the values modulo 2**64, scrambled.
    """
    if not len(lengths):
        return np.zeros(0, U64)
    first = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    place = np.arange(len(values), dtype=np.int64) - np.repeat(first, lengths)
    powers = np.empty(int(lengths.max()), U64)
    powers[0] = 1
    powers[1:] = _BASE
    np.multiply.accumulate(powers, out=powers)
    terms = (values.astype(U64) + U64(1)) * powers[place]
    return mix64(np.add.reduceat(terms, first) + lengths.astype(U64))


def hash_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit number for each word, by its bytes (A-Z lower-cased)."""
    lengths = ends - starts
    place = np.arange(int(lengths.sum()), dtype=np.int64)
    place += np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    letters = raw[place]
    return hash_segments(_LOWER[letters] if lower else letters, lengths)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct numbers of all runs of ``width`` words, sorted; a shorter text is one run, an empty one none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    total = np.full(n - width + 1, U64(width))
    for k in range(width):
        total = total * _BASE + hashes[k : n - width + 1 + k]
    return np.unique(mix64(total))


def text_shingles(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The shingle set of each text of a column, in order."""
    raw, offsets = text_bytes(column)
    for first, last in slices(offsets):
        part = raw[offsets[first] : offsets[last]]
        own = offsets[first : last + 1] - offsets[first]
        starts, ends, at = find_words(part, own)
        hashes = hash_words(part, starts, ends)
        for k in range(last - first):
            yield shingles(hashes[at[k] : at[k + 1]], width)

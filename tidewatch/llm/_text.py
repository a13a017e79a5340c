"""Arrow text columns as numpy arrays: UTF-8 bytes, words and their 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All rows' bytes, and where each row begins and ends; null reads as empty."""
    a = pc.fill_null(column.cast(pa.binary()) if pa.types.is_string(column.type) else column, b"").cast(pa.large_binary())
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = a.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


#: Bytes of text that a task works on at once, if rows aren't longer.
PIECE = 1 << 20


def pieces(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes, so that working arrays stay small; a longer row is a run of its own."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


#: Places of a block, each of which has a random number of its own for every byte.
BLOCK = 64


@lru_cache(1)
def _numbers() -> np.ndarray:
    return mix((np.arange(BLOCK * 256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def _sums(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of stretches of ``values``, modulo 2^64."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[end] - sums[begin]


def hashed(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches of ``data``, which are sorted, apart and not empty.

    Blocks of 64 bytes have the sum of a random number for each place and byte, and a stretch that of its blocks, each mixed
    with its place: sums of unrelated numbers, unlike a polynomial's, are equal by chance alone.  Some stretches at a
    time, so that memory follows the longest stretch and not the text.
    """
    out = np.empty(len(begin), np.uint64)
    i = 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + PIECE, "right")))
        a, b = int(begin[i]), int(end[j - 1])
        first, last = begin[i:j] - a, end[i:j] - a
        place = np.arange(b - a) - np.repeat(first, np.diff(np.append(first, b - a)))
        term = _numbers()[(place % BLOCK) * 256 + data[a:b]]
        size = last - first
        if size.max() <= BLOCK:
            x = mix(_sums(term, first, last) + np.uint64(1))
        else:
            parts = -(-size // BLOCK)
            own = np.cumsum(parts) - parts
            k = np.arange(parts.sum()) - np.repeat(own, parts)
            start = np.repeat(first, parts) + k * BLOCK
            x = _sums(term, start, np.minimum(start + BLOCK, np.repeat(last, parts)))
            x = np.add.reduceat(mix(x + mix(k.astype(np.uint64)) + np.uint64(1)), own)  # the first block's place adds nothing
        out[i:j] = mix(x + size.astype(np.uint64))
        i = j
    return out


def runs_hashed(h: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of runs of hashes that follow each other, ``size`` each from ``first`` on."""
    place = np.arange(len(h)) - np.repeat(first, size)
    terms = mix(h + mix(place.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)))
    return mix(_sums(terms, first, first + size) + mix(size.astype(np.uint64)))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the words (runs of other bytes than ASCII white space, A-Z in lower case): row, begin and end in ``data``, hash."""
    base = int(offsets[0])
    raw = data[base : int(offsets[-1])]
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    edges = offsets - base
    inside = ~SPACE[raw]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[edges[:-1][edges[:-1] < n]] = False
    after[edges[1:][edges[1:] > 0] - 1] = False
    begin, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return np.searchsorted(edges, begin, "right") - 1, begin + base, end + base, hashed(LOWER[raw], begin, end)

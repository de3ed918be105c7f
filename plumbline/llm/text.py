"""Vectorised access to the texts of an Arrow batch: bytes, words and word hashes without Python strings."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from plumbline.llm.common import GOLDEN, give_back, mix64

#: ASCII white space: space and U+0009 to U+000D.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: A word's bytes are hashed as a polynomial in this odd number.
RADIX = np.uint64(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SOLID = np.ones(256, dtype=bool)
_SOLID[list(SPACES)] = False
#: Bytes of terms: A-Z, a-z and all of letters beyond ASCII.
LETTERS = np.arange(256) >= 128
LETTERS[65:91] = LETTERS[97:123] = True


@cache
def _byte_values() -> np.ndarray:
    return mix64((np.arange(1, 257, dtype=np.uint64)) * GOLDEN)


#: Powers of RADIX up to this are held; a longer word's are products of two of them.
HELD = 1 << 12


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """RADIX to the powers 0 to HELD - 1, and RADIX**HELD to as many."""
    out = []
    with np.errstate(over="ignore"):
        for base in (RADIX, np.uint64(pow(int(RADIX), HELD, 1 << 64))):
            steps = np.full(HELD, base, dtype=np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps))
    return out[0], out[1]


def _power(k: np.ndarray, most: int) -> np.ndarray:
    """RADIX to the powers k, of which none exceeds `most`."""
    low, high = _powers()
    if most < HELD:
        return low[k]
    with np.errstate(over="ignore"):
        out, k = low[k % HELD], k // HELD
        while k.any():
            out *= high[k % HELD]
            k, high = k // HELD, _raised(high)
    return out


def _raised(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        steps = np.full(HELD, x[-1] * x[1], dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps)


class Slice(NamedTuple):
    """Some neighbouring documents of a batch: rows lo to hi, their bytes and where each begins."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


def slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[Slice]:
    """Cut a string column into runs of rows of about `limit` bytes. Nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield Slice(lo, hi, whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi
    give_back()


class Words(NamedTuple):
    """Words of a slice: first byte, byte after the last, hash, and for each document its first word."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def lower(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case; other letters stay."""
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray, solid_bytes: np.ndarray = _SOLID) -> Words:
    """Runs of solid bytes, by default all but ASCII white space; no word crosses from one document to the next."""
    n = len(data)
    none = np.zeros(0, dtype=np.int64)
    if not n:
        return Words(none, none, none.astype(np.uint64), np.zeros(len(offsets), np.int64))
    solid = solid_bytes[data]
    begins = np.empty(n, dtype=bool)
    begins[0] = True
    begins[1:] = ~solid[:-1]
    begins[offsets[:-1][offsets[:-1] < n]] = True
    start = np.flatnonzero(begins & solid)
    ends = np.empty(n, dtype=bool)
    ends[-1] = True
    ends[:-1] = ~solid[1:] | begins[1:]
    end = np.flatnonzero(ends & solid) + 1
    if not len(start):
        return Words(none, none, none.astype(np.uint64), np.zeros(len(offsets), np.int64))
    at = np.flatnonzero(solid)
    length = end - start
    firsts = np.zeros(len(start), dtype=np.int64)
    np.cumsum(length[:-1], out=firsts[1:])
    with np.errstate(over="ignore"):
        value = _byte_values()[data[at]] * _power(np.arange(len(at)) - np.repeat(firsts, length), int(length.max()))
        h = mix64(np.add.reduceat(value, firsts) + length.astype(np.uint64))
    return Words(start, end, h, np.searchsorted(start, offsets, "left"))


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The pieces of the bytes from each start to its end as strings."""
    at = np.concatenate(([0], np.cumsum(end - start)))
    take = np.arange(at[-1]) + np.repeat(start - at[:-1], end - start)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data[take]))

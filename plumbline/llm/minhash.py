"""SuperMinHash signatures of shingle sets, for many sets at once."""

from __future__ import annotations

import numpy as np

from plumbline.llm.common import GOLDEN, mix64, unit
from plumbline.llm.text import Words

SHINGLE = 5


def shingles(w: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Each document's sorted distinct shingle hashes, one after the other, and where each document's begin.

    A document of fewer words than `size` has its whole sequence as its one shingle; one without words has none.
    """
    h, first = w.hash, w.first
    out, at = [], np.zeros(len(first), dtype=np.int64)
    with np.errstate(over="ignore"):
        salt = mix64(np.arange(1, size + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
        if len(h) >= size:
            rolled = h[: len(h) - size + 1] * salt[0]
            for k in range(1, size):
                rolled = rolled + h[k : len(h) - size + 1 + k] * salt[k]
            rolled = mix64(rolled)
        for d in range(len(first) - 1):
            a, b = int(first[d]), int(first[d + 1])
            if b - a >= size:
                s = np.sort(rolled[a : b - size + 1])
                if len(s) > 1:
                    s = s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif b > a:
                s = mix64(np.sum(h[a:b] * salt[: b - a], keepdims=True, dtype=np.uint64) + np.uint64(b - a))
            else:
                s = h[:0]
            out.append(s)
            at[d + 1] = at[d] + len(s)
    return (np.concatenate(out) if out else h[:0]), at


def fingerprints(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each whole set; equal sets have equal ones."""
    n = len(at) - 1
    a, b = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    full = np.flatnonzero(at[1:] > at[:-1])
    if len(full):
        with np.errstate(over="ignore"):
            a[full] = np.add.reduceat(mix64(values ^ np.uint64(0x5851F42D4C957F2D)), at[full])
            b[full] = np.add.reduceat(mix64(values + np.uint64(0x14057B7EF767814F)), at[full])
    return a.view(np.int64), b.view(np.int64)


#: Elements that take their steps together; a larger set takes them alone.
TOGETHER = 1 << 17


def signatures(values: np.ndarray, at: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash (Ertl 2017) of each set: one row of `slots` doubles a set; an empty set's row is infinite.

    An element visits the slots in the order of a random permutation of its own; at step j it offers j + u, u uniform
    in [0, 1). A slot keeps the least offer. Offers of later steps are larger, so a set stops once no slot holds
    more than the next step's least offer. Sets take their steps together, about TOGETHER elements at a time, and those
    that have stopped leave. The permutation is a Fisher-Yates shuffle whose swaps, a byte each, are replayed.
    """
    n = len(at) - 1
    out = np.full((n, slots), np.inf)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + TOGETHER, "right")) - 1)
        _visit(values[at[lo] : at[hi]], np.repeat(np.arange(hi - lo), np.diff(at[lo : hi + 1])), out[lo:hi])
        lo = hi
    return out


def _visit(x: np.ndarray, owner: np.ndarray, best: np.ndarray) -> None:
    """Lower the slots `best` of some sets to the offers of their elements x."""
    slots = best.shape[1]
    place = np.uint8 if slots <= 256 else np.int64
    flat, swaps = best.reshape(-1), []
    for j in range(slots):
        if not len(x):
            break
        with np.errstate(over="ignore"):
            seed = x + np.uint64(2 * j + 1) * GOLDEN
            u, v = unit(mix64(seed)), unit(mix64(seed + GOLDEN))
        k = (j + (v * (slots - j)).astype(np.int64)).astype(place)
        q = k.copy()
        for i in range(j - 1, -1, -1):
            other = swaps[i]
            q = np.where(q == i, other, np.where(q == other, place(i), q))
        np.minimum.at(flat, owner * slots + q, j + u)
        swaps.append(k)
        stay = (best.max(axis=1) > j + 1)[owner]
        if not stay.all():
            x, owner, swaps = x[stay], owner[stay], [s[stay] for s in swaps]


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One int64 key for each band of `rows` slots."""
    bits = np.ascontiguousarray(sig).view(np.uint64).reshape(len(sig), bands, rows)
    with np.errstate(over="ignore"):
        salt = mix64(np.arange(1, rows + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
        return mix64((mix64(bits) * salt).sum(axis=2, dtype=np.uint64)).view(np.int64)

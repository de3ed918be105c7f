"""Benchmark passages in documents: CGK embeddings of windows, bit-sampling LSH, exact edit verification.

A window walks through its words, one symbol out a step, and moves on when a random function of word and step says so
(Chakraborty, Goldenberg, Koucky 2016). Two texts of small edit distance that walk by the same functions fall into step
again soon after an edit, so their outputs differ in few places. Some sampled places of the output make an LSH key;
several walks with several samples each reach the recall, and what they bring together is aligned exactly.

Windows are of the item's size. An item's go from some words of its first half to its end, from the rarest ones of the
benchmark, so that some of them begin in step however an occurrence is edited; a document's go from each such word over
as many words as the item has from there on. The first word is part of every key: a place of a document that begins no
window of an item has no key to share, and needs no walk. No other index proposes anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import GOLDEN, Scratch, mix64, tune, unit
from plumbline.llm.text import Slice, Words, lower, slices, words

#: An occurrence differs from the item by at most this share of the item's words, inserted, deleted or replaced.
EDITS = 0.2
#: Walks, samples of each walk, and places in a sample beside the first. With half of a walk's places disturbed, one of
#: the 30 keys of a window agrees with a probability of about 0.9, and an item has several windows.
WALKS, SAMPLES, PLACES = 5, 6, 3
#: Windows of an item beside one for each edit that it allows.
MORE = 3
#: Symbols of walks that are held at a time.
SYMBOLS = 1 << 21
#: Items that a task holds at a time have at most so many characters; more are searched in several passes.
ITEM_CHARS = 8 << 20


def allowed(n: int, edits: float = EDITS) -> int:
    return int(n * edits + 1e-9)


def _places(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64((1 << 20) - 1)).astype(np.int64)


def _sieve(h: np.ndarray) -> np.ndarray:
    """Where it is false at _places() of a hash, the hash is none of h."""
    out = np.zeros(1 << 20, dtype=bool)
    out[_places(h)] = True
    return out


@dataclass
class Windows:
    """The windows of all items: their first words with the lengths that begin there, and keys with where each is from."""

    first: np.ndarray
    bounds: np.ndarray
    lengths: np.ndarray
    keys: np.ndarray
    sieve: np.ndarray
    item: np.ndarray
    offset: np.ndarray


@dataclass
class Items:
    """A part of the benchmark as every task holds it: ids, word hashes, windows, and a sieve for their first words."""

    ids: list[int]
    words: list[np.ndarray]
    windows: Windows | None
    sieve: np.ndarray
    plain: list[list[int]]

    @staticmethod
    def build(rows: list[tuple[int, str]], edits: float = EDITS) -> Items:
        ids, hashes = [], []
        for ident, text in rows:
            raw = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)
            h = words(lower(raw), np.array([0, len(raw)])).hash
            if len(h):
                ids.append(ident)
                hashes.append(h)
        sieve = _sieve(np.zeros(0, np.uint64))
        if not ids:
            return Items([], [], None, sieve, [])
        flat = np.concatenate(hashes)
        known, n = np.unique(flat, return_counts=True)
        begin = np.cumsum([0, *map(len, hashes)])
        starts: list[tuple[int, int]] = []
        for j, h in enumerate(hashes):
            able = h[: len(h) // 2 + len(h) % 2]
            rare = np.lexsort((able, n[np.searchsorted(known, able)]))[: allowed(len(h), edits) + MORE]
            starts.extend((j, int(o)) for o in np.sort(rare))
        item, offset = (np.array(x, dtype=np.int64) for x in zip(*starts, strict=True))
        at, stop = begin[item] + offset, begin[item + 1]
        keys = embed_keys(flat, at, stop, stop - at)
        order = np.argsort(keys.ravel(), kind="stable")
        spread = lambda x: np.repeat(x, keys.shape[1])[order].astype(np.int32)
        pairs = np.unique(np.stack((flat[at], (stop - at).astype(np.uint64)), axis=1), axis=0)
        first, bounds = np.unique(pairs[:, 0], return_index=True)
        found = Windows(first, np.append(bounds, len(pairs)), pairs[:, 1].astype(np.int64), keys.ravel()[order], _sieve(keys.ravel()), spread(item), spread(offset))
        return Items(ids, hashes, found, _sieve(first), [h.tolist() for h in hashes])


@cache
def _drawn(c: int) -> tuple[np.ndarray, np.ndarray]:
    """(walk, sample) -> name, and the places that are sampled from a walk of 2 * c steps, beyond where it is at its first word."""
    walk, sample, steps = np.arange(WALKS, dtype=np.uint64), np.arange(SAMPLES, dtype=np.uint64), 2 * c
    with np.errstate(over="ignore"):
        name = (np.uint64(c) * np.uint64(WALKS) + walk[:, None]) * np.uint64(SAMPLES) + sample
        draw = unit(mix64((name[:, :, None] * np.uint64(PLACES) + np.arange(PLACES, dtype=np.uint64)) * GOLDEN + np.uint64(99)))
        least = min(4, steps - 1)
        return mix64(name * GOLDEN), np.sort((least + draw * (steps - least)).astype(np.int64), axis=2)


@cache
def _moves(steps: int) -> np.ndarray:
    """(step, walk) -> an odd number. A word's hash times it has a first bit, which is whether a walk moves on from the word."""
    with np.errstate(over="ignore"):
        at = np.arange(1, steps + 1, dtype=np.uint64)[:, None] + np.arange(WALKS, dtype=np.uint64) * np.uint64(1 << 20)
        return mix64(at * GOLDEN) | np.uint64(1)


def embed_keys(h: np.ndarray, start: np.ndarray, stop: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """LSH keys, WALKS * SAMPLES a row, of the CGK walks of 2 * size steps over size words of h from `start`, or up to `stop`.

    Keys hold the size, the walk, the sample and the first word, so that equal keys come from equal ones of each.
    """
    n = len(start)
    size = np.broadcast_to(np.asarray(size, dtype=np.int64), (n,))
    lengths, which = np.unique(size, return_inverse=True)
    drawn = [_drawn(int(c)) for c in lengths]
    names, places = (np.stack([d[i] for d in drawn]) if drawn else np.zeros((0, WALKS, SAMPLES, PLACES)[: 3 + i], np.int64) for i in range(2))
    padded = np.append(h, np.uint64(0))
    out, order, lo = np.empty((n, WALKS * SAMPLES), np.uint64), np.argsort(-size, kind="stable"), 0
    while lo < n:  # rows by size from the longest, so that those still walking are the first of a part
        steps = 2 * int(size[order[lo]])
        rows = order[lo : lo + max(1, SYMBOLS // (WALKS * steps))]
        lo += len(rows)
        symbols = np.empty((steps, len(rows), WALKS), np.uint64)
        longest, own = -2 * size[rows], which[rows]
        pos, end = np.repeat(start[rows][:, None], WALKS, axis=1), np.minimum(start + size, stop)[rows][:, None]
        moves = _moves(steps)
        with np.errstate(over="ignore"):
            for t in range(int(places[own].max()) + 1):
                live = int(np.searchsorted(longest, -t))
                p = pos[:live]
                inside = p < end[:live]
                symbol = np.where(inside, padded[np.minimum(p, len(h))], np.uint64(0x5BD1E995))
                symbols[t, :live] = symbol
                p += ((symbol * moves[t]) >> np.uint64(63)).astype(bool) & inside
            acc = mix64(padded[start[rows]][:, None, None] + names[own])
            for k in range(PLACES):
                seen = symbols[places[own][:, :, :, k], np.arange(len(rows))[:, None, None], np.arange(WALKS)[None, :, None]]
                acc = mix64((acc ^ seen) * GOLDEN + np.uint64(1))
        out[rows] = acc.reshape(len(rows), -1)
    return out


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the part of text that is nearest to the item by edit distance over words."""

    def last_row(a: np.ndarray, b: np.ndarray, free: bool) -> np.ndarray:
        j = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, np.int64) if free else j.copy()
        for w in a:
            step = np.empty_like(row)
            step[0] = row[0] + 1
            step[1:] = np.minimum(row[1:] + 1, row[:-1] + (b != w))
            row = np.minimum.accumulate(step - j) + j
        return row

    row = last_row(item, text, True)
    end = int(row.argmin())
    back = last_row(item[::-1], text[:end][::-1], False)
    return int(row[end]), end - int(np.flatnonzero(back == row[end])[0]), end


def candidates(h: np.ndarray, first: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, word at which the item would begin) of windows that share an LSH key, for the documents of a slice."""
    found, w = [np.zeros((0, 3), np.int64)], items.windows
    sifted = np.flatnonzero(items.sieve[_places(h)]) if w else np.zeros(0, np.int64)
    if len(sifted):
        at = np.minimum(np.searchsorted(w.first, h[sifted]), len(w.first) - 1)
        same = w.first[at] == h[sifted]
        every, at = sifted[same], at[same]
        many = w.bounds[at + 1] - w.bounds[at]
        place = np.repeat(w.bounds[at], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        every, size = np.repeat(every, many), w.lengths[place]
        for i in range(0, len(every), 1 << 13):
            p, c = every[i : i + (1 << 13)], size[i : i + (1 << 13)]
            doc = np.searchsorted(first, p, "right") - 1
            keys = embed_keys(h, p, first[doc + 1], c).ravel()
            likely = np.flatnonzero(w.sieve[_places(keys)])
            lo, hi = (np.searchsorted(w.keys, keys[likely], side) for side in ("left", "right"))
            n = hi - lo
            which = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            own = np.repeat(likely // (WALKS * SAMPLES), n)
            found.append(np.unique(np.stack((doc[own], w.item[which], p[own] - w.offset[which]), axis=1), axis=0))
    doc, item, begin = np.unique(np.concatenate(found), axis=0).T
    return doc, item, begin


def nearest(s: Slice, w: Words, items: Items, edits: float = EDITS) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(document of the slice, item) -> (edits, first word, word after the last) of every confirmed occurrence at its best."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    seen: set[tuple[int, int, int]] = set()
    for d, j, p in zip(*(x.tolist() for x in candidates(w.hash, w.first, items))):
        item = items.words[j]
        k = allowed(len(item), edits)
        lo, hi = max(int(w.first[d]), p - 2 * k), max(int(w.first[d]), min(int(w.first[d + 1]), p + len(item) + 2 * k))
        if (j, lo, hi) in seen:
            continue
        seen.add((j, lo, hi))
        near = set(w.hash[lo:hi].tolist())
        if sum(x not in near for x in items.plain[j]) > k:  # each of them costs an edit
            continue
        cost, a, b = align(item, w.hash[lo:hi])
        if cost <= k and b > a:
            best[d, j] = min(best.get((d, j), (cost, lo + a, lo + b)), (cost, lo + a, lo + b))
    return best


def _search(docs: DataFrame, shared: Broadcast, edits: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            for s in slices(batch.column(1)):
                w = words(lower(s.data), s.offsets)
                rows = []
                for (d, j), (cost, a, b) in sorted(nearest(s, w, items, edits).items()):
                    begin, x, y = int(s.offsets[d]), int(w.start[a]), int(w.end[b - 1])
                    chars = lambda lo, hi: len(s.data[lo:hi].tobytes().decode("utf-8", "replace"))
                    start = chars(begin, x)
                    rows.append((batch.column(0)[s.lo + d].as_py(), items.ids[j], cost, len(items.words[j]), start, start + chars(x, y)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=list(COLUMNS))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in COLUMNS))


COLUMNS = ("doc_id", "item_id", "edits", "item_words", "start", "end")


def leaks(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """(doc_id, item_id, edits, item_words, start, end): items within a share of word edits of some part of a document.

    One row for each row of docs and each item that it holds, at its nearest and then first place; start and end count
    code points of the whole text. Words are lower-cased for A-Z and parted by ASCII white space. Null and blank texts
    and items match nothing; repeated items each match; repeated rows repeat; a null item_id or doc_id is returned as
    it is. No rows in, no rows out; other columns are ignored.
    """
    tune(docs.sparkSession)
    out, scratch = None, Scratch(docs.sparkSession, "leaks")
    for shared, alone in _passes(benchmark, edits):
        found = _search(docs, shared, edits)
        if not alone:
            found = scratch.cut(found)
            shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def _passes(benchmark: DataFrame, edits: float) -> Iterator[tuple[Broadcast, bool]]:
    """The benchmark in parts that a task may hold, each as a broadcast of Items, and whether it is the only one.

    The driver holds one part at a time. Of several, a part's broadcast is destroyed once its result is written.
    """
    bench = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text is not null")
    size = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-size // ITEM_CHARS))
    for i in range(passes):
        part = bench if passes == 1 else bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == i)
        yield bench.sparkSession.sparkContext.broadcast(Items.build([(r[0], r[1]) for r in part.orderBy("item_id", "text").collect()], edits)), passes == 1


def without_leaks(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """docs without the rows in which leaks() finds an item. No row moves between tasks.

    All columns, whatever their names, stay as they are. Null, empty and blank texts hold no item and stay, and so do rows
    without a doc_id if they hold none. Repeated rows stay or go together. No rows or no items in: all rows out.
    """
    tune(docs.sparkSession)
    at, out, scratch = docs.columns.index("text"), docs, Scratch(docs.sparkSession, "clean")
    for shared, alone in _passes(benchmark, edits):

        def run(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for s in slices(batch.column(at)):
                    for d, _ in nearest(s, words(lower(s.data), s.offsets), items, edits):
                        keep[s.lo + d] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
        if not alone:
            out = scratch.cut(out)
            shared.destroy()
    return out

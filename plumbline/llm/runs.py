"""Periodic runs of words, by block matching.

Scale k looks for periods from 2**k to less than 2**(k + 1). The words of a batch are cut into aligned blocks of 2**k. A
run of at least three periods holds such a block together with its next occurrence, one period further on. So:

1. A block can be in a run only if each of its words comes again within less than 2**(k + 1) words; others are left out.
2. The blocks that are left are keys of an Aho-Corasick automaton over integers, which is fed what lies behind them. A
   key has at most KEY integers: the names of equal parts of a block, and the text is read once for each offset of parts.
3. An occurrence at a distance of the scale is a seed. It is extended word by word in both directions as long as words
   that far apart are equal, which proves the run or refutes it.

A long run has many seeds; those within what is known already are skipped, so no stretch is extended twice.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import GOLDEN, mix64, tune
from plumbline.llm.text import RADIX, slices, strings, words

#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: Integers of a key at most, and blocks of an automaton at most; more blocks take several automata one after another.
KEY, BLOCKS = 8, 1 << 15

_BACK = np.uint64(pow(int(RADIX), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(steps)


class _Names:
    """Names of all stretches of a sequence: equal stretches of one length have equal names."""

    def __init__(self, values: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * _powers(RADIX, len(values)))))
        self.back = _powers(_BACK, len(values) + 1)

    def of(self, at: np.ndarray, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[at + size] - self.sums[at]) * self.back[at]


def _equal_ahead(v: np.ndarray, i: int, j: int) -> int:
    """How many values from i on equal those from j on."""
    done, step, n = 0, 32, len(v) - max(i, j)
    while done < n:
        m = min(step, n - done)
        differ = np.flatnonzero(v[i + done : i + done + m] != v[j + done : j + done + m])
        if len(differ):
            return done + int(differ[0])
        done, step = done + m, step * 2
    return n


def _equal_behind(v: np.ndarray, i: int, j: int) -> int:
    """How many values before i equal those before j."""
    done, step, n = 0, 32, min(i, j)
    while done < n:
        m = min(step, n - done)
        differ = np.flatnonzero(v[i - done - m : i - done] != v[j - done - m : j - done])
        if len(differ):
            return done + m - 1 - int(differ[-1])
        done, step = done + m, step * 2
    return n


def _primitive(v: np.ndarray, at: int, period: int) -> bool:
    """Whether no divisor of the period is a period of the two periods from `at` on."""
    rest, d = period, 2
    while rest > 1:
        if d * d > rest:
            d = rest
        if rest % d == 0:
            q = period // d
            if np.array_equal(v[at : at + period], v[at + q : at + q + period]):
                return False
            while rest % d == 0:
                rest //= d
        d += 1
    return True


class _Known:
    """Runs found at smaller scales, asked whether one of them holds a whole stretch."""

    def __init__(self, runs: list[tuple[int, int, int]]) -> None:
        ordered = sorted(runs)
        self.start = np.array([s for s, _, _ in ordered], dtype=np.int64)
        self.end = np.maximum.accumulate(np.array([s + n for s, n, _ in ordered], dtype=np.int64)) if ordered else np.zeros(0, np.int64)

    def holds(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(len(lo), dtype=bool)
        at = np.searchsorted(self.start, lo, "right") - 1
        return (at >= 0) & (self.end[at] >= hi)


def _seeds(names: _Names, blocks: np.ndarray, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, occurrence): starts of the blocks that occur again `size` to less than 2 * size words further on."""
    part = max(1, size // KEY)
    inner = np.arange(0, size, part)
    # where an occurrence may begin; neighbouring stretches are one
    lo, hi = blocks + size, np.minimum(blocks + 2 * size, n - size + 1)
    new = np.flatnonzero(np.concatenate(([True], lo[1:] > hi[:-1])))
    stretches = list(zip(lo[new], np.maximum.reduceat(hi, new), strict=True))
    at = [np.arange(a, b + size - part) for a, b in stretches]
    keys = names.of((blocks[:, None] + inner).ravel(), part)
    every = np.concatenate((keys, *(names.of(x, part) for x in at)))
    ranks = np.unique(every, return_inverse=True)[1].reshape(-1)
    auto = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    number: dict[tuple, int] = {}
    own = np.full(int(blocks[-1]) // size + 1, -1, dtype=np.int64)
    for b, key in zip(blocks // size, map(tuple, ranks[: len(keys)].reshape(len(blocks), -1).tolist()), strict=True):
        own[b] = number.setdefault(key, len(number))
    for key, i in number.items():
        auto.add_word(key, i)
    auto.make_automaton()
    found_at, found, done = [], [], len(keys)
    for x in at:
        text = ranks[done : done + len(x)]
        done += len(x)
        for r in range(min(part, len(x))):
            hits = list(auto.iter(tuple(text[r::part].tolist())))
            if hits:
                h = np.array(hits, dtype=np.int64)
                found_at.append(x[0] + r + (h[:, 0] - len(inner) + 1) * part)
                found.append(h[:, 1])
    if not found:
        none = np.zeros(0, np.int64)
        return none, none
    t, which = np.concatenate(found_at), np.concatenate(found)
    block = t // size - 1
    good = (block >= 0) & (block < len(own)) & (own[np.minimum(block, len(own) - 1)] == which)
    return block[good] * size, t[good]


def periodic(values: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run of a sequence of uint64, by start and then period.

    A run is a stretch with a smallest period and at least max(least, times * period) values that neither neighbour
    extends. times has to be 3 or more, else a run may hold no block with its next occurrence.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods can't be found by blocks")
    n, runs = len(values), []
    if n < max(least, times):
        return runs
    order = np.argsort(values, kind="stable")
    again = values[order[1:]] == values[order[:-1]]
    gap = np.full(n, n, dtype=np.int64)
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    names, size = None, 1
    while size * times <= n:
        known = _Known(runs)
        blocks = np.flatnonzero(gap < 2 * size) * size
        blocks = blocks[blocks + 2 * size <= n]
        blocks = blocks[~known.holds(blocks, blocks + 3 * size)]
        names = names or (_Names(values) if len(blocks) else None)
        for lo in range(0, len(blocks), BLOCKS):
            i, t = _seeds(names, blocks[lo : lo + BLOCKS], size, n)
            free = ~known.holds(i, t + size)
            i, p = i[free], (t - i)[free]
            by = np.lexsort((i, p))
            last, end = 0, 0
            for at, period in zip(i[by].tolist(), p[by].tolist(), strict=True):
                if period == last and at < end:
                    continue
                end = at + _equal_ahead(values, at, at + period)
                last = period
                if end == at:  # names agree by chance
                    continue
                begin = at - _equal_behind(values, at, at + period)
                length = end - begin + period
                if length >= max(least, times * period) and _primitive(values, begin, period):
                    runs.append((begin, length, period))
        pairs = len(gap) // 2
        gap = np.maximum(gap[0 : 2 * pairs : 2], gap[1 : 2 * pairs : 2])
        size *= 2
    return sorted(set(runs), key=lambda r: (r[0], r[2]))


def planted(doc_id: int, n: int) -> np.ndarray | None:
    """Word numbers of a document whose end repeats what lies before it, for one in ten documents told by their id."""
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate((np.arange(a), a + np.arange(n - a) % p))


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.large_string()),
    ]
)


def _scan(least: int, times: int, rewrite: Callable[[int, int], np.ndarray | None] | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in slices(batch.column(1)):
            ids = batch.column(0).slice(s.lo, s.hi - s.lo)
            w = words(s.data, s.offsets)
            first, n = w.first, np.diff(w.first)
            source = np.arange(len(w.hash))
            if rewrite:
                for d, doc_id in enumerate(ids.to_pylist()):
                    if doc_id is not None and (to := rewrite(doc_id, int(n[d]))) is not None:
                        source[first[d] : first[d + 1]] = first[d] + to
            row = np.repeat(np.arange(len(n)), n)
            with np.errstate(over="ignore"):  # words of different documents are different, so no run goes from one to the next
                values = mix64(w.hash[source] + (row + 1).astype(np.uint64) * GOLDEN)
            runs = periodic(values, least, times)
            start, length, period = (np.array([r[i] for r in runs], dtype=np.int64) for i in range(3))
            edge = np.zeros(len(values) + 1, dtype=np.int64)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, start + length, -1)
            kept = np.cumsum(edge[:-1]) == 0
            of = np.searchsorted(first, start, "right") - 1
            bounds = pa.array(np.searchsorted(of, np.arange(len(n) + 1)), pa.int32())
            fields = [pa.array(x) for x in (start - first[of], length, period)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n), pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(fields, ["start", "length", "period"])), _joined(s.data, w.start[source][kept], w.end[source][kept], row[kept], len(n))],
                schema=_FOUND,
            )


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """The words of each row with one space between them."""
    size = end - start + 1
    at = np.concatenate(([0], np.cumsum(size)))
    take = np.arange(at[-1]) + np.repeat(start - at[:-1], size)
    take[at[1:] - 1] = 0  # a space takes the place of what follows a word
    spaced = data[take] if len(data) else np.zeros(0, np.uint8)
    spaced[at[1:] - 1] = 0x20
    cut = np.searchsorted(row, np.arange(rows + 1))
    lo, hi = at[cut[:-1]], at[cut[1:]]
    return strings(spaced, lo, np.maximum(lo, hi - 1))


def find(docs: DataFrame, least: int = LEAST_WORDS, times: int = LEAST_TIMES, rewrite: Callable[[int, int], np.ndarray | None] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of docs (doc_id long, text string).

    Words are runs of bytes other than ASCII white space, compared as they are. runs has (start, length, period) in words,
    by start and then period: stretches of at least max(least, times * period) words with that smallest period which
    neither neighbour extends. They may overlap. collapsed is the text with one space between words and without the
    words that any run holds after its first period. rewrite(doc_id, n_words) may give other word numbers to read a
    document by, or None.

    Null and blank texts have no words, no runs and an empty collapsed text. A null doc_id stays, and its text isn't
    rewritten. Rows stay rows: repeated ones repeat. No rows in, no rows out. Other columns are ignored.
    """
    tune(docs.sparkSession)
    out = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_scan, least, times, rewrite), out)


def report(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of what find() returns.

    start, length and period are those of the longest run, ties broken by start and then period; null without a run.
    """
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    length, period = F.col("best_.length"), -F.col("best_.p")
    return found.withColumn("best_", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best_.s")).alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * best_.length div -best_.p").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

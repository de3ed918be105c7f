"""Packing documents into sequences of bounded length by Karmarkar-Karp multiway differencing.

A document's ids are cut into whole sequences and a rest; the rest is cut into parts of 1024 and 512 ids and a tail, so
that windows can be filled evenly. Rests are dealt into groups of bounded size, and each group is packed by itself:
partial partitions are merged, largest spread first, the fullest window of one with the emptiest of the other. If the
fullest window then exceeds the capacity, the group is packed again into one window more.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch, tune
from plumbline.llm.tokens import encoder

CAPACITY, END = 2048, 1
PARTS = (1024, 512)
#: A group has about so many pieces, a task so many groups up to so many tasks, and equal pieces go to groups by so many.
GROUP, TASK, MOST, COPIES = 2048, 8, 20_000, 64


def cuts(n: int, capacity: int = CAPACITY, parts: tuple[int, ...] = PARTS) -> list[int]:
    """The lengths of a document's pieces, in order: whole sequences, then parts of the rest, then its tail."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    for p in parts:
        if rest >= p:
            out.append(p)
            rest -= p
    return out + [rest] * (rest > 0)


def pieces(docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every document's pieces. A null text is only the end mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, ranks)
        for batch in batches:
            row, start, length, crc, total = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                raw = np.append(enc.ids(text or ""), np.uint32(END)).astype("<u4").tobytes()
                at = 0
                for n in cuts(len(raw) // 4):
                    row.append(i)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(raw[4 * at : 4 * (at + n)]))
                    total.append(len(raw) // 4)
                    at += n
            ids = batch.column(0).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in (start, length, crc, total))], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    tune(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def differencing(sizes: list[int], ways: int) -> list[tuple[int, object]]:
    """Karmarkar-Karp into `ways` windows: (sum, tree of item numbers) of each that isn't empty, smallest sum first.

    A partial partition lists its windows that are not empty, by rising sum; its spread is the largest sum less the
    smallest, which is zero while a window is empty.
    """
    heap = [(-s, i, [(s, i, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        over = max(0, len(a) + len(b) - ways)
        both = []
        for i in range(over):  # fullest of the one with emptiest of the other
            (x, _, t), (y, _, u) = a[over - 1 - i], b[i]
            both.append((x + y, serial, (t, u)))
            serial += 1
        merged = a[over:] + b[over:] + both
        merged.sort(key=lambda w: (w[0], w[1]))
        spread = merged[-1][0] - (merged[0][0] if len(merged) == ways else 0)
        heapq.heappush(heap, (-spread, serial, merged))
        serial += 1
    return [(s, tree) for s, _, tree in heap[0][2]] if heap else []


def leaves(tree: object) -> list[int]:
    """The item numbers of a tree of pairs."""
    out, stack = [], [tree]
    while stack:
        t = stack.pop()
        if isinstance(t, tuple):
            stack.extend(t)
        else:
            out.append(t)
    return out


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Item numbers of each window; no window holds more than the capacity. No size may exceed it."""
    if not sizes:
        return []
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = differencing(sizes, ways)
        if windows[-1][0] <= capacity:
            return [leaves(tree) for _, tree in windows]
        ways += 1


def sequences(docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): where every piece of every row lies.

    A row for each piece; the pieces of a row of docs cover its ids and the end mark once. A sequence holds at most
    2048 ids, without gaps from offset 0. A null or empty text is one piece, the end mark. Repeated rows are packed
    each by itself; no rows in, no rows out; other columns are ignored. Where a piece lies follows from the rows alone,
    however they are laid out: equal pieces are counted, and groups are told by a hash of a piece and a block of copies.
    """
    scratch = Scratch(docs.sparkSession, "pack")
    counted = scratch.cut(pieces(docs, vocabulary, ranks).groupBy(*PIECE).agg(F.count("*").alias("n")))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    groups = max(1, -(-total // GROUP))
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    blocks = blocks.withColumn("copies", F.least(F.lit(COPIES).cast("long"), F.col("n") - F.col("block") * COPIES)).drop("n")
    dealt = blocks.withColumn("group", F.pmod(F.xxhash64(*PIECE, "block"), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), *((c, "ascending") for c in (*PIECE, "block"))])
        table = table.take(pa.array(np.repeat(np.arange(table.num_rows), table["copies"].to_numpy())))
        length = table["length"].to_numpy()
        whole = int((length == CAPACITY).sum())
        seq, off = np.arange(len(length)), np.zeros(len(length), np.int64)
        for i, items in enumerate(pack(length[whole:].tolist())):
            items = whole + np.sort(np.array(items))
            seq[items] = whole + i
            off[items] = np.cumsum(length[items]) - length[items]
        first = table["group"][0].as_py() << 24
        return table.select(PIECE).append_column("sequence_id", pa.array(first + seq)).append_column("offset", pa.array(off))

    # a group costs time rather than bytes, which adaptive execution would go by
    spread = dealt.repartition(max(1, min(-(-groups // TASK), MOST)), "group")
    return spread.groupBy("group").applyInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


PIECE = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
COLUMNS = (*PIECE, "sequence_id", "offset")

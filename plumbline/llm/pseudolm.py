"""Masked pseudo-likelihood: a bidirectional window network predicts every token from both of its sides.

Tokens are lower-cased words. The corpus's most frequent words have codes of their own; all others share hashed ones.
The network (windownet) gives a token's code a probability given the codes of three words on either side. The words that
share a code divide its probability by their exact counts in the corpus, so that each word has one of its own. A
document's score is the sum over all its tokens of the logarithm of the predicted probability.

Scores are a function of the rows alone, however they are laid out. Documents are dealt into shards by a hash of id and
text, as many as the corpus's tokens ask for, and stand in each in the order of that hash. A round trains on another
part of every shard from the same weights, and the new weights are the mean over shards, summed in whole numbers, so
that neither partitions nor the order of tasks matter. Every token is a target once. Tasks hold the counts of words that
are frequent enough to be few; those of the rest are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch, keep_freed, tune
from plumbline.llm.text import lower, slices, words
from plumbline.llm.windownet import CODES, REACH, Learner, Network, joined, parts

#: Words with a code of their own; all others are hashed into the rest of the codes.
OWN = CODES - 768
#: Tasks hold the counts of words that make up at least one in HEAVY of all tokens: HEAVY of them at most.
HEAVY = 1 << 19
#: Tokens of a shard, of which a document without tokens counts as some.
SHARD, BARE = 1 << 18, 16
#: Rounds, each on another part of every shard; tokens of a step; step width; tokens that are scored at once.
ROUNDS, BATCH, RATE, AT_ONCE = 3, 4096, 0.2, 1 << 12
#: Weights are summed as whole multiples of 2**-FINE, logarithms of counts as those of 2**-LOG_FINE.
FINE, LOG_FINE = 20, 32
#: Weights travel in pieces of so many; so many tasks' sums are added up at first.
PIECE, FAN = 1 << 13, 64


def hashed(h: np.ndarray) -> np.ndarray:
    """The shared codes of word hashes."""
    return OWN + (h >> np.uint64(40)).astype(np.int64) % (CODES - OWN)


def counted(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word's hash occurs in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(0)):
                k, n = np.unique(words(lower(s.data), s.offsets).hash, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = OWN) -> np.ndarray:
    """Hashes of the most frequent words, ties by hash."""
    top = counts.orderBy(F.desc("n"), "word").limit(most).toArrow()
    return top["word"].to_numpy().view(np.uint64)


def _logs(n: np.ndarray) -> np.ndarray:
    """Logarithms as whole numbers, whose sums don't depend on their order."""
    return np.rint(np.log(n.astype(np.float64)) * (1 << LOG_FINE)).astype(np.int64)


@dataclass
class Vocabulary:
    """The words that tasks know: sorted hashes, codes and whole logarithms of counts; and how often each code occurs."""

    words: np.ndarray
    codes: np.ndarray
    logs: np.ndarray
    by_code: np.ndarray

    @staticmethod
    def of(counts: DataFrame) -> Vocabulary:
        """counts: a written table of (word, n)."""
        own = frequent(counts)
        rank = np.argsort(own)
        ranked = own[rank]

        def code(h: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(ranked, h), max(0, len(ranked) - 1))
            return np.where(ranked[at] == h, rank[at], hashed(h)) if len(ranked) else hashed(h)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(code(batch.column(0).to_numpy().view(np.uint64))), batch.column(1)], names=["code", "n"])

        by = counts.select("word", "n").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
        by_code = np.zeros(CODES, np.int64)
        by_code[by["code"].to_numpy()] = by["n"].to_numpy()
        held = counts.filter(F.col("n") >= F.lit(int(by_code.sum()) / HEAVY)).toArrow()
        word, n = held["word"].to_numpy().view(np.uint64), held["n"].to_numpy()
        rare = np.flatnonzero(~np.isin(own, word))  # of the most frequent, in a corpus of words that are all rare
        word, n = np.concatenate((word, own[rare])), np.concatenate((n, by_code[rare]))
        order = np.argsort(word)
        return Vocabulary(word[order], code(word[order]), _logs(n[order]), by_code)

    @cached_property
    def _begins(self) -> tuple[np.uint64, np.ndarray]:
        """A shift, and where the words begin that are no less than each number that it leaves, put back: hashes are
        spread evenly, so that few words lie between two such places."""
        bits = len(self.words).bit_length()
        shift = np.uint64(64 - bits)
        return shift, np.searchsorted(self.words, np.arange(1 << bits, dtype=np.uint64) << shift).astype(np.int32)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """For each hash the place of the first word that is no less, or of the last word, as by binary search."""
        shift, begins = self._begins
        last = len(self.words) - 1
        at = np.minimum(begins[(h >> shift).astype(np.int64)], last)
        less = np.flatnonzero((self.words[at] < h) & (at < last))
        while len(less):
            at[less] += 1
            less = less[(self.words[at[less]] < h[less]) & (at[less] < last)]
        return at

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For word hashes: codes; the whole logarithm of each word's share of its code, without the counts of those not held; which those are."""
        whole = _logs(np.maximum(self.by_code, 1))
        code = hashed(h)
        if not len(self.words):
            return code.astype(np.uint16), -whole[code], np.ones(len(h), dtype=bool)
        at = self._find(h)
        held = self.words[at] == h
        code = np.where(held, self.codes[at], code)
        return code.astype(np.uint16), np.where(held, self.logs[at], 0) - whole[code], ~held


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, h, codes, within, rest) of each row: a hash of its text, its words as little-endian 16-bit codes, the sum
    of the logarithms of their shares of their codes, and the words whose counts that lacks, as often as they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1)):
                w = words(lower(s.data), s.offsets)
                code, part, lacks = vocabulary.look(w.hash)
                raw, first = code.astype("<u2").tobytes(), (2 * w.first).tolist()
                before = np.concatenate(([0], np.cumsum(part)))
                at = np.concatenate(([0], np.cumsum(lacks)))[w.first]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(s.lo, s.hi - s.lo),
                        batch.column(2).slice(s.lo, s.hi - s.lo),
                        pa.array([raw[a:b] for a, b in zip(first, first[1:])], pa.binary()),
                        pa.array(before[w.first[1:]] - before[w.first[:-1]]),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(w.hash[lacks].view(np.int64))),
                    ],
                    names=["doc_id", "h", "codes", "within", "rest"],
                )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("h"))
    return rows.mapInArrow(run, "doc_id long, h long, codes binary, within long, rest array<long>")


def coded(docs: DataFrame, vocabulary: Vocabulary, scratch: Scratch) -> DataFrame:
    """A written table of encode() with a number for each row."""
    return scratch.cut(encode(docs, vocabulary).withColumn("row", F.monotonically_increasing_id()))


def sharded(rows: DataFrame, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """A written table (shard, part, rows, doc_ids, within, sizes, codes): documents dealt into shards, each in parts.

    Shards and the order in them follow from a hash of id, text and, for equal rows, a count, so equal rows spread too.
    """
    size = rows.agg(F.coalesce(F.sum(F.octet_length("codes")), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    shards = max(1, -(-(size["bytes"] // 2 + BARE * size["n"]) // SHARD))
    slim = rows.select("doc_id", "h", "row", "codes", "within").withColumn("copy", F.lit(1).cast("long"))
    again = scratch.cut(rows.groupBy("doc_id", "h").agg(F.count("*").alias("n"), F.min("row").alias("of")).filter("n > 1").select(F.col("doc_id").alias("d_"), F.col("h").alias("h_"), "n", "of"))
    if not again.isEmpty():
        single = slim.join(again.select("d_", "h_"), F.col("doc_id").eqNullSafe(F.col("d_")) & (F.col("h") == F.col("h_")), "left_anti")
        first = slim.join(again.select("of", "n"), F.col("row") == F.col("of"))
        slim = single.unionByName(first.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select(*slim.columns))
    placed = slim.withColumn("order", F.xxhash64("doc_id", "h", "copy")).withColumn("shard", F.pmod("order", F.lit(shards)))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("order", "doc_id", "h", "copy")])
        codes = table["codes"].to_pylist()
        tokens = np.array([len(c) // 2 for c in codes], dtype=np.int64)
        part = (np.cumsum(tokens) - tokens) * rounds // max(1, int(tokens.sum()))
        out = []
        for k in range(rounds):
            lo, hi = (int(x) for x in np.searchsorted(part, (k, k + 1)))
            if hi > lo:
                column = lambda c: table[c].slice(lo, hi - lo).to_pylist()  # noqa: B023, E731
                out.append({"shard": table["shard"][0].as_py(), "part": k, "rows": column("row"), "doc_ids": column("doc_id"), "within": column("within"), "sizes": tokens[lo:hi].tolist(), "codes": b"".join(codes[lo:hi])})
        return pa.Table.from_pylist(out, _SHARD)

    return scratch.cut(placed.groupBy("shard").applyInArrow(pack, "shard long, part int, rows array<long>, doc_ids array<long>, within array<long>, sizes array<long>, codes binary"))


_LONGS = pa.list_(pa.int64())
_SHARD = pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("rows", _LONGS), ("doc_ids", _LONGS), ("within", _LONGS), ("sizes", _LONGS), ("codes", pa.binary())])


def _documents(sizes: pa.Scalar, codes: pa.Scalar) -> tuple[np.ndarray, list[np.ndarray]]:
    size = np.array(sizes.as_py(), dtype=np.int64)
    ends = np.cumsum(size)
    return size, np.split(np.frombuffer(codes.as_py(), dtype="<u2"), ends[:-1])


def _round(shards: DataFrame, flat: np.ndarray, k: int) -> np.ndarray:
    """The mean, by steps, of the weights to which part k of each shard leads from `flat`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        total, steps = np.zeros(Network.SIZE, np.int64), 0
        for batch in batches:
            for sizes, codes in zip(batch.column(0), batch.column(1)):
                learner = Learner(Network.of(flat), RATE)
                own = sum(map(learner.step, parts(joined(_documents(sizes, codes)[1])[0], BATCH)))
                total += np.rint(learner.net.flat().astype(np.float64) * (1 << FINE)).astype(np.int64) * own
                steps += own
        if steps:
            task = TaskContext.get().partitionId() // FAN
            for i in range(0, Network.SIZE, PIECE):
                yield pa.RecordBatch.from_pylist([{"piece": i, "task": task, "steps": steps, "sums": total[i : i + PIECE].tobytes()}], _SUMS)

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(len(table["sums"][0].as_py()) // 8, np.int64)
        for x in table["sums"]:
            total += np.frombuffer(x.as_py(), dtype=np.int64)
        return pa.Table.from_pylist([{"piece": table["piece"][0].as_py(), "task": 0, "steps": sum(table["steps"].to_pylist()), "sums": total.tobytes()}], _SUMS)

    schema = "piece long, task long, steps long, sums binary"
    sent = shards.filter(F.col("part") == k).select("sizes", "codes").mapInArrow(run, schema)
    found = sent.groupBy("piece", "task").applyInArrow(add, schema).groupBy("piece").applyInArrow(add, schema).collect()
    out = flat.copy()
    for r in found:
        sums = np.frombuffer(r["sums"], dtype=np.int64)
        out[r["piece"] : r["piece"] + len(sums)] = sums / r["steps"] / (1 << FINE)
    return out


_SUMS = pa.schema([("piece", pa.int64()), ("task", pa.int64()), ("steps", pa.int64()), ("sums", pa.binary())])


def train(shards: DataFrame, by_code: np.ndarray, rounds: int = ROUNDS) -> Network:
    """A network for which every token of a table of sharded() has been a target once; by_code: how often codes occur."""
    flat = Network.begin(by_code).flat()
    for k in range(rounds):
        flat = _round(shards, flat, k)
    return Network.of(flat)


def score(rows: DataFrame, shards: DataFrame, counts: DataFrame, net: Network) -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob) for each row of a table of coded() and what sharded() made of it."""
    flat = net.flat()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        own = Network.of(flat)
        for batch in batches:
            for ids, doc_ids, within, sizes, codes in zip(*batch.columns):
                size, docs = _documents(sizes, codes)
                stream, first = joined(docs)
                lp = np.concatenate([np.zeros(0, np.float32), *(own.log_probs(x) for x in parts(stream, AT_ONCE))])
                before = np.concatenate(([0.0], np.cumsum(lp.astype(np.float64))))
                at = first - REACH
                yield pa.RecordBatch.from_arrays([pa.array(ids.as_py(), pa.int64()), pa.array(within.as_py(), pa.int64()), pa.array(doc_ids.as_py(), pa.int64()), pa.array(size), pa.array(before[at + size] - before[at])], names=["row", "within", "doc_id", "n_tokens", "log_prob"])

    found = shards.select("rows", "doc_ids", "within", "sizes", "codes").mapInArrow(run, "row long, within long, doc_id long, n_tokens long, log_prob double")
    found = found.join(_rest(rows, counts), F.col("row") == F.col("r_"), "left")
    total = F.col("log_prob") + (F.col("within") + F.coalesce("more", F.lit(0))) / (1 << LOG_FINE)
    return found.select("doc_id", "n_tokens", total.alias("log_prob"), _mean(total))


def _mean(total: Column) -> Column:
    return F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_prob")


def _rest(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(r_, more): for each row, the sum of the logarithms of the counts of the words in `rest`, where it isn't zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_logs(batch.column(1).to_numpy()))], names=["w_", "log"])

    logs = counts.filter("n > 1").select("word", "n").mapInArrow(run, "w_ long, log long")
    found = rows.select("row", F.explode("rest").alias("word")).join(logs, F.col("word") == F.col("w_"))
    return found.groupBy(F.col("row").alias("r_")).agg(F.sum("log").alias("more"))


def pseudo_likelihood(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob), a row for each row of docs (doc_id long, text string).

    log_prob sums the log-probability of every token given up to three words on either side, over the whole text: that
    of its code in this context, and its word's share of the code's tokens in the corpus. Null and blank texts have no
    tokens, a sum of 0 and a null mean. Repeated rows are trained on as often as they occur and each have a row; no rows
    in, no rows out; other columns are ignored. The layout of the rows makes no difference.
    """
    tune(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "lm")
    counts = scratch.cut(counted(docs))
    vocabulary = Vocabulary.of(counts)
    rows = coded(docs, vocabulary, scratch)
    shards = sharded(rows, scratch, rounds)
    return score(rows, shards, counts, train(shards, vocabulary.by_code, rounds))


def held_out(docs: DataFrame, share: int = 5, rounds: int = ROUNDS) -> DataFrame:
    """(n_tokens, mean_log_prob, unigram): one document in `share`, told by a hash of its text, under what is learned from the others.

    unigram gives every word its share of all tokens learned from, contexts aside. Words that are in none of the documents
    learned from count as seen once in their code, for both.
    """
    tune(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "lm-trial")
    apart = F.coalesce(F.pmod(F.xxhash64(F.col("text").cast("string"), F.lit(1)), F.lit(share)) == 0, F.lit(False))
    others, own = docs.filter(~apart), docs.filter(apart)
    counts = scratch.cut(counted(others))
    vocabulary = Vocabulary.of(counts)
    net = train(sharded(coded(others, vocabulary, scratch), scratch, rounds), vocabulary.by_code, rounds)
    rows = coded(own, vocabulary, scratch)
    logs = np.log((vocabulary.by_code + 0.5) / (vocabulary.by_code.sum() + 0.5 * CODES))

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_codes = [float(logs[np.frombuffer(x.as_py(), dtype="<u2")].sum()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(of_codes, pa.float64()), batch.column(2)], names=["u_", "of_codes", "within"])

    base = rows.select("row", "codes", "within").mapInArrow(plain, "u_ long, of_codes double, within long").join(_rest(rows, counts), F.col("u_") == F.col("r_"), "left")
    base = base.agg(F.sum(F.col("of_codes") + (F.col("within") + F.coalesce("more", F.lit(0))) / (1 << LOG_FINE)).alias("base"))
    found = score(rows, sharded(rows, scratch, rounds), counts, net).agg(F.sum("n_tokens").alias("n_tokens"), F.sum("log_prob").alias("total"))
    return found.crossJoin(base).select("n_tokens", (F.col("total") / F.col("n_tokens")).alias("mean_log_prob"), (F.col("base") / F.col("n_tokens")).alias("unigram"))  # one row each

"""How far the sources of a language are apart in the words they use: sorted streams of term counts.

1. A task counts the terms of its documents by (lang, term, source) and writes partial counts, so a term that stands in
   every document gives a few rows a task.
2. Partial counts are dealt by ranges of (lang, term, source, document) and sorted within them. A scan by run length
   yields each term's document frequency and its count for each source. Ranges may cut a run: the first and the last run
   of a range are pieces, which an aggregation of two rows a range puts together.
3. Runs of terms that are frequent enough meet the totals of their language's sources and give partial distances of the
   source pairs and the terms that a source favours. Only sums of pairs and the first ranks are shuffled.

All arithmetic is on whole numbers: shares are floored billionths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm.common import GOLDEN, Scratch, mix64, tune
from plumbline.llm.text import LETTERS, lower, slices, strings, words

#: A term is kept in a language if at least so many of its documents hold it.
LEAST_DOCS = 30
#: Shares are in units of one in SCALE, and every count is raised by SMOOTH.
SCALE, SMOOTH = 10**9, 5
#: Ranks of favoured terms that are reported.
TOP = 50
#: A task holds at most about so many partial counts before it gives them out.
HELD = 3 << 18
#: Rows of an Arrow batch that is given out.
OUT = 1 << 16
#: Distances of so many sources at most are summed within a task; of more, within a batch.
DENSE = 1024
#: The sources' totals are broadcast while there are at most so many.
FEW = 1 << 16
#: Counts above this are multiplied as Python integers.
WIDE = 2**63 // SCALE - SMOOTH - 1

_COUNTS = pa.schema([("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("document", pa.int64()), ("docs", pa.int64()), ("n", pa.int64())])
_RUNS = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("piece", pa.bool_())])
_PARTS = pa.schema([("part", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean", pa.list_(pa.string()): "array<string>", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


class _Held:
    """Partial counts of a task: key of (group, term), least document, documents, occurrences, group and term."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.terms: list[pa.Array] = []
        self.n = 0

    def add(self, columns: tuple[np.ndarray, ...], terms: pa.Array) -> None:
        self.parts.append(columns)
        self.terms.append(terms)
        self.n += len(terms)

    def merge(self) -> None:
        if len(self.parts) < 2:
            return
        key, document, docs, n, group = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        first = order[at]
        columns = (key[at], np.minimum.reduceat(document[order], at), np.add.reduceat(docs[order], at), np.add.reduceat(n[order], at), group[first])
        terms = pa.concat_arrays(self.terms).take(pa.array(first))
        self.parts, self.terms, self.n = [columns], [terms], len(at)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the documents of a task: (lang, source, doc_id, text) to _COUNTS."""
    names: dict[tuple[str, str], int] = {}
    held = _Held()

    def given() -> Iterator[pa.RecordBatch]:
        langs, sources = (pa.array([k[i] for k in names], pa.string()) for i in (0, 1))
        for (_, document, docs, n, group), terms in zip(held.parts, held.terms, strict=True):
            for lo in range(0, len(terms), OUT):
                some = slice(lo, lo + OUT)
                g = pa.array(group[some])
                yield pa.RecordBatch.from_arrays([langs.take(g), terms[some].cast(pa.string()), sources.take(g), pa.array(document[some]), pa.array(docs[some]), pa.array(n[some])], schema=_COUNTS)

    for batch in batches:
        pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        groups = np.array([names.setdefault(p, len(names)) for p in pairs], dtype=np.int64)
        ids = batch.column(2).fill_null(np.iinfo(np.int64).min).to_numpy()
        for s in slices(batch.column(3)):
            data = lower(s.data)
            w = words(data, s.offsets, LETTERS)
            if not len(w.hash):
                continue
            row = np.repeat(np.arange(s.lo, s.hi), np.diff(w.first))
            with np.errstate(over="ignore"):
                key = mix64(w.hash + (groups[row] + 1).astype(np.uint64) * GOLDEN)
            order = np.argsort(key, kind="stable")  # words come by row, and so do those of a key
            key, row = key[order], row[order]
            new = np.concatenate(([True], key[1:] != key[:-1]))
            at = np.flatnonzero(new)
            own = np.concatenate(([True], row[1:] != row[:-1])) | new
            n = np.diff(np.concatenate((at, [len(key)])))
            columns = (key[at], np.minimum.reduceat(ids[row], at), np.add.reduceat(own.astype(np.int64), at), n, groups[row[at]])
            held.add(columns, strings(data, w.start[order[at]], w.end[order[at]]))
            if held.n > 2 * HELD:
                held.merge()
                if held.n > HELD:
                    yield from given()
                    held = _Held()
    held.merge()
    yield from given()


def _changes(*columns: pa.Array) -> np.ndarray:
    """Which rows differ from the row before in one of the columns; the first does."""
    n = len(columns[0])
    out = np.zeros(n, dtype=bool)
    out[:1] = True
    for c in columns:
        out[1:] |= pc.not_equal(c[1:], c[: n - 1]).to_numpy(zero_copy_only=False)
    return out


def _scan(least: int):
    """Run-length scan of a sorted range of partial counts: rows of _RUNS, one for each (lang, term)."""

    def runs(t: pa.Table, first_is_piece: bool, last_is_piece: bool) -> pa.RecordBatch:
        lang, term, source = (t[c].combine_chunks() for c in ("lang", "term", "source"))
        top = _changes(lang, term)
        at = np.flatnonzero(top)
        sub = np.flatnonzero(top | _changes(source))
        docs, n = t["docs"].to_numpy(), t["n"].to_numpy()
        df = np.add.reduceat(docs, at)
        piece = np.zeros(len(at), dtype=bool)
        if first_is_piece:
            piece[0] = True
        if last_is_piece:
            piece[-1] = True
        ends = np.searchsorted(sub, np.concatenate((at, [len(docs)])))
        bounds = pa.array(ends, pa.int32())
        out = pa.RecordBatch.from_arrays(
            [lang.take(at), term.take(at), pa.array(df), pa.ListArray.from_arrays(bounds, source.take(sub)), pa.ListArray.from_arrays(bounds, pa.array(np.add.reduceat(n, sub))), pa.array(piece)],
            schema=_RUNS,
        )
        return out.filter(pa.array(piece | (df >= least)))

    def squeezed(t: pa.Table) -> pa.Table:
        """The rows of one (lang, term), one a source."""
        at = np.flatnonzero(_changes(t["source"].combine_chunks()))
        head = t.take(at)
        for c in ("docs", "n"):
            head = head.set_column(head.schema.get_field_index(c), c, pa.array(np.add.reduceat(t[c].to_numpy(), at)))
        return head

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, begun = None, False
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if open_ is None else pa.concat_tables([open_, t])
            if not len(t):
                continue
            last = int(np.flatnonzero(_changes(t["lang"].combine_chunks(), t["term"].combine_chunks()))[-1])
            if last:
                yield runs(t.slice(0, last), not begun, False)
                begun = True
            open_ = squeezed(t.slice(last))
        if open_ is not None:
            yield runs(open_, not begun, True)

    return run


def term_runs(docs: DataFrame, scratch: Scratch, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, sources, counts) for each term that at least so many documents of its lang hold.

    sources are those in which the term occurs, in order, and counts its occurrences there.
    """
    partial = scratch.cut(docs.mapInArrow(_count, _ddl(_COUNTS)))
    key = ["lang", "term", "source", "document"]
    runs = scratch.cut(partial.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(_scan(least), _ddl(_RUNS)))
    scratch.drop(partial)
    pieces = runs.filter("piece")
    one = pieces.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", "term", "x.sources").agg(F.sum("x.counts").alias("counts"))
    one = one.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("sources", "counts"))).alias("x"))
    often = pieces.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least)
    joined = one.join(often, ["lang", "term"]).select("lang", "term", F.col("x.sources").alias("sources"), F.col("x.counts").alias("counts"))
    return scratch.cut(runs.filter("not piece").select("lang", "term", "sources", "counts").union(joined))


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTH) / total), exact."""
    if counts.size and counts.max() > WIDE:
        return (1 + SCALE * (counts.astype(object) + SMOOTH) // totals.astype(object)).astype(np.int64)
    return 1 + SCALE * (counts + SMOOTH) // totals


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial pairs and favoured terms of runs that carry their lang's sources (names, totals) and total."""
    sums: dict[str, tuple[list[str], np.ndarray]] = {}

    def pairs(lang: str, names: list[str], matrix: np.ndarray) -> pa.RecordBatch:
        a, b = np.triu_indices(len(names), 1)
        label = pa.array(names, pa.string())
        return pa.RecordBatch.from_arrays([pa.array(["pair"] * len(a)), pa.array([lang] * len(a)), label.take(a), label.take(b), pa.array(matrix[a, b])], schema=_PARTS)

    for batch in batches:
        of = batch.column("lang").to_pylist()
        cuts = [i for i in range(len(of)) if not i or of[i] != of[i - 1]] + [len(of)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            lang, names = of[lo], batch.column("names")[lo].as_py()
            totals = np.array(batch.column("totals")[lo].as_py(), dtype=np.int64)
            whole, size = np.int64(batch.column("total")[lo].as_py()), len(names)
            if size <= DENSE:
                acc = sums.setdefault(lang, (names, np.zeros((size, size), np.int64)))[1]
            else:
                acc = np.zeros((size, size), np.int64)
            place = {x: i for i, x in enumerate(names)}
            step = max(1, (1 << 20) // size)
            for at in range(lo, hi, step):
                part = batch.slice(at, min(step, hi - at))
                lists, numbers = part.column("sources"), part.column("counts")
                row = np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy())
                column = np.array([place[x] for x in lists.flatten().to_pylist()], dtype=np.int64)
                counts = np.zeros((len(part), size), np.int64)
                counts[row, column] = numbers.flatten().to_numpy()
                p = _shares(counts, totals[None, :])
                for i in range(size - 1):
                    acc[i, i + 1 :] += np.abs(p[:, i + 1 :] - p[:, i : i + 1]).sum(axis=0)
                more = p - _shares(counts.sum(axis=1), whole)[:, None]
                r, c = np.nonzero((counts > 0) & (more > 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["term"] * len(r)), pa.array([lang] * len(r)), pa.array(names, pa.string()).take(c), part.column("term").take(r), pa.array(more[r, c])], schema=_PARTS
                )
            if size > DENSE:
                yield pairs(lang, names, acc)
    for lang, (names, matrix) in sums.items():
        yield pairs(lang, names, matrix)


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): distances between sources, and the terms each favours.

    docs has doc_id (long), text, lang and source (strings); each row is a document, repeated rows are several. Null
    text, lang and source are ''. Terms are runs of letters, A-Z in lower case, all characters beyond ASCII being letters.
    A language keeps the terms in at least `least` of its documents. Part `pair` has a row for every other source of the
    language, part `term` the first `top` kept terms that are more frequent in the source than in the language; ranks
    are by value from the greatest and then by the item's bytes. A source without terms has equal shares of all kept
    ones. A language without kept terms has distances of 0. No rows in, no rows out. Other columns are ignored.

    A language's sources are held together, S numbers a run, since S * (S - 1) distances are the result.
    """
    spark = docs.sparkSession
    tune(spark)
    scratch = Scratch(spark, "divergence")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text("lang").alias("lang"), text("source").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), text("text").alias("text"))
    kept = term_runs(rows, scratch, least)
    totals = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n"))
    groups = scratch.cut(rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")))
    terms = scratch.cut(kept.groupBy("lang").agg(F.count("*").alias("v")))
    of = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("g"), F.sum("n").alias("all"))
    extra = SMOOTH * F.col("v")
    langs = of.join(terms, "lang").select("lang", F.col("g.source").alias("names"), F.transform("g.n", lambda n: n + extra).alias("totals"), (F.col("all") + extra).alias("total"))
    langs = F.broadcast(langs) if groups.count() <= FEW else langs
    found = scratch.cut(kept.join(langs, "lang").mapInArrow(_compare, _ddl(_PARTS)))
    a, b = groups.select("lang", F.col("source").alias("a")), groups.select("lang", F.col("source").alias("b"))
    half = found.filter("part = 'pair'").groupBy("lang", F.col("source").alias("a"), F.col("item").alias("b")).agg(F.sum("value").alias("value"))
    both = half.union(half.select("lang", "b", "a", "value"))
    pairs = a.join(b, "lang").filter("a <> b").join(both, ["lang", "a", "b"], "left").select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), F.coalesce("value", F.lit(0)).alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    favoured = found.filter("part = 'term'").select("lang", "source", "part", "item", "value").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.union(favoured)

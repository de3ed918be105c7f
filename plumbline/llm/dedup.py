"""Near-duplicate documents: SuperMinHash, banding, exact verification and union-find.

The steps, and why none of them depends on how large a group of copies is:

1. One scan makes each document's shingle-set size, set fingerprint and band keys.
2. Documents with equal sets collapse into classes by a partial aggregation; only a class's first document goes on.
3. Band keys that two classes share make a star around the bucket's least document, never the pairs of a bucket.
4. Components of the stars are clusters: no link crosses from one cluster to another, but for what banding misses.
5. Within a cluster links are confirmed on full shingle sets, in blocks of bounded size. A task keeps a union-find
   forest and returns only links that join two trees. A large cluster first meets one block of pivots; after that only
   the documents outside its largest component are compared with the rest, block by block.
6. Components of the confirmed links name each class, and each row takes its class's component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch, tune, unused
from plumbline.llm.components import components
from plumbline.llm.minhash import SHINGLE, band_keys, fingerprints, shingles, signatures
from plumbline.llm.text import lower, slices, words

#: 24 bands of 5 slots: two sets of similarity 0.85 share no band once in 10^6, of 0.8 once in 14,000.
BANDS, ROWS = 24, 5
#: A block of a cluster holds about so many documents and so many shingles.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 1 << 19
#: Row numbers to leave out are broadcast if they are at most so many; more are joined.
FEW = 1 << 20


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, fp_a, fp_b, keys) for each row of docs (doc_id long, text string).

    Null and blank texts have n_shingles 0 and no keys. Rows stay rows: repeated ones repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, fa, fb, keys = [], [], [], []
            for s in slices(batch.column(1)):
                values, at = shingles(words(lower(s.data), s.offsets), size)
                a, b = fingerprints(values, at)
                counts.append(np.diff(at))
                fa.append(a)
                fb.append(b)
                keys.append(band_keys(signatures(values, at, bands * rows), bands, rows))
            if not counts:
                continue
            n = np.concatenate(counts)
            width = pa.array(np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0)))), pa.int32())
            kept = np.concatenate(keys)[n > 0].ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(np.concatenate(fa)), pa.array(np.concatenate(fb)), pa.ListArray.from_arrays(width, pa.array(kept))],
                names=["doc_id", "n_shingles", "fp_a", "fp_b", "keys"],
            )

    out = "doc_id long, n_shingles long, fp_a long, fp_b long, keys array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, out)


def _sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(node, shingles): each document's sorted distinct shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1)):
                values, at = shingles(words(lower(s.data), s.offsets), size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.lo, s.hi - s.lo), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.view(np.int64)))],
                    names=["node", "shingles"],
                )

    return docs.mapInArrow(run, "node long, shingles array<long>")


class Forest:
    """Union-find over row numbers, with path halving."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _spanning_links(nodes: np.ndarray, sets: list[np.ndarray], labels: np.ndarray, queries: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links of query rows with any rows at a similarity of num/den or more, but only such as join two trees.

    labels: rows of one label are joined already. All row pairs with a query are compared on whole sets, except
    those that are in one tree by then and those whose sizes rule out the similarity.
    """
    n = len(nodes)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    at = np.concatenate(([0], np.cumsum(sizes)))
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1].reshape(-1)
    forest, links, seen = Forest(n), [], {}
    for i, lab in enumerate(labels):
        if lab in seen:
            forest.join(seen[lab], i)
        else:
            seen[lab] = i
    mark = np.zeros(int(ids.max()) + 1, dtype=np.int64)
    done = np.zeros(n, dtype=bool)
    for q in np.flatnonzero(queries):
        done[q] = True
        own = ids[at[q] : at[q + 1]]
        mark[own] = 1
        shared = np.add.reduceat(mark[ids], at[:-1])
        mark[own] = 0
        for r in np.flatnonzero((den * shared >= num * (sizes + sizes[q] - shared)) & ~done):
            if forest.join(int(q), int(r)) and nodes[q] != nodes[r]:
                links.append((int(nodes[q]), int(nodes[r])))
    return links


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _verifier(num: int, den: int):
    """Confirms the links of one group of rows: node, version, shingles, label, ask (row is a query)."""

    def run(table: pa.Table) -> pa.Table:
        node, version, label = (table[c].to_numpy() for c in ("node", "version", "label"))
        ask = table["ask"].to_numpy(zero_copy_only=False)
        order = np.lexsort((version, node, ~ask))
        _, first = np.unique(np.stack((node[order], version[order])), axis=1, return_index=True)
        rows = order[np.sort(first)]
        if len(rows) < 2:
            return _LINKS.empty_table()
        lists = table["shingles"].combine_chunks()
        values, at = lists.values.to_numpy(), lists.offsets.to_numpy()
        links = _spanning_links(node[rows], [values[at[i] : at[i + 1]] for i in rows], label[rows], ask[rows], num, den)
        return pa.table([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], schema=_LINKS)

    return run


def near_components(docs: DataFrame, num: int = 85, den: int = 100, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of docs (doc_id long, text string).

    Two documents are linked when den * |A and B| >= num * |A or B| over their sets of lower-cased `size`-word
    shingles. component_id is the least doc_id that can be reached over links, kept whether it is the row's own.

    Null or blank text: n_shingles 0, linked with nothing, kept. Fewer words than `size`: the sequence is the one shingle.
    Rows that share a doc_id are one document's versions and share a component. A null doc_id has component_id
    the least doc_id with an equal set, else null, and is not kept. No rows in, no rows out. Other columns are ignored.
    """
    spark = docs.sparkSession
    tune(spark)
    scratch = Scratch(spark, "near")
    rows_ = scratch.cut(sketch(docs, bands, rows, size))
    classes = scratch.cut(
        rows_.filter("n_shingles > 0")
        .groupBy("fp_a", "fp_b", "n_shingles")
        .agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys"))
    )
    band = classes.filter("node is not null").select("node", "n_shingles", F.posexplode("keys").alias("band", "key"))
    buckets = scratch.cut(band.groupBy("band", "key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).filter("pivot < last").drop("last"))
    stars = band.drop("n_shingles").join(buckets, ["band", "key"]).filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    clusters = components(stars, scratch)
    links = _confirm(docs, clusters, scratch, num, den, size)
    links = links.union(_versions(rows_, classes, scratch))
    named = components(links, scratch)
    label = scratch.cut(
        classes.drop("keys")
        .join(named.withColumnRenamed("node", "n_"), F.col("node") == F.col("n_"), "left")
        .select("fp_a", "fp_b", "n_shingles", F.coalesce("label", "node").alias("component_id"))
    )
    out = rows_.drop("keys").join(label, ["fp_a", "fp_b", "n_shingles"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept"))


def _versions(rows: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): classes that are linked because one doc_id has rows of each."""
    own = rows.filter("n_shingles > 0 and doc_id is not null")
    twice = scratch.cut(own.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("d_")))
    named = own.join(twice, F.col("doc_id") == F.col("d_"), "left_semi").join(classes.drop("keys"), ["fp_a", "fp_b", "n_shingles"]).select("doc_id", "node").distinct()
    least = named.groupBy("doc_id").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
    return named.join(least.select(F.col("doc_id").alias("e_"), "least"), F.col("doc_id") == F.col("e_")).filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))


def _confirm(docs: DataFrame, clusters: DataFrame, scratch: Scratch, num: int, den: int, size: int) -> DataFrame:
    """(a, b): confirmed links that connect what is connected within each cluster."""
    wanted = clusters.select(F.col("node").alias("n_"), F.col("label").alias("cluster"))
    text = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    # a doc_id may come with several texts: each is compared
    held = text.join(wanted, F.col("node") == F.col("n_"), "left_semi").withColumn("v_", F.xxhash64("text")).dropDuplicates(["node", "v_"]).select("node", "text")
    sets = scratch.cut(_sets(held, size).join(wanted, F.col("node") == F.col("n_")).drop("n_").withColumn("version", F.xxhash64("shingles")))
    shape = sets.groupBy("cluster").agg(F.count("*").alias("docs"), F.sum(F.size("shingles")).alias("total"))
    blocks = F.ceil(F.greatest(F.col("docs") / BLOCK_DOCS, F.col("total") / BLOCK_SHINGLES)).cast("int")
    shape = scratch.cut(shape.select(F.col("cluster").alias("c_"), blocks.alias("blocks")))
    placed = sets.join(shape, F.col("cluster") == F.col("c_")).drop("c_").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    verify, out = _verifier(num, den), "a long, b long"
    # round one: every block with itself, and with block 0 as the cluster's pivots
    pivots = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = placed.select("cluster", "node", "version", "shingles", F.col("node").alias("label"), F.explode(pivots).alias("with"), F.lit(True).alias("ask"))
    one = scratch.cut(first.groupBy("cluster", "with").applyInArrow(verify, out))
    large = scratch.cut(placed.filter("blocks > 1"))
    if large.isEmpty():
        scratch.drop(sets, large)
        return one
    # round two, for large clusters: all that is outside the largest component, against everything
    named = components(one, scratch).select(F.col("node").alias("n_"), "label")
    known = scratch.cut(large.join(named, F.col("node") == F.col("n_"), "left").drop("n_").withColumn("label", F.coalesce("label", "node")))
    counts = known.groupBy("cluster", "label").count().groupBy("cluster").agg(F.max_by("label", F.struct("count", F.negative("label"))).alias("main"), F.count("*").alias("parts"))
    known = scratch.cut(known.join(scratch.cut(counts.filter("parts > 1").withColumnRenamed("cluster", "c_")), F.col("cluster") == F.col("c_")).drop("c_"))
    asks = scratch.cut(known.filter("label <> main").groupBy("cluster", "block").count().groupBy(F.col("cluster").alias("c_")).agg(F.collect_set("block").alias("ask_blocks")))
    all_rows = known.join(asks, F.col("cluster") == F.col("c_")).drop("c_", "main", "parts")
    ranks = F.transform("ask_blocks", lambda b: F.struct(b.alias("q"), F.col("block").alias("r"), F.lit(False).alias("ask")))
    as_rows = all_rows.select("cluster", "node", "version", "shingles", "label", F.explode(ranks).alias("p"))
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.col("block").alias("q"), b.alias("r"), F.lit(True).alias("ask")))
    as_asks = known.filter("label <> main").select("cluster", "node", "version", "shingles", "label", F.explode(every).alias("p"))
    pairs = as_rows.union(as_asks).select("cluster", "node", "version", "shingles", "label", "p.*")
    two = scratch.cut(pairs.groupBy("cluster", "q", "r").applyInArrow(verify, out))
    scratch.drop(sets, large, known)
    return one.union(two)


def survivors(docs: DataFrame, num: int = 85, den: int = 100) -> DataFrame:
    """docs with one row for each component of near-duplicate rows. All columns stay, a doc_id plays no part in links.

    Rows are linked by their texts alone, as near_components() links documents, so rows that share a doc_id are two
    where their texts are. The row of the least doc_id stays, one without an id only where none of its component has
    one; ties are broken by a hash of the text and then by position. Rows without words have nothing to be compared by
    and all stay, but for repeated ones of the same doc_id and text. Rows that go are told by number; while they are
    counted and few, no document moves between tasks.
    """
    scratch, row = Scratch(docs.sparkSession, "survivors"), unused("near_row_", docs.columns)
    rows = scratch.cut(docs.withColumn(row, F.monotonically_increasing_id()))
    named = near_components(rows.select(F.col(row).alias("doc_id"), "text"), num, den)
    named = scratch.cut(named.select(F.col("doc_id").alias("n_"), "component_id", "n_shingles"))
    ids = rows.select(F.col(row).alias("r_"), F.col("doc_id").cast("long").alias("d_"), F.xxhash64("text").alias("h_"))
    own = ids.join(named, F.col("r_") == F.col("n_"))
    order = F.struct(F.col("d_").isNull().alias("none"), "d_", "h_", "r_")
    worded = own.filter("n_shingles > 0").groupBy("component_id").agg(F.min(order).alias("o")).select(F.col("o.r_").alias("k_"))
    texts = rows.select(F.col(row).alias("r_"), F.col("doc_id").cast("long").alias("d_"), F.col("text").alias("t_"))
    blank = texts.join(named.filter("n_shingles = 0").select("n_"), F.col("r_") == F.col("n_"), "left_semi")
    unnamed = blank.filter("d_ is null").select("r_")
    blank = blank.filter("d_ is not null").groupBy("d_", "t_").agg(F.min("r_").alias("k_")).select("k_")
    kept = worded.union(unnamed).union(blank)
    gone = scratch.cut(named.select("n_").join(kept, F.col("n_") == F.col("k_"), "left_anti").toDF(unused("near_gone_", rows.columns)))
    leave = F.broadcast(gone) if gone.count() <= FEW else gone
    return rows.join(leave, rows[row] == leave[gone.columns[0]], "left_anti").drop(row)

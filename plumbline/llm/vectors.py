"""Near-duplicate vectors by counting collisions in many one-dimensional projections.

1. Rows with equal vectors are one class with a weight; a group of copies is one class, however large it is.
2. Tight groups are found by means: every vector within half the linking angle of a mean is in its ball, and any two
   vectors of a ball are linked by the triangle inequality, so the pairs of a ball are counted and never formed.
3. Each unit vector is projected on many random directions. Only what lies far out is posted to a direction's line: two
   near vectors share many far ends, two others hardly any. Lines are sorted, and around each posting lies a window.
   Vectors in it collide with the posting's, unless they are in one ball or sketches of 64 signs rule them out.
4. Collisions are counted for each pair. The count and the bound of the sketch are set by the binomial law so that a pair
   right at the least cosine passes with the recall asked for; closer ones pass more often. Pairs that pass are verified.

Directions grow with the square root of the rows, so work grows with their power of 1.5 and not with their square.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import acos, comb, cos, pi, sqrt
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch, tune
from plumbline.llm.components import components

#: Least cosine of a link, and the recall of a pair right at it.
COSINE, RECALL = 0.95, 0.9999
#: Directions for the square root of the rows, their least and greatest number, and postings of a vector on average.
PER_ROOT, LEAST, MOST, POSTINGS = 32, 1 << 10, 1 << 20, 32
#: Half a window, in standard deviations of the projected difference of a pair right at the least cosine.
REACH = 2.5
#: Signs of a sketch.
SIGNS = 64
#: Cells whose means are candidates for balls: at most so many, and so many numbers in all.
CELLS, CELL_NUMBERS = 1024, 1 << 18
#: Rows of a line, or of a part of a crowded line, that one task compares; pairs that it holds at a time.
CHUNK, PAIRS = 4096, 1 << 20
#: Vectors and directions of one product.
ROWS, COLUMNS = 2048, 4096


class Plan(NamedTuple):
    """Directions, least projection that is posted, half window, least count of collisions, most unlike signs."""

    directions: int
    least: float
    window: float
    count: int
    signs: int


def _at_least(n: int, p: float, k: int) -> float:
    """The chance of k or more successes out of n."""
    if k <= 0:
        return 1.0
    term, below = (1 - p) ** n, 0.0
    for i in range(k):
        below += term
        term *= (n - i) / (i + 1) * p / (1 - p)
    return 1 - below


def collision(cosine: float, least: float, window: float) -> float:
    """The chance that both projections of a pair of unit vectors on one direction are `least` or more and `window` apart."""
    x = np.linspace(least, least + 8, 4001)
    normal, spread = NormalDist(), sqrt(max(1e-18, 1 - cosine * cosine))
    cdf = lambda y: np.array([normal.cdf(z) for z in (y - cosine * x) / spread])
    inner = cdf(x + window) - cdf(np.maximum(x - window, least))
    y = np.exp(-x * x / 2) / sqrt(2 * pi) * np.maximum(inner, 0)
    return float((y[1:] + y[:-1]).sum() * (x[1] - x[0]) / 2)


def plan(rows: int, cosine: float = COSINE, recall: float = RECALL) -> Plan:
    """Settings for so many rows, such that a pair right at the cosine is verified with the recall asked for."""
    want = max(LEAST, min(MOST, int(PER_ROOT * sqrt(max(rows, 1)))))
    directions = 1 << (want - 1).bit_length()
    least = NormalDist().inv_cdf(1 - POSTINGS / 2 / directions)
    window = REACH * sqrt(2 - 2 * cosine)
    lost = (1 - recall) / 2  # half by the count, half by the sketch
    p = 2 * collision(cosine, least, window)  # either end of a direction
    count = max((k for k in range(1, POSTINGS) if _at_least(directions, p, k) >= 1 - lost), default=1)
    differ = acos(cosine) / pi
    signs = next(h for h in range(SIGNS + 1) if sum(comb(SIGNS, i) * differ**i * (1 - differ) ** (SIGNS - i) for i in range(h + 1)) >= 1 - lost or h == SIGNS)
    return Plan(directions, least, window, count, signs)


@cache
def _block(dim: int, at: int, size: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, dim, at])).standard_normal((dim, size), dtype=np.float32)


def _directions(dim: int, n: int, seed: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """(first, matrix) blocks of random directions; kept by a worker while they are few."""
    make = _block if dim * n <= 1 << 24 else _block.__wrapped__
    for at in range(0, n, COLUMNS):
        yield at, make(dim, at, min(COLUMNS, n - at), seed)


def _packed(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows with vectors of one length, several batches at a time, and the vectors as unit rows in double precision."""

    def cut(held: list[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
        t = pa.Table.from_batches(held).combine_chunks()
        lists = t["vector"].combine_chunks()
        size = lists.value_lengths().to_numpy()
        for dim in np.unique(size):
            own = np.flatnonzero(size == dim)
            x = lists.take(pa.array(own)).flatten().to_numpy().astype(np.float64).reshape(len(own), int(dim))
            yield t.take(pa.array(own)), unit(x)

    held, n = [], 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield from cut(held)
            held, n = [], 0
    if held:
        yield from cut(held)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one. The greatest component is made one first, so that no square is beyond a double."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector: str) -> Column:
    """Whether a column of arrays has numbers only, all finite, and not only zeros."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _cells(dim: int) -> int:
    return max(16, min(CELLS, CELL_NUMBERS // max(dim, 1)))


def _means(classes: DataFrame, before: dict[int, np.ndarray] | None) -> dict[int, np.ndarray]:
    """For each length of vectors the means of its cells, the heaviest first. A vector's cell is the half-line on which it
    lies furthest out; with means from before it counts only where it is near its cell's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for t, x in _packed(batches):
            dim = x.shape[1]
            n = _cells(dim) // 2
            p = x.astype(np.float32) @ _block(dim, 0, n, 2)
            far = np.abs(p).argmax(axis=1)
            cell = far + n * (p[np.arange(len(p)), far] < 0)
            weight = np.ones(len(x))
            if before is not None:
                weight = ((x * before[dim][cell]).sum(axis=1) >= 0.8).astype(np.float64)
            acc = sums.setdefault(dim, np.zeros((2 * n, dim + 1)))
            np.add.at(acc, cell, np.concatenate((x, np.ones((len(x), 1))), axis=1) * weight[:, None])
        for dim, acc in sums.items():
            full = np.flatnonzero(acc[:, -1])
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * len(full), pa.int64()), "cell": pa.array(full), "sums": pa.array(acc[full].tolist(), pa.list_(pa.float64()))})

    parts = classes.select("vector").mapInArrow(run, "dim long, cell long, sums array<double>")
    # sums of a cell: one row a task each, added component by component
    flat = parts.select("dim", "cell", F.posexplode("sums").alias("i", "x")).groupBy("dim", "cell", "i").agg(F.sum("x").alias("x"))
    rows = flat.groupBy("dim", "cell").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("s")).select("dim", "cell", "s.x").toArrow()
    out: dict[int, np.ndarray] = {}
    for dim, cell, s in zip(rows["dim"].to_pylist(), rows["cell"].to_pylist(), rows["x"].to_pylist(), strict=True):
        out.setdefault(dim, np.zeros((_cells(dim) // 2 * 2, dim + 1)))[cell] = s
    return out


def _balls(classes: DataFrame, cosine: float, scratch: Scratch) -> DataFrame:
    """classes with ball: a number that classes share only if all of them are linked, or null.

    The driver holds at most CELL_NUMBERS numbers for each length of vectors, and so does each task.
    """
    rough = {d: m[:, :-1] / np.maximum(np.sqrt((m[:, :-1] ** 2).sum(axis=1, keepdims=True)), 1e-300) for d, m in _means(classes, None).items()}
    heavy = {}
    for dim, m in _means(classes, rough).items():
        m = m[np.argsort(-m[:, -1], kind="stable")]
        m = m[m[:, -1] >= 2, :-1]
        size = np.sqrt((m * m).sum(axis=1))
        heavy[dim] = m[size > 0] / size[size > 0, None]
    near = cos(acos(cosine) / 2) + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, x in _packed(batches):
            dim = x.shape[1]
            means, ball = heavy[dim], np.full(len(x), -1, dtype=np.int64)
            if len(means):
                in_ball = x @ means.T >= near
                some = in_ball.any(axis=1)
                ball[some] = in_ball[some].argmax(axis=1) + (dim << 32)
            t = t.append_column("ball", pa.array(ball, mask=ball < 0))
            yield from t.to_batches()

    return scratch.cut(classes.mapInArrow(run, "node long, n long, vec_id long, fp_a long, fp_b long, vector array<double>, ball long"))


def _post(p: Plan):
    """Postings of classes: line (with the vectors' length), value, node, ball (-1 for none), sketch of signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, x in _packed(batches):
            dim, x = x.shape[1], x.astype(np.float32)
            node, ball = t["node"].to_numpy(), t["ball"].combine_chunks().fill_null(-1).to_numpy()
            bits = np.packbits(x @ _block(dim, 0, SIGNS, 3) >= 0, axis=1).view(np.int64).ravel()
            for at, block in _directions(dim, p.directions):
                v = x @ block
                r, c = np.nonzero(np.abs(v) >= p.least)
                value = v[r, c]
                line = (np.int64(dim) << 32) + 2 * (at + c) + (value < 0)
                yield pa.RecordBatch.from_pydict({"line": line, "value": np.abs(value), "node": node[r], "ball": ball[r], "bits": bits[r]})

    return run


def _collide(p: Plan):
    """(a, b) for each collision in sorted lines: (line, grid, side, value, node, ball, bits) by line, grid and value.

    Rows of side -1 collide with all of their line and grid, others with those of the other side.
    """

    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        line, grid, side, value, node, ball = (t[c].to_numpy() for c in ("line", "grid", "side", "value", "node", "ball"))
        bits = t["bits"].to_numpy().view(np.uint64)
        group = np.cumsum(np.concatenate(([0], (line[1:] != line[:-1]) | (grid[1:] != grid[:-1]))))
        key = group * 64.0 + value  # projections of unit vectors that are posted are far below 64 - window
        ends = np.searchsorted(key, key + p.window, "right")
        many = ends - np.arange(len(key)) - 1
        total = np.concatenate(([0], np.cumsum(many)))
        lo = 0
        while lo < len(key):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + PAIRS, "right")) - 1)
            i = np.repeat(np.arange(lo, hi), many[lo:hi])
            j = i + 1 + np.arange(len(i)) - np.repeat(total[lo:hi] - total[lo], many[lo:hi])
            lo = hi
            good = np.bitwise_count(bits[i] ^ bits[j]) <= p.signs
            i, j = i[good], j[good]
            good = ((ball[i] != ball[j]) | (ball[i] < 0)) & ((side[i] != side[j]) | (side[i] < 0)) & (node[i] != node[j])
            a, b = node[i[good]], node[j[good]]
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if open_ is None else pa.concat_tables([open_, t]).combine_chunks()
            line, grid = t["line"].to_numpy(), t["grid"].to_numpy()
            if not len(line):
                continue
            same = np.flatnonzero((line != line[-1]) | (grid != grid[-1]))
            cut = int(same[-1]) + 1 if len(same) else 0
            if cut:
                yield from pairs(t.slice(0, cut))
            open_ = t.slice(cut)
        if open_ is not None:
            yield from pairs(open_)

    return run


def _dealt(posts: DataFrame, scratch: Scratch) -> DataFrame:
    """Postings with grid and side, so that no (line, grid) has many more than 2 * CHUNK rows.

    A crowded line is cut into chunks and every two chunks meet in one grid. Its largest ball is cut by itself; its chunks
    meet the others' and not each other.
    """
    counts = posts.groupBy("line", "ball").count().groupBy("line").agg(
        F.sum("count").alias("all"), F.max_by("ball", F.when(F.col("ball") >= 0, F.col("count")).otherwise(-1)).alias("main"), F.max(F.when(F.col("ball") >= 0, F.col("count")).otherwise(0)).alias("own")
    )
    crowded = scratch.cut(counts.filter(F.col("all") > CHUNK))
    plain = lambda rows: rows.select("line", F.lit(0).cast("long").alias("grid"), F.lit(-1).alias("side"), "value", "node", "ball", "bits")
    if crowded.isEmpty():
        return plain(posts)
    parts = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / CHUNK)).cast("long")
    crowded = crowded.select(F.col("line").alias("l_"), "main", parts("own").alias("mains"), F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("own")) / CHUNK)).cast("long").alias("rests"))
    rows = posts.join(crowded, F.col("line") == F.col("l_"))
    mine = (F.col("ball") >= 0) & (F.col("ball") == F.col("main"))
    h = F.xxhash64("node")
    of_main, of_rest = F.pmod(h, F.col("mains")), F.pmod(h, F.col("rests"))
    place = lambda grid, side: F.struct(grid.cast("long").alias("grid"), side.alias("side"))
    # grids: 1 + main * rests + rest for a main chunk and another one, and below zero for two others
    mains = F.transform(F.sequence(F.lit(0).cast("long"), F.col("rests") - 1), lambda r: place(1 + of_main * F.col("rests") + r, F.lit(0)))
    to_main = F.transform(F.sequence(F.lit(0).cast("long"), F.col("mains") - 1), lambda m: place(1 + m * F.col("rests") + of_rest, F.lit(1)))
    other = lambda r: -1 - (F.least(r, of_rest) * F.col("rests") + F.greatest(r, of_rest))
    to_rest = F.transform(F.sequence(F.lit(0).cast("long"), F.col("rests") - 1), lambda r: place(other(r), F.when(r == of_rest, -1).when(of_rest < r, 0).otherwise(1)))
    places = F.when(mine, mains).otherwise(F.when(F.col("main") >= 0, F.concat(to_main, to_rest)).otherwise(to_rest))
    split = rows.select("line", F.explode(places).alias("p_"), "value", "node", "ball", "bits").select("line", "p_.grid", "p_.side", "value", "node", "ball", "bits")
    return plain(posts.join(crowded, F.col("line") == F.col("l_"), "left_anti")).union(split)


def _verify(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, y = ([*map(np.array, batch.column(c).to_pylist())] for c in ("va", "vb"))
            good = np.array([len(a) == len(b) and float((unit(a[None]) * unit(b[None])).sum()) >= cosine for a, b in zip(x, y, strict=True)])
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(good))

    return run


def _classes(vectors: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, fp_a, fp_b) with null fingerprints where a vector can't be used, and classes of equal vectors."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    v = v.select("vec_id", F.when(usable("v"), F.transform("v", lambda x: x + F.lit(0.0))).alias("vector"))
    prints = {"fp_a": F.when(F.col("vector").isNotNull(), F.xxhash64("vector")), "fp_b": F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(1), "vector"))}
    rows = scratch.cut(v.withColumns(prints).withColumn("row", F.monotonically_increasing_id()))
    same = rows.filter("fp_a is not null").groupBy("fp_a", "fp_b").agg(F.min("row").alias("node"), F.count("*").alias("n"), F.min("vec_id").alias("vec_id"), F.first("vector").alias("vector"))
    return rows, scratch.cut(same.select("node", "n", "vec_id", "fp_a", "fp_b", "vector"))


def _links(classes: DataFrame, p: Plan, cosine: float, scratch: Scratch) -> DataFrame:
    """(a, b, na, nb): links of classes that aren't in one ball, with the rows of each."""
    posts = scratch.cut(classes.select("node", "ball", "vector").mapInArrow(_post(p), "line long, value float, node long, ball long, bits long"))
    dealt = _dealt(posts, scratch).repartition("line", "grid").sortWithinPartitions("line", "grid", "value")
    hits = dealt.mapInArrow(_collide(p), "a long, b long")
    pairs = scratch.cut(hits.groupBy("a", "b").count().filter(F.col("count") >= p.count).select("a", "b"))
    left = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("vector").alias("va"))
    right = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("vector").alias("vb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "va", "vb")
    return scratch.cut(both.mapInArrow(_verify(cosine), "a long, b long, na long, nb long"))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of vectors (vec_id long, embedding array of numbers).

    Two rows are linked when the cosine of their vectors, in double precision, is `cosine` or more; pairs are found with
    at least the recall asked for and verified, equal vectors and those of one ball always. n_links counts other rows,
    component_id is the least vec_id that can be reached, kept whether it is the row's own.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and so do vectors of
    different lengths. Rows that share a vec_id are rows of their own. A null vec_id has component_id the least id of
    its component, if any has one, and is not kept. No rows in, no rows out. Other columns are ignored.
    """
    spark = vectors.sparkSession
    tune(spark)
    scratch = Scratch(spark, "vectors")
    rows, classes = _classes(vectors, scratch)
    p = plan(classes.count(), cosine, recall)
    classes = _balls(classes, cosine, scratch)
    links = _links(classes, p, cosine, scratch)
    balls = scratch.cut(classes.filter("ball is not null").groupBy("ball").agg(F.sum("n").alias("weight"), F.min("node").alias("hub")))
    in_ball = classes.filter("ball is not null").select("node", "ball").join(F.broadcast(balls), "ball")  # as many as there are means at most
    named = components(links.select("a", "b").union(in_ball.select(F.col("hub").alias("a"), F.col("node").alias("b"))), scratch)
    ends = links.select(F.col("a").alias("node"), F.col("nb").alias("more")).union(links.select("b", "na"))
    more = ends.groupBy(F.col("node").alias("e_")).agg(F.sum("more").alias("more"))
    c = classes.select("node", "n", "vec_id", "fp_a", "fp_b", "ball").join(F.broadcast(balls.select(F.col("ball").alias("b_"), "weight")), F.col("ball") == F.col("b_"), "left")
    c = c.join(more, F.col("node") == F.col("e_"), "left").join(named.withColumnRenamed("node", "n_"), F.col("node") == F.col("n_"), "left")
    c = scratch.cut(c.select("fp_a", "fp_b", "vec_id", F.coalesce("label", "node").alias("label"), (F.coalesce("weight", "n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")))
    least = c.groupBy(F.col("label").alias("l_")).agg(F.min("vec_id").alias("component_id"))
    label = scratch.cut(c.join(least, F.col("label") == F.col("l_")).select("fp_a", "fp_b", "n_links", "component_id"))
    out = rows.select("vec_id", "fp_a", "fp_b").join(label, ["fp_a", "fp_b"], "left")
    own = F.when(F.col("fp_a").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))

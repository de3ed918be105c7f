"""Connected components of a graph held in a DataFrame, without gathering any of it in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) for every node of `edges` (a long, b long); label is the least node that can be reached.

    In a round every node that has a lesser neighbour points to its least one. Pointers are followed to their roots, and
    the edges between roots are the graph of the next round, so a cluster that is one star is done after the first, and
    long chains take as many rounds as their length has binary digits. Joins are between written tables: adaptive
    execution can split a hot key. Self-loops and repeated edges are harmless; edges with a null end are ignored.
    """
    given = edges.filter("a is not null and b is not null")
    both = scratch.cut(given.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    arcs, labels = both.filter("lo < hi"), None
    while not arcs.isEmpty():
        flat = _roots(scratch.cut(arcs.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("label"))), scratch)
        if labels is None:
            labels = flat
        else:
            over = flat.select(F.col("node").alias("via"), F.col("label").alias("root"))
            labels = scratch.cut(labels.join(over, F.col("label") == F.col("via"), "left").select("node", F.coalesce("root", "label").alias("label")).union(flat))
        x, y = (flat.select(F.col("node").alias(f"{c}n"), F.col("label").alias(f"{c}l")) for c in "xy")
        moved = arcs.join(y, F.col("hi") == F.col("yn")).join(x, F.col("lo") == F.col("xn"), "left").select(F.coalesce("xl", "lo").alias("p"), F.col("yl").alias("q"))
        arcs = scratch.cut(moved.filter("p <> q").select(F.least("p", "q").alias("lo"), F.greatest("p", "q").alias("hi")).distinct())
    alone = both.filter("lo = hi").select(F.col("lo").alias("node"), F.col("hi").alias("label"))
    if labels is None:
        return alone
    roots = labels.select(F.col("label").alias("node"), "label")
    return scratch.cut(labels.union(roots).union(alone).groupBy("node").agg(F.min("label").alias("label")))


def _roots(up: DataFrame, scratch: Scratch) -> DataFrame:
    """Pointers (node, label) to lesser nodes, followed to those that point nowhere."""
    while True:
        over = up.select(F.col("node").alias("via"), F.col("label").alias("root"))
        after = scratch.cut(up.join(over, F.col("label") == F.col("via"), "left").select("node", F.coalesce("root", "label").alias("label"), F.col("root").isNotNull().alias("moved")))
        scratch.drop(up)
        if after.filter("moved").isEmpty():
            return after.select("node", "label")
        up = after

"""Exact quantiles of groups of any size: no task holds a group's values.

Small data goes through Spark's own exact percentile, whose state has every distinct value of a group. Beyond that,
approximate marks part each group's values into ranges, counts by range tell which ranges hold the ranks asked for, and
only these are put in order. The marks decide how the work is dealt, never a result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.operators.copies import estimated_bytes

#: Data that Spark estimates at fewer bytes is grouped at once: so many bound a group's state.
SMALL = 64 << 20
#: Ranges that a group's values are parted into.
RANGES = 256


def exact(rows: DataFrame, by: Sequence[str], quantiles: Mapping[str, tuple[str, float]], aggregates: Sequence[Column] = (), small: int = SMALL) -> DataFrame:
    """(by..., aggregates..., name...): a row for each group, its aggregates, and by name the quantile (column, share).

    Quantiles are interpolated linearly; nulls don't count, null keys do, and a group without values has null. Any number
    of columns and shares takes one pass over small data, and two over large data.
    """
    aggregates = list(aggregates) or [F.count("*").alias("n_rows_")]
    columns = list(dict.fromkeys(c for c, _ in quantiles.values()))
    shares = {c: list(dict.fromkeys(s for x, s in quantiles.values() if x == c)) for c in columns}
    if estimated_bytes(rows) < small:
        held = [F.percentile(F.col(c).cast("double"), F.array(*[F.lit(float(s)) for s in shares[c]])).alias(f"q{i}_") for i, c in enumerate(columns)]
        found = rows.groupBy(*by).agg(*aggregates, *held)
        values = [F.col(f"q{columns.index(c)}_")[shares[c].index(s)].alias(name) for name, (c, s) in quantiles.items()]
        return found.select(*[c for c in found.columns if c not in {f"q{i}_" for i in range(len(columns))} and c != "n_rows_"], *values)
    grouped = rows.groupBy(*by).agg(*aggregates).withColumn("k_", F.struct(F.lit(0).alias("all_"), *by))
    ranked = _ranked(rows, by, columns, sorted({s for c in columns for s in shares[c]}))
    at = lambda c, s: F.max(F.when(F.col("m_") == columns.index(c), _between(s)))
    wide = ranked.groupBy(F.col("k_").alias("g_")).agg(*[at(c, s).alias(name) for name, (c, s) in quantiles.items()])
    # keys as one struct, in which nulls are equal
    return grouped.join(wide, F.col("k_") == F.col("g_"), "left").drop("k_", "g_", "n_rows_")


def _ranked(rows: DataFrame, by: Sequence[str], columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """(k_, m_, rows_, at_): for each group and column number the values at the ranks that the shares need.

    The columns are stacked, so that groups, columns and ranges are dealt out together.
    """
    stacked = F.inline(F.array(*[F.struct(F.lit(i).alias("m_"), F.col(c).cast("double").alias("v_")) for i, c in enumerate(columns)]))
    data = rows.select(F.struct(F.lit(0).alias("all_"), *by).alias("k_"), stacked).filter("v_ is not null")
    key = ["k_", "m_"]
    steps = [i / RANGES for i in range(1, RANGES)]
    marks = data.groupBy(*key).agg(F.percentile_approx("v_", steps, 10 * RANGES).alias("marks_"), F.count("*").alias("rows_"))
    counted = data.groupBy(*key, "v_").agg(F.count("*").alias("n_"))
    placed = counted.join(marks, key).withColumn("range_", F.size(F.filter("marks_", lambda m: m < F.col("v_")))).drop("marks_")
    ranges = placed.groupBy(*key, "range_").agg(F.sum("n_").alias("n_"), F.first("rows_").alias("rows_"))
    before = F.coalesce(F.sum("n_").over(W.partitionBy(*key).orderBy("range_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # RANGES rows a group
    held = lambda rank: (rank >= F.col("before_")) & (rank < F.col("before_") + F.col("n_"))
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(*_ranks(s)) for s in shares])))
    wanted = ranges.withColumn("before_", before).withColumn("ranks_", F.filter(ranks, held)).filter(F.size("ranks_") > 0).select(*key, "range_", "before_", "ranks_")
    inside = placed.join(wanted, [*key, "range_"])
    within = F.col("before_") + F.coalesce(F.sum("n_").over(W.partitionBy(*key, "range_").orderBy("v_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    hits = inside.withColumn("before_", within).withColumn("rank_", F.explode(F.filter("ranks_", held)))
    return hits.groupBy(*key, "rows_").agg(F.map_from_entries(F.collect_list(F.struct("rank_", "v_"))).alias("at_"))  # two ranks a share


def _between(share: float) -> Column:
    """The value at a share's place, between those at the two ranks beside it."""
    lo, hi = (F.col("at_")[r] for r in _ranks(share))
    return lo + (hi - lo) * (_position(share) - F.floor(_position(share)))


def _position(share: float) -> Column:
    return F.lit(float(share)) * (F.col("rows_") - 1)


def _ranks(share: float) -> tuple[Column, Column]:
    return F.floor(_position(share)), F.ceil(_position(share))

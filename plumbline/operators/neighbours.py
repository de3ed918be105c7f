"""The row before in a group of any size: a group that is too large for a task is cut into ranges of its order.

Cuts are taken from a sample by hash of each crowded group's own order, so they are the same whenever they are used. Within
a range rows are ordered by a window; the last row of each range is carried to the next one that has rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.operators.copies import estimated_bytes

#: Data that Spark estimates at fewer bytes is ordered at once; a group of more rows is cut.
SMALL, CROWD = 64 << 20, 1 << 20
#: Ranges of a crowded group at most, sampled rows for each, and crowded groups that are cut.
RANGES, SAMPLED, GROUPS = 256, 8, 4096


def with_before(rows: DataFrame, group: str, order: Sequence[str], columns: Sequence[str], name: str = "before", small: int = SMALL, crowd: int = CROWD) -> DataFrame:
    """rows with a struct of columns of the row before by `order` in the same group; null for a group's first row.

    The order should be total. Null groups are one group. All rows stay.
    """
    values = F.struct(*columns)
    plain = rows.withColumn(name, F.lag(values).over(W.partitionBy(group).orderBy(*order)))
    if estimated_bytes(rows) < small:
        return plain
    cuts = _cuts(rows, group, order, crowd)
    if cuts is None:
        return plain
    own = F.struct(*order)
    cuts = F.broadcast(cuts)  # at most GROUPS * RANGES positions
    placed = rows.join(cuts, rows[group].eqNullSafe(cuts["group_"]), "left").withColumn("range_", F.coalesce(F.size(F.filter("cuts_", lambda c: c <= own)), F.lit(0)))
    crowded = F.col("cuts_").isNotNull()
    inside = placed.withColumn("in_", F.lag(F.struct(values.alias("v"))).over(W.partitionBy(group, "range_").orderBy(*order)))
    ends = placed.filter(crowded).groupBy(F.col(group).alias("end_"), F.col("range_").alias("at_")).agg(F.max_by(values, own).alias("last_"))
    carried = F.broadcast(ends.withColumn("carried_", F.lag("last_").over(W.partitionBy("end_").orderBy("at_"))).drop("last_"))  # as many as ranges
    joined = inside.join(carried, inside[group].eqNullSafe(carried["end_"]) & (inside["range_"] == carried["at_"]), "left")
    return joined.select(*[rows[c] for c in rows.columns], F.when(F.col("in_").isNotNull(), F.col("in_.v")).otherwise(F.col("carried_")).alias(name))


def _cuts(rows: DataFrame, group: str, order: Sequence[str], crowd: int) -> DataFrame | None:
    """(group_, cuts_): positions in the order that part each crowded group evenly; None without one."""
    sizes = rows.groupBy(F.col(group).alias("group_")).agg(F.count("*").alias("n_")).filter(F.col("n_") > crowd)
    crowds = F.broadcast(sizes.orderBy(F.desc("n_")).limit(GROUPS))
    wanted = F.least(F.ceil(F.col("n_") / crowd), F.lit(RANGES)) * SAMPLED
    hashed = F.pmod(F.xxhash64(*order), F.greatest(F.lit(1), F.floor(F.col("n_") / wanted)))
    some = rows.join(crowds, rows[group].eqNullSafe(crowds["group_"])).filter(hashed == 0)
    lists = some.groupBy("group_").agg(F.sort_array(F.collect_list(F.struct(*order))).alias("s_"))  # about RANGES * SAMPLED a group
    cuts = lists.withColumn("cuts_", F.filter("s_", lambda x, i: (i % SAMPLED == 0) & (i > 0))).select("group_", "cuts_").toArrow()
    # through the driver: both uses of the cuts have to see the same ones
    return rows.sparkSession.createDataFrame(cuts, schema=lists.select("group_", F.col("s_").alias("cuts_")).schema) if cuts.num_rows else None

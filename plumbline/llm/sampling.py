"""Bounded training samples whose members depend on the ids alone, not on the order or the partitions of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def fold(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo `of`: the fold that held-out rows are told by."""
    return F.crc32(F.col(doc_id).cast("string")) % of


#: A sample is made of parts of a class's hashes, each expected to hold one in PARTS of the rows asked for. Of the first
#: REACHED parts those are left out that hold so many that a repeated key must be in them.
PARTS, REACHED, HEAVY = 64, 192, 8
#: At most so many classes are broadcast, and the counts of at most so many parts summed on the driver.
FEW = 1 << 17


def per_class(rows: DataFrame, key: str, cls: str, most: int) -> DataFrame:
    """Distinct (key, cls) of at most `most` rows of each class, those that come first by a hash of the key.

    The hashes are cut into parts, whose rows are counted, repeated ones included; the first parts that together hold
    no more than asked for are the sample, so nothing ranks a class in one task.
    """
    rows = rows.select(key, cls)
    sizes = rows.groupBy(F.col(cls).alias("c_")).agg(F.count("*").alias("n_"))
    known = sizes.limit(FEW + 1).collect()
    if len(known) <= FEW:  # else a join would deal the rows out by class
        sizes = F.broadcast(rows.sparkSession.createDataFrame([tuple(r) for r in known], sizes.schema))
    share = F.xxhash64(key).cast("double") * 2.0**-64 + 0.5
    placed = rows.join(sizes, F.col(cls) == F.col("c_")).select(key, cls, F.floor(share * F.greatest(F.lit(1.0), F.col("n_") / most) * PARTS).alias("p_")).filter(F.col("p_") < REACHED)
    parts = placed.groupBy(F.col(cls).alias("c_"), F.col("p_").alias("q_")).agg(F.count("*").alias("n_")).filter(F.col("n_") <= max(1, most // HEAVY))
    counts = parts.limit(FEW + 1).collect()
    if len(counts) > FEW:  # thousands of classes, each with a few parts
        held = F.sum("n_").over(W.partitionBy("c_").orderBy("q_"))
        first = parts.withColumn("held_", held).filter(F.col("held_") <= most).select("c_", "q_")
    else:
        taken, sums = [], {}
        for c, q, n in sorted(map(tuple, counts), key=lambda x: x[1]):
            sums[c] = sums.get(c, 0) + n
            if sums[c] <= most:
                taken.append((c, q))
        first = F.broadcast(rows.sparkSession.createDataFrame(taken, parts.select("c_", "q_").schema))
    return placed.join(first, (F.col(cls) == F.col("c_")) & (F.col("p_") == F.col("q_"))).select(key, cls).distinct()

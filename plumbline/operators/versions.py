"""Attributes that change over time: versions from snapshots, and a join as of each row's own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def versions(snapshots: DataFrame, key: Sequence[str], at: str, values: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """(key..., values..., valid_from, valid_to): the stretches of time over which a key's values stay as they are.

    snapshots has a row for each key and time at which its values were seen; of several at one time the last by `tie`
    counts. Equal neighbours are one version. valid_to is exclusive, and null for a key's last version. Rows without a
    time are left out. A key's own snapshots are ordered in one task: there are as many as its values were seen.
    """
    packed = F.struct(*values)
    last = snapshots.filter(F.col(at).isNotNull()).groupBy(*key, at).agg(F.max_by(packed, F.struct(*tie, *values)).alias("v_"))
    order = W.partitionBy(*key).orderBy(at)
    changed = last.withColumn("before_", F.lag(F.struct("v_")).over(order)).filter(F.col("before_").isNull() | ~F.col("before_.v_").eqNullSafe(F.col("v_")))
    return changed.select(*key, "v_.*", F.col(at).alias("valid_from"), F.lead(at).over(order).alias("valid_to"))


def holds(at: Column, valid_from: Column, valid_to: Column) -> Column:
    """Whether a version holds at a time."""
    return (valid_from <= at) & (valid_to.isNull() | (at < valid_to))


def as_of(rows: DataFrame, found: DataFrame, key: Sequence[str], at: str) -> DataFrame:
    """rows with the values of versions() that held at each row's own time; null where none did.

    The join is by key, so it is dealt out like any other and a hot key can be split; a row meets its key's versions only.
    """
    other = found.withColumnsRenamed({k: f"{k}_v_" for k in key} | {"valid_from": "from_v_", "valid_to": "to_v_"})
    same = [rows[k] == other[f"{k}_v_"] for k in key]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return rows.join(other, cond & holds(rows[at], other["from_v_"], other["to_v_"]), "left").drop(*[f"{k}_v_" for k in key], "from_v_", "to_v_")

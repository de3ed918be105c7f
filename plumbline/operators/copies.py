"""Duplicates: exact copies over all columns, groups by key, first and latest rows. No plan needs a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a plan's output; nothing is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _prints(rows: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row with different seeds. Rows that agree in both are taken for equal: 128 bits.

    A hash passes over nulls, so which columns are null goes into it as well. Nested columns would hide theirs.
    """
    if nested := [c for c in columns if isinstance(rows.schema[c].dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType))]:
        raise ValueError(f"copies are told by columns of plain types, not by {nested}")
    masks = [reduce(lambda a, b: a + b, [F.when(F.col(f"`{c}`").isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(columns[lo : lo + 60])]) for lo in range(0, len(columns), 60)]
    named = [F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(*masks, *named).alias("h_"), F.xxhash64(F.lit(0x5EED), *masks, *named).alias("g_")]


def copy_counts(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (n_rows, n_copies): rows that differ from each other, and those that repeat one of them; one scan."""
    each = rows.select(*_prints(rows, columns or rows.columns)).groupBy("h_", "g_").agg(F.count("*").alias("n_"))
    return each.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(F.col("n_") - 1), F.lit(0)).alias("n_copies"))


def repeated(rows: DataFrame, row_id: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(h_, g_, first_): prints of rows that occur more than once, each with its least row_id.

    Tasks combine equal prints before they are dealt out, so a row that is copied a million times makes no large task.
    """
    columns = list(columns or [c for c in rows.columns if c != row_id])
    return rows.select(F.col(row_id).alias("id_"), *_prints(rows, columns)).groupBy("h_", "g_").agg(F.count("*").alias("n_"), F.min("id_").alias("first_")).filter("n_ > 1").drop("n_")


def flagged(rows: DataFrame, row_id: str, columns: Sequence[str] | None = None, name: str = "is_copy", keep: str | None = None) -> DataFrame:
    """rows with a column that tells whether an earlier row by row_id is equal in all columns; nulls are equal.

    Rows are read twice: once for the prints that repeat, and once to look up each row's own. keep is a folder to which
    the repeated prints are written first: Spark then knows their size, and doesn't shuffle the rows if they are few.
    """
    columns = list(columns or [c for c in rows.columns if c != row_id])
    twice = repeated(rows, row_id, columns)
    if keep:
        twice.write.mode("overwrite").parquet(keep)
        twice = rows.sparkSession.read.schema(twice.schema).parquet(keep)
    looked = rows.select("*", *[p.alias(f"{n}r_") for p, n in zip(_prints(rows, columns), ("h_", "g_"), strict=True)])
    same = (F.col("h_r_") == F.col("h_")) & (F.col("g_r_") == F.col("g_"))
    copy = F.coalesce(F.col(row_id) > F.col("first_"), F.lit(False)).alias(name)
    return looked.join(twice, same, "left").select(*rows.columns, copy)


def later_copies(rows: DataFrame, row_id: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(row_id) of every row that equals an earlier one in all columns; nulls are equal."""
    return flagged(rows, row_id, columns, "copy_").filter("copy_").select(row_id)


def first_of_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the order given, which must be total."""
    cols = [F.col(c) for c in rows.columns]
    packed = F.min_by(F.struct(*cols), F.struct(*[F.col(o) if isinstance(o, str) else o for o in order]))
    return rows.groupBy(*keys).agg(packed.alias("r_")).select("r_.*")


def latest_of_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in the order given, which must be total."""
    cols = [F.col(c) for c in rows.columns]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("r_")).select("r_.*")


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def members_of_repeated(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    return rows.join(repeated_keys(rows, keys).drop("n_rows"), list(keys), "left_semi")


def sample_per_group(rows: DataFrame, groups: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of each group. Ranks are limited before the shuffle, so a group sends at most n rows a task."""
    ranked = rows.withColumn("rn_", F.row_number().over(W.partitionBy(*groups).orderBy(*order)))
    return ranked.filter(F.col("rn_") <= n).drop("rn_")


def assert_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice."""
    if bad := repeated_keys(rows, keys).limit(3).collect():
        raise ValueError(f"keys {list(keys)} are not unique: {[tuple(r)[:-1] for r in bad]}")

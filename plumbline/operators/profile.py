"""Exact profile of all columns of a table, from one scan.

Each row becomes a row for each column: the column's number and its value in the lane of its type. Tasks combine equal
ones before they are dealt out, so one shuffle of distinct (column, value) pairs with their counts serves every column, and
counts, distinct counts, extremes and means are all taken from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DAY_ONE = "timestamp_ntz'1970-01-01 00:00:00'"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _lane(t: T.DataType) -> str:
    """What a type's values are carried as: numbers with the same order and the same distinct values, else text."""
    if isinstance(t, _WHOLE):
        return "whole"
    return "real" if isinstance(t, (T.FloatType, T.DoubleType)) else "exact" if isinstance(t, T.DecimalType) else "text"


def _put(name: str, t: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(t, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(t, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, {_DAY_ONE}, `{name}`)")
    if isinstance(t, T.BinaryType):
        return F.hex(c)
    return c.cast("bigint") if _lane(t) == "whole" else c.cast("double") if _lane(t) == "real" else c if _lane(t) == "exact" else c.cast("string")


def _shown(lane: str, end: str, t: T.DataType) -> Column:
    """An extreme of a lane as text of the column's own type."""
    c = F.col(f"{lane}_{end}")
    if isinstance(t, T.DateType):
        return F.date_from_unix_date(c.cast("int")).cast("string")
    if isinstance(t, T.TimestampType):
        return F.timestamp_micros(c).cast("string")
    if isinstance(t, T.TimestampNTZType):
        return F.expr(f"CAST(timestampadd(MICROSECOND, {lane}_{end}, {_DAY_ONE}) AS STRING)")
    return c.cast("string") if lane == "text" else c.cast(t).cast("string")


def columns(rows: DataFrame) -> DataFrame:
    """(column_name, column_type, n_rows, non_null, null_pct, n_distinct, min, max, mean), a row for each column.

    Nulls are counted, and are no value. NaN is one value, the greatest; minus zero is zero. Binary values are compared and
    shown as hexadecimal text. Means are of numbers only. A table without rows has counts of 0. Decimals share one lane,
    whose digits have to fit 38.
    """
    fields = list(rows.schema)
    decimals = [f.dataType for f in fields if _lane(f.dataType) == "exact"]
    scale = max((d.scale for d in decimals), default=0)
    kinds = {"whole": "bigint", "real": "double", "exact": f"decimal({max((d.precision - d.scale for d in decimals), default=1) + scale},{scale})", "text": "string"}
    lanes = {k: t for k, t in kinds.items() if any(_lane(f.dataType) == k for f in fields)}
    none = lambda k: F.lit(None).cast(lanes[k])
    wide = rows.select(
        *[F.struct(F.lit(i).alias("i"), *[(_put(f.name, f.dataType).cast(t) if _lane(f.dataType) == k else none(k)).alias(k) for k, t in lanes.items()]).alias(f"c{i}") for i, f in enumerate(fields)]
    )
    stacked = wide.unpivot([], wide.columns, "from_", "x").select("x.*")
    values = stacked.groupBy("i", *lanes).agg(F.count("*").alias("n"))
    known = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in lanes])
    ends = [f(k).alias(f"{k}_{e}") for k in lanes for e, f in (("min", F.min), ("max", F.max))]
    weight = reduce(lambda a, k: a + F.coalesce(F.sum(F.col(k).cast("double") * F.col("n")), F.lit(0.0)), [k for k in lanes if k != "text"], F.lit(0.0))
    facts = values.groupBy("i").agg(F.sum("n").alias("n_rows"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("non_null"), F.count_if(known).alias("n_distinct"), weight.alias("sum_"), *ends)
    spark = rows.sparkSession
    named = F.broadcast(spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)], "k_ int, column_name string, column_type string"))
    out = named.join(facts, F.col("k_") == F.col("i"), "left")
    of = lambda pick: F.coalesce(*[F.when(F.col("k_") == i, pick(f.dataType)) for i, f in enumerate(fields)])
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    numeric = F.col("k_").isin([i for i, f in enumerate(fields) if isinstance(f.dataType, T.NumericType)])
    mean = F.when(numeric, F.round(F.try_divide("sum_", F.col("non_null").cast("double")), 3))
    pct = F.round(F.try_divide(100.0 * (F.col("n_rows") - F.col("non_null")), F.col("n_rows").cast("double")), 4)
    return out.select("column_name", "column_type", count("n_rows"), count("non_null"), pct.alias("null_pct"), count("n_distinct"), of(lambda t: _shown(_lane(t), "min", t)).alias("min"), of(lambda t: _shown(_lane(t), "max", t)).alias("max"), mean.alias("mean"))

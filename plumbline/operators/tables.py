"""General relational shapes: coverage of keys, crosstabs, pivots, frequencies, descriptions, top-k and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import share
from plumbline.operators.quantiles import exact


def key_coverage(child: DataFrame, key: str, parent: DataFrame, parent_key: str, relationship: str) -> DataFrame:
    """(relationship, n_rows, null_keys, matched, pct_non_null, pct_all, status) of a reference; null keys match nothing."""
    known = parent.select(F.col(parent_key).alias("p_")).distinct().withColumn("hit_", F.lit(True))
    rows = child.select(F.col(key).alias("k_")).join(known, F.col("k_") == F.col("p_"), "left")
    c = rows.agg(F.count("*").alias("n_rows"), F.count_if(F.col("k_").isNull()).alias("null_keys"), F.count("hit_").alias("matched"))
    pct = lambda whole: F.round(100 * share("matched", whole), 2)
    return c.select(
        F.lit(relationship).alias("relationship"), "n_rows", "null_keys", "matched",
        pct(F.col("n_rows") - F.col("null_keys")).alias("pct_non_null"), pct("n_rows").alias("pct_all"),
        F.when(F.col("matched") == F.col("n_rows"), "PASS").otherwise("WARN").alias("status"),
    )


def crosstab(rows: DataFrame, a: str, b: str, total: str = "All") -> DataFrame:
    """Counts of each pair and of the margins, in long form: the margin's label stands in place of a value."""
    cube = rows.select(F.col(a).alias("a_"), F.col(b).alias("b_")).cube("a_", "b_").agg(F.count("*").alias("n"), F.grouping("a_").alias("ga"), F.grouping("b_").alias("gb"))
    named = lambda c, g: F.when(F.col(g) == 1, total).otherwise(F.coalesce(c, F.lit("(null)")))
    return cube.select(named("a_", "ga").alias(a), named("b_", "gb").alias(b), "n")


def pivot_counts(rows: DataFrame, key: str, column: str, values: Sequence[str]) -> DataFrame:
    """One row a key and one count a value; values that don't occur count zero."""
    return rows.groupBy(key).pivot(column, list(values)).count().fillna(0, list(values))


def distinct_list(rows: DataFrame, key: str, column: str, bar: str = "|") -> DataFrame:
    """(key, n, values): how many rows, and the sorted distinct values joined."""
    return rows.groupBy(key).agg(F.count(column).alias("n"), F.array_join(F.array_sort(F.collect_set(column)), bar).alias("values"))


def frequencies(rows: DataFrame, column: str) -> DataFrame:
    """(value, n, pct): nulls are a value."""
    counted = rows.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("(null)")).alias("value")).agg(F.count("*").alias("n"))
    whole = counted.agg(F.sum("n").alias("all_"))  # one row
    return counted.crossJoin(whole).withColumn("pct", F.round(100.0 * F.col("n") / F.col("all_"), 2).cast("double")).drop("all_")


def describe(rows: DataFrame, by: str, column: str) -> DataFrame:
    """Count, quartiles and extremes of a column for each group; nulls don't count."""
    facts = [F.count(column).alias("n"), F.min(column).alias("min"), F.max(column).alias("max")]
    out = exact(rows, [by], {"p25": (column, 0.25), "p50": (column, 0.5), "p75": (column, 0.75)}, facts)
    return out.select(by, "n", "p25", "p50", "p75", "min", "max")


def top_k(rows: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of an order, which must be total; each task keeps k."""
    return rows.orderBy(*order).limit(k)


def top_share(totals: DataFrame, measure: str, k: int, tie: str) -> DataFrame:
    """(k, n_groups, top_total, total, top_share): what the k largest groups hold of the whole."""
    top = top_k(totals.select(measure, tie), [F.desc(measure), F.asc(tie)], k).agg(F.sum(measure).alias("top_total"))
    whole = totals.agg(F.count("*").alias("n_groups"), F.sum(measure).alias("total"))
    return top.crossJoin(whole).select(F.lit(k).cast("long").alias("k"), "n_groups", "top_total", "total", share("top_total", "total").alias("top_share"))  # one row each


def mode(rows: DataFrame, column: str) -> DataFrame:
    """(value, n): the most common value; of several, the first in order."""
    counted = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return top_k(counted, [F.desc("n"), F.asc("value")], 1)


def grain(rows: DataFrame, table: str, key: str) -> DataFrame:
    """(table, key, n_rows, n_keys, is_unique): whether a claimed key is one."""
    c = rows.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"))
    return c.select(F.lit(table).alias("table_name"), F.lit(key).alias("claimed_key"), "n_rows", "n_keys", (F.col("n_rows") == F.col("n_keys")).alias("is_unique"))


def checks(rows: DataFrame, named: dict[str, Column]) -> DataFrame:
    """(check_name, n): how many rows each condition holds for; all counted in one pass."""
    wide = rows.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(named.values())])
    facts = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("n")) for i, n in enumerate(named)])
    return wide.select(F.inline(facts))

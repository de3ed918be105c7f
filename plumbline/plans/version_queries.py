"""Attributes as of a row's own time, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import versions as v
from plumbline.plans import adapter as a
from plumbline.plans.adapter import read
from plumbline.plans.kpi_queries import query
from plumbline.sources.tables import parameter_rows

#: Licensees as the second month was published with them: one brand is new, one licensee is gone to another.
LATER = [("L1", "Clack", "K1"), ("L2", "View", "K2"), ("L3", "Purchase", "K3"), ("L4", "Click", None)]


@query(
    "names_as_of",
    a.sql("agg", f""", months AS (SELECT month, hvfhs_license_num, wav_requested, n_records, n_clean FROM agg WHERE level = 'dispatcher'
    UNION ALL SELECT '2024-02', hvfhs_license_num, wav_requested, n_records * 2, n_clean FROM agg WHERE level = 'dispatcher'),
    later AS (SELECT * FROM (VALUES {", ".join(str((x, y)) for x, y, _ in LATER)}) t(hvfhs_license_num, brand))
    SELECT m.*, CASE WHEN m.month < '2024-02' THEN l.brand ELSE n.brand END AS brand
    FROM months m LEFT JOIN licensees l USING (hvfhs_license_num) LEFT JOIN later n USING (hvfhs_license_num)"""),
)
def names_as_of(spark: SparkSession, d: str) -> DataFrame:
    """A month keeps the brands that it was published with; two of them change between two months."""
    agg = a.table_of(spark, d).filter("level = 'dispatcher'").select("month", "hvfhs_license_num", "wav_requested", "n_records", "n_clean")
    both = agg.unionByName(agg.withColumns({"month": F.lit("2024-02"), "n_records": F.col("n_records") * 2}))
    seen = [("2024-01", x, y) for x, y, _ in a.LICENSEES] + [("2024-02", x, y) for x, y, _ in LATER]
    brands = v.versions(parameter_rows(spark, seen, "month string, hvfhs_license_num string, brand string"), ["hvfhs_license_num"], "month", ["brand"])
    return v.as_of(both, brands, ["hvfhs_license_num"], "month")


@query(
    "priority_as_of",
    """WITH f AS (SELECT o_custkey AS k, l_shipdate AS at FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    s AS (SELECT o_custkey, o_orderdate, arg_max(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY ALL)
    SELECT s.p AS priority, count(*) AS n_lines FROM f ASOF LEFT JOIN s ON f.k = s.o_custkey AND f.at >= s.o_orderdate GROUP BY 1""",
)
def priority_as_of(spark: SparkSession, d: str) -> DataFrame:
    """Every shipped line under the priority of its customer's latest order by then."""
    orders = read(spark, d, "orders")
    lines = read(spark, d, "lineitem").join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", F.col("l_shipdate").alias("at"))
    known = v.versions(orders, ["o_custkey"], "o_orderdate", ["o_orderpriority"], tie=["o_orderkey"])
    return v.as_of(lines, known, ["o_custkey"], "at").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n_lines"))

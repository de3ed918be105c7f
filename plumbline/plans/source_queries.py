"""Sources as queries: rows of a test table are written in a format to the shared folder and read back as that source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.plans.adapter import place, read
from plumbline.plans.kpi_queries import query
from plumbline.sources import footers, sqlite, tables


@query("csv_typed", "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM customer")
def csv_typed(spark: SparkSession, d: str) -> DataFrame:
    """CSV with a header by a contract of types."""
    at = place(spark, "typed")
    read(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(at)
    return tables.csv(spark, at, "c_custkey long, c_name string, c_acctbal double")


@query("csv_text", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders")
def csv_text(spark: SparkSession, d: str) -> DataFrame:
    """CSV as text, empty fields null."""
    at = place(spark, "text")
    read(spark, d, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus")).write.option("header", True).csv(at)
    return tables.csv(spark, at)


@query("json_array_pages", "SELECT c_custkey AS key, c_name AS name FROM customer")
def json_array_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of an API that each hold an array, read as one frame."""
    at = place(spark, "pages")
    rows = read(spark, d, "customer").withColumn("page", F.floor(F.col("c_custkey") / 100))
    pages = rows.groupBy("page").agg(F.to_json(F.collect_list(F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")))).alias("value"))  # a hundred rows a page
    pages.repartition(16, "page").select("value").write.text(at)
    return tables.json_texts(spark.read.text(at), "key long, name string")


#: A contract that some files of the table below keep.
CONTRACT = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderpriority", T.StringType()), T.StructField("o_absent", T.StringType())])


@query(
    "schema_contract",
    """WITH f AS (SELECT o_orderkey % 4 AS part, count(*) AS n_rows FROM orders GROUP BY 1),
    c AS (SELECT * FROM (VALUES ('o_orderkey', 'held', 'held'), ('o_totalprice', 'held', 'changed'), ('o_orderpriority', 'held', 'missing'), ('o_absent', 'missing', 'missing'),
      ('o_custkey', 'extra', 'extra'), ('o_orderstatus', 'extra', 'extra'), ('o_orderdate', 'extra', 'extra'), ('o_note', NULL, 'extra')) t(name, whole, drifted))
    SELECT CAST(part AS BIGINT) AS part, n_rows, name, CASE WHEN part = 3 THEN drifted ELSE whole END AS state FROM f, c WHERE part = 3 OR whole IS NOT NULL""",
)
def schema_contract(spark: SparkSession, d: str) -> DataFrame:
    """FIL01, ZON01, S12: the footer of every file of a table against a contract; one file has drifted."""
    at, orders = place(spark, "drift"), read(spark, d, "orders")
    for i in range(4):
        rows = orders.filter(F.col("o_orderkey") % 4 == i)
        rows = rows if i < 3 else rows.withColumn("o_totalprice", F.col("o_totalprice").cast("string")).withColumnRenamed("o_orderpriority", "o_note")
        rows.coalesce(1).write.parquet(f"{at}/part-{i}")
    found = footers.states(footers.footers(footers.files(spark, at)), CONTRACT)
    return found.select(F.regexp_extract("file", "/part-([0-9])/", 1).cast("long").alias("part"), "n_rows", "name", "state")


@query("sqlite_scan", "SELECT c_custkey, c_name, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def sqlite_scan(spark: SparkSession, d: str) -> DataFrame:
    """SQLite files of a table, each written by a task, read in equal shares of rows."""
    folder = place(spark, "sqlite").removeprefix("file:")
    rows = read(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey").repartition(3, "c_custkey")
    paths = [r[0] for r in sqlite.write(rows, folder, "customer").collect()]  # one a partition
    return sqlite.scan(spark, paths, "customer", 256).drop("rowid_")


@query("control_lookup", "SELECT CAST(count(*) * 1000 * 31 AS BIGINT) AS control_total FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1996-01' AND o_orderstatus = 'F'")
def control_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A per-day figure with thousands separators from a report in CSV, times the days of the month."""
    at = place(spark, "report")
    per = read(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("Month/Year"), F.col("o_orderstatus").alias("License Class")).agg(F.count("*").alias("n"))
    per.select("`Month/Year`", "`License Class`", F.format_number(F.col("n") * 1000, 0).alias("Trips Per Day")).write.option("header", True).csv(at)
    found = tables.lookup_number(tables.csv(spark, at), {"Month/Year": "1996-01", "License Class": "F"}, "Trips Per Day")
    return found.select((F.col("value") * 31).alias("control_total"))

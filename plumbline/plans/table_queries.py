"""Joins, windows, sets and shapes over the plain test tables, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import holds, lenient_time, normalised, right_closed_band
from plumbline.operators import copies
from plumbline.operators import tables as t
from plumbline.operators.neighbours import with_before
from plumbline.plans.adapter import read
from plumbline.plans.kpi_queries import query
from plumbline.plans.rounding import rounded
from plumbline.sources.tables import flattened, parameter_rows


@query("left_join_dims", """SELECT c_custkey, n_name, r_name, n_nationkey IS NOT NULL AS nation_found FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 7) n ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def left_join_dims(spark: SparkSession, d: str) -> DataFrame:
    """Left joins to dimensions that lose and multiply nothing."""
    n = read(spark, d, "nation").filter("n_nationkey <> 7")
    j = read(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return j.select("c_custkey", "n_name", "r_name", F.col("n_nationkey").isNotNull().alias("nation_found"))


@query("semi_join", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def semi_join(spark: SparkSession, d: str) -> DataFrame:
    """Customers with a large order."""
    big = read(spark, d, "orders").filter("o_totalprice > 200000").select("o_custkey")
    return read(spark, d, "customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_mktsegment")


@query("anti_join", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 400000)")
def anti_join(spark: SparkSession, d: str) -> DataFrame:
    """Customers without one."""
    big = read(spark, d, "orders").filter("o_totalprice > 400000").select("o_custkey")
    return read(spark, d, "customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_mktsegment")


@query(
    "key_coverage",
    """SELECT 'lineitem -> supplier' AS relationship, count(*) AS n_rows, count(*) FILTER (WHERE k IS NULL) AS null_keys, count(s_suppkey) AS matched, round(100.0 * count(s_suppkey) / count(k), 2) AS pct_non_null,
    round(100.0 * count(s_suppkey) / count(*), 2) AS pct_all, CASE WHEN count(s_suppkey) = count(*) THEN 'PASS' ELSE 'WARN' END AS status
    FROM (SELECT nullif(l_suppkey, 3) AS k FROM lineitem) LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 9 <> 1) ON s_suppkey = k""",
)
def key_coverage(spark: SparkSession, d: str) -> DataFrame:
    """How many references resolve."""
    child = read(spark, d, "lineitem").select(F.expr("nullif(l_suppkey, 3)").alias("k"))
    return t.key_coverage(child, "k", read(spark, d, "supplier").filter("s_suppkey % 9 <> 1"), "s_suppkey", "lineitem -> supplier")


@query("dedup_all_columns", "SELECT count(*) AS n_rows, CAST(sum(c - 1) AS BIGINT) AS n_copies FROM (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY ALL)")
def dedup_all_columns(spark: SparkSession, d: str) -> DataFrame:
    """How many rows repeat an earlier one in both columns, from one scan."""
    return copies.copy_counts(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber"))


@query("dup_groups", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_groups(spark: SparkSession, d: str) -> DataFrame:
    """Keys that occur more than once."""
    return copies.repeated_keys(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("latest_attempt", "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_attempt(spark: SparkSession, d: str) -> DataFrame:
    """The latest row of each key."""
    rows = read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return copies.latest_of_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("pivot_counts", "SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'view') AS view, count(*) FILTER (WHERE event_type = 'never') AS never FROM events GROUP BY 1")
def pivot_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts by value, zero where none."""
    return t.pivot_counts(read(spark, d, "events"), "user_id", "event_type", ["click", "view", "never"])


@query("distinct_list", "SELECT o_custkey, count(o_orderpriority) AS n, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS \"values\" FROM orders GROUP BY 1")
def distinct_list(spark: SparkSession, d: str) -> DataFrame:
    """Sorted distinct values, joined."""
    return t.distinct_list(read(spark, d, "orders"), "o_custkey", "o_orderpriority")


@query("freq_table", "SELECT coalesce(CAST(v AS VARCHAR), '(null)') AS value, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM orders), 2) AS pct FROM (SELECT nullif(o_orderstatus, 'P') AS v FROM orders) GROUP BY 1")
def freq_table(spark: SparkSession, d: str) -> DataFrame:
    """Frequencies, null being a value."""
    return t.frequencies(read(spark, d, "orders").select(F.expr("nullif(o_orderstatus, 'P')").alias("v")), "v")


@query("group_describe", "SELECT o_orderpriority, count(o_totalprice) AS n, round(quantile_cont(o_totalprice, 0.25), 6) AS p25, round(quantile_cont(o_totalprice, 0.5), 6) AS p50, round(quantile_cont(o_totalprice, 0.75), 6) AS p75, round(min(o_totalprice), 6) AS min, round(max(o_totalprice), 6) AS max FROM orders GROUP BY 1")
def group_describe(spark: SparkSession, d: str) -> DataFrame:
    """Quartiles and extremes of each group."""
    return rounded(t.describe(read(spark, d, "orders"), "o_orderpriority", "o_totalprice"))


@query("top_k", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(spark: SparkSession, d: str) -> DataFrame:
    """The largest orders, ties by key."""
    return t.top_k(read(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 20)


@query("binning", "SELECT CASE WHEN x > 0 AND x <= 1000 THEN 'small' WHEN x > 1000 AND x <= 5000 THEN 'medium' WHEN x > 5000 AND x <= 9000 THEN 'large' END AS band, count(*) AS n FROM (SELECT c_acctbal AS x FROM customer) GROUP BY 1")
def binning(spark: SparkSession, d: str) -> DataFrame:
    """Right-closed bands, null outside."""
    band = right_closed_band(F.col("c_acctbal"), [0, 1000, 5000, 9000], ["small", "medium", "large"])
    return read(spark, d, "customer").groupBy(band.alias("band")).agg(F.count("*").alias("n"))


@query("normalise_categories", "SELECT replace(lower(trim('  ' || p_type || ' ')), ' ', '_') AS label, count(*) AS n FROM part GROUP BY 1")
def normalise_categories(spark: SparkSession, d: str) -> DataFrame:
    """One spelling for each label."""
    return read(spark, d, "part").groupBy(normalised(F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")), "_").alias("label")).agg(F.count("*").alias("n"))


@query("json_flatten", "SELECT conv_id, turn, role FROM conversations")
def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Nested JSON documents to one row for each element, the parent's key carried down."""
    nested = read(spark, d, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(F.struct("turn", "role")).alias("turns"))).alias("doc"))
    parsed = nested.select("conv_id", F.from_json("doc", "turns array<struct<turn: bigint, role: string>>").alias("j")).select("conv_id", "j.turns")
    return flattened(parsed, "turns", ["conv_id"])


@query("json_props", "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    """A JSON text parsed by a declared schema."""
    return read(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("conversation_order", "SELECT conv_id, count(*) AS n_turns, count(*) FILTER (WHERE turn <> p + 1) AS n_jumps FROM (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) GROUP BY 1")
def conversation_order(spark: SparkSession, d: str) -> DataFrame:
    """Turns that don't follow the one before."""
    rows = with_before(read(spark, d, "conversations").select("conv_id", "turn", "role"), "conv_id", ["turn", "role"], ["turn"], "p")
    return rows.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.count_if(F.col("turn") != F.col("p.turn") + 1).alias("n_jumps"))


@query("lenient_times", "SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN date_trunc('minute', ts) END AS TIMESTAMP) AS at FROM events")
def lenient_times(spark: SparkSession, d: str) -> DataFrame:
    """Texts of several forms as times; what can't be read is null."""
    forms = "CASE event_id % 4 WHEN 0 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") WHEN 1 THEN date_format(ts, 'yyyy-MM-dd HH:mm') WHEN 2 THEN concat('soon ', event_id) END"
    return read(spark, d, "events").select("event_id", F.expr(forms).alias("raw")).select("event_id", lenient_time("raw").alias("at"))


@query("texts_holding", """SELECT word, count(*) FILTER (WHERE contains(lower(p_name || ' ' || p_type), lower(word))) AS n_holding, count(*) FILTER (WHERE contains(lower(nullif(p_name, 'small ring')), lower(word))) AS n_named, count(*) AS n
  FROM part, (VALUES ('Ring'), ('economy'), ('L'), ('zzz')) t(word) GROUP BY word""")
def texts_holding(spark: SparkSession, d: str) -> DataFrame:
    """Substring test: texts that hold a word in any case; a null text holds none. One pass counts for all words."""
    rows, words = read(spark, d, "part").withColumn("named", F.expr("nullif(p_name, 'small ring')")), ("Ring", "economy", "L", "zzz")
    whole = F.concat_ws(" ", "p_name", "p_type")
    found = rows.agg(F.count("*").alias("n"), *[F.count_if(holds(c, w)).alias(f"{k}{i}") for i, w in enumerate(words) for k, c in (("a", whole), ("b", F.col("named")))])
    return found.select(F.inline(F.array(*[F.struct(F.lit(w).alias("word"), F.col(f"a{i}").alias("n_holding"), F.col(f"b{i}").alias("n_named"), F.col("n").alias("n")) for i, w in enumerate(words)])))


@query("grain_checks", " UNION ALL ".join(f"SELECT '{n}' AS table_name, '{k}' AS claimed_key, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys, count(*) = count(DISTINCT {k}) AS is_unique FROM {n}" for n, k in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("events", "event_id"), ("conversations", "conv_id"), ("documents", "doc_id"))))
def grain_checks(spark: SparkSession, d: str) -> DataFrame:
    """Which claimed keys are keys."""
    parts = [t.grain(read(spark, d, n), n, k) for n, k in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("events", "event_id"), ("conversations", "conv_id"), ("documents", "doc_id"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("cross_source", "SELECT c_mktsegment AS segment, label, count(*) AS n FROM customer JOIN (VALUES ('BUILDING', 'b'), ('MACHINERY', 'm'), ('AUTOMOBILE', 'a')) t(seg, label) ON seg = c_mktsegment GROUP BY ALL")
def cross_source(spark: SparkSession, d: str) -> DataFrame:
    """A Parquet view joined in SQL with rows from elsewhere in the same session."""
    read(spark, d, "customer").createOrReplaceTempView("plumbline_customer")
    parameter_rows(spark, [("BUILDING", "b"), ("MACHINERY", "m"), ("AUTOMOBILE", "a")], "seg string, label string").createOrReplaceTempView("plumbline_labels")
    return spark.sql("SELECT c_mktsegment AS segment, label, count(*) AS n FROM plumbline_customer JOIN plumbline_labels ON seg = c_mktsegment GROUP BY ALL")


@query("pricing_summary", """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
  round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    """A filtered scan and one aggregation over the largest table: the throughput query of the bench."""
    rows = read(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    sums = rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"),
    )
    return sums

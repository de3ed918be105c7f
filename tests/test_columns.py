"""Expressions and shapes at their edges."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.functions import columns as c
from plumbline.operators import checks, copies, neighbours, tables
from plumbline.operators import orders as o
from plumbline.sources.tables import parameter_rows


def value(spark, expression, rows=((1,),), schema="x long"):
    return [r[0] for r in parameter_rows(spark, list(rows), schema).select(expression).collect()]


@pytest.mark.parametrize(
    "a,b,seconds",
    [("01:59:59.9", "03:00:00.1", 3601), ("00:00:00.9", "00:00:01.0", 1), ("00:10:00.0", "00:00:00.5", -600), ("00:00:00", "00:00:00.999", 0)],
)
def test_seconds_count_boundaries(spark, a, b, seconds):
    at = lambda t: F.lit(f"2024-01-01 {t}").cast("timestamp_ntz")
    assert value(spark, c.seconds_between(at(a), at(b))) == [seconds]


def test_bands(spark):
    rows = [(v,) for v in (None, -1.0, 0.0, 5.9, 6.0, 6.1, 10.0, 11.0)]
    half = value(spark, c.half_open_band(F.col("x"), [(0, 6, "a"), (6, 10, "b")]), rows, "x double")
    assert half == [None, None, "a", "a", "b", "b", None, None]
    closed = value(spark, c.right_closed_band(F.col("x"), [0, 6, 10], ["a", "b"]), rows, "x double")
    assert closed == [None, None, None, "a", "a", "b", "b", None]


def test_first_and_last_match(spark):
    big, even = F.col("x") > 2, F.col("x") % 2 == 0
    rows = [(1,), (2,), (3,), (4,)]
    assert value(spark, c.first_match((big, "big"), (even, "even"), otherwise="-"), rows) == ["-", "even", "big", "big"]
    assert value(spark, c.last_match((big, "big"), (even, "even"), otherwise="-"), rows) == ["-", "even", "big", "even"]


def test_shares_without_a_whole_are_null(spark):
    rows = [(1, 2), (1, 0), (0, 0), (1, None)]
    assert [r[0] for r in parameter_rows(spark, rows, "a long, b long").select(c.share("a", "b")).collect()] == [0.5, None, None, None]


def test_labels_and_times(spark):
    rows = [("  Late Order ",), (None,), ("",)]
    assert value(spark, c.normalised("x", "_"), rows, "x string") == ["late_order", None, ""]
    rows = [("2024-01-02T03:04:05.5",), ("2024-01-02 03:04",), ("soon",), (None,)]
    assert value(spark, c.lenient_time("x"), rows, "x string") == [datetime(2024, 1, 2, 3, 4, 5, 500000), datetime(2024, 1, 2, 3, 4), None, None]
    assert value(spark, c.joined_ids([("A", F.col("x") > 0), ("B", F.col("x") > 1), ("C", F.col("x").isNull())]), [(0,), (2,), (None,)]) == ["", "A,B", "C"]


def test_literal_rows_have_a_known_size(spark):
    small = parameter_rows(spark, [("a", 1, None)], "k string, n long, t timestamp_ntz")
    assert small.collect()[0][0] == "a" and parameter_rows(spark, [], "k string").count() == 0
    plan = spark.range(10).select(F.col("id").cast("string").alias("k")).join(small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_copies_are_found_with_and_without_a_folder(spark, tmp_path):
    rows = spark.range(40).select("id", (F.col("id") % 30).alias("x"), F.when(F.col("id") % 2 == 0, "e").alias("y"))
    assert sorted(r[0] for r in copies.later_copies(rows, "id").collect()) == list(range(30, 40))
    kept = copies.flagged(rows, "id", keep=f"file://{tmp_path}/prints")
    assert kept.columns == ["id", "x", "y", "is_copy"] and {r["id"] for r in kept.collect() if r["is_copy"]} == set(range(30, 40)) and kept.count() == 40
    assert copies.copy_counts(rows.drop("id")).first() == (30, 10) and copies.copy_counts(rows.limit(0)).first() == (0, 0)


def test_where_the_nulls_are_tells_rows_apart(spark):
    rows = spark.createDataFrame([(0, None, "a"), (1, "a", None), (2, "", "a"), (3, None, "a"), (4, "a", ""), (5, None, None), (6, None, None)], "id int, `x y` string, z string")
    assert sorted(r[0] for r in copies.later_copies(rows, "id").collect()) == [3, 6]
    with pytest.raises(ValueError, match="plain types"):
        copies.later_copies(rows.select("id", F.array("z").alias("a")), "id")


def test_copies_take_two_scans(spark, tmp_path):
    spark.range(9).select("id", (F.col("id") % 4).alias("x")).write.parquet(f"{tmp_path}/t")
    plan = copies.flagged(spark.read.parquet(f"{tmp_path}/t"), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


@pytest.fixture
def crowded(spark):
    """Ten thousand events, nine in ten of one user; times with many ties, which positions break."""
    rows = spark.range(10_000).select(F.col("id").alias("pos"), F.when(F.col("id") % 10 > 0, 7).when(F.col("id") % 20 > 0, F.col("id") % 5).cast("int").alias("user"), (F.xxhash64("id") % 300).alias("t"))
    return rows.withColumn("t", F.when(F.col("pos") % 50 > 0, F.col("t")))


@pytest.mark.parametrize("crowd", [10**9, 200, 3000])
def test_the_row_before_in_crowded_groups(spark, crowded, crowd):
    want = crowded.withColumn("b", F.lag(F.struct("t", "pos")).over(W.partitionBy("user").orderBy("t", "pos")))
    got = neighbours.with_before(crowded, "user", ["t", "pos"], ["t", "pos"], "b", small=0, crowd=crowd)
    assert got.columns == ["pos", "user", "t", "b"]
    assert sorted(got.collect(), key=lambda r: r["pos"]) == sorted(want.collect(), key=lambda r: r["pos"])


def test_a_crowded_group_keeps_several_tasks_busy(spark, crowded):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = lambda df: sorted((r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count("b")).collect()), reverse=True)
        whole = neighbours.with_before(crowded, "user", ["t", "pos"], ["t"], "b")
        parts = neighbours.with_before(crowded, "user", ["t", "pos"], ["t"], "b", small=0, crowd=500)
        assert rows(whole)[0] >= 9000 and len(rows(parts)) >= 4 and rows(parts)[0] < 5000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_coverage_with_null_keys(spark):
    child, parent = parameter_rows(spark, [(1,), (2,), (None,), (9,)], "k long"), parameter_rows(spark, [(1,), (2,), (2,), (None,)], "p long")
    r = tables.key_coverage(child, "k", parent, "p", "r").first()
    assert (r["n_rows"], r["null_keys"], r["matched"], r["pct_non_null"], r["pct_all"], r["status"]) == (4, 1, 2, 66.67, 50.0, "WARN")


def test_margins_tell_nulls_from_totals(spark):
    rows = parameter_rows(spark, [("a", "x"), ("a", None), (None, "x")], "a string, b string")
    got = {(r[0], r[1]): r[2] for r in tables.crosstab(rows, "a", "b").collect()}
    assert got == {("a", "x"): 1, ("a", "(null)"): 1, ("(null)", "x"): 1, ("a", "All"): 2, ("(null)", "All"): 1, ("All", "x"): 2, ("All", "(null)"): 1, ("All", "All"): 3}


def test_shapes_of_nothing(spark):
    none = parameter_rows(spark, [], "k string, v double")
    assert tables.top_share(none.groupBy("k").agg(F.sum("v").alias("v")), "v", 3, "k").first()["top_share"] is None
    assert tables.mode(none, "k").count() == 0 and tables.describe(none, "k", "v").count() == 0
    assert tables.grain(none, "t", "k").first()["is_unique"]
    assert checks.scan_totals(parameter_rows(spark, [], "rule_id string, hvfhs_license_num string, wav_requested string, n_checked long, n_failed long")).first()["error_pct"] is None


def test_control_tolerance_includes_its_bound(spark):
    rows = parameter_rows(spark, [(1005, 1000), (1006, 1000), (995, 1000), (5, 0), (5, None)], "f long, k long")
    got = rows.select(checks.compare(F.col("f"), F.col("k"), 0.5, "NOT_PUBLISHED")["status"]).collect()
    assert [r[0] for r in got] == ["MATCH", "MISMATCH", "MATCH", "MISMATCH", "NOT_PUBLISHED"]


def test_backward_pairs_and_gaps(spark):
    at = lambda m: datetime(2024, 1, 1, 0, m)
    rows = parameter_rows(spark, [("a", 1, at(5)), ("a", 2, at(3)), ("a", 3, at(9)), ("b", 1, at(1)), ("b", 2, None)], "g string, p long, t timestamp_ntz")
    assert {r[0]: r[1] for r in o.backward_pairs(rows, "g", "p", "t").collect()} == {"a": 1, "b": 0}
    assert [r["gap_min"] for r in o.gaps(rows.filter("g = 'a'"), "g", "t", "p").orderBy("t").collect()] == [None, 2.0, 4.0]


def test_samples_take_the_first_of_each_group(spark):
    rows = spark.range(100).withColumn("g", F.col("id") % 3)
    got = copies.sample_per_group(rows, ["g"], ["id"], 2)
    assert sorted(r["id"] for r in got.collect()) == [0, 1, 2, 3, 4, 5]

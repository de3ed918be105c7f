from __future__ import annotations

import datetime as dt
from decimal import Decimal

from plumbline.operators import profile

KINDS = "b boolean, i int, l bigint, f float, d double, x decimal(10,2), y decimal(20,5), s string, z binary, day date, t timestamp, n timestamp_ntz, a array<int>"


def made(spark, rows):
    return spark.createDataFrame(rows, KINDS)


def test_profile_of_all_types(spark):
    day, t = dt.date(1959, 3, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 5)
    row = (True, 5, 2**62, 0.1, float("nan"), Decimal("1.50"), Decimal("-7.00001"), "b", b"\xff", day, t, t, [1, 2])
    other = (False, -5, 2**62 + 1, 2.5, -0.0, Decimal("-2.25"), Decimal("3"), "a", b"\x01", dt.date(2020, 2, 29), t + dt.timedelta(days=9), t + dt.timedelta(microseconds=1), [0])
    got = {r["column_name"]: r for r in profile.columns(made(spark, [row, row, other, (None,) * 13, (None, 5, *[None] * 11)])).collect()}
    assert [(r["n_rows"], r["non_null"], r["n_distinct"]) for r in got.values()] == [(5, 4 if n == "i" else 3, 2) for n in got]
    ends = {n: (r["min"], r["max"], r["mean"]) for n, r in got.items()}
    assert ends["b"] == ("false", "true", None) and ends["i"] == ("-5", "5", 2.5) and ends["l"][:2] == (str(2**62), str(2**62 + 1))
    assert ends["f"] == ("0.1", "2.5", 0.9) and ends["d"][1] == "NaN" and ends["x"] == ("-2.25", "1.50", 0.25) and ends["y"][:2] == ("-7.00001", "3.00000")
    assert ends["s"] == ("a", "b", None) and ends["z"][:2] == ("01", "FF") and ends["day"] == ("1959-03-01", "2020-02-29", None)
    assert ends["t"] == ("1969-12-31 23:59:59.000005", "1970-01-09 23:59:59.000005", None) and ends["n"] == ("1969-12-31 23:59:59.000005", "1969-12-31 23:59:59.000006", None)
    assert got["s"]["null_pct"] == 40.0


def test_no_rows_and_odd_names(spark):
    got = profile.columns(made(spark, [])).collect()
    assert len(got) == 13 and all((r["n_rows"], r["non_null"], r["n_distinct"], r["min"], r["max"], r["mean"], r["null_pct"]) == (0, 0, 0, None, None, None, None) for r in got)
    odd = spark.createDataFrame([(1, "x", 2.0)], "`i` int, `a.b c` string, `n` double")
    assert {r["column_name"]: r["min"] for r in profile.columns(odd).collect()} == {"i": "1", "a.b c": "x", "n": "2.0"}


def test_one_scan(spark, tmp_path):
    made(spark, [(True, *[None] * 12)]).write.parquet(f"{tmp_path}/t")
    plan = profile.columns(spark.read.parquet(f"{tmp_path}/t"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1

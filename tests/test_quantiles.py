"""Exact quantiles by ranges against the definition."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import quantiles

SHARES = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}


@pytest.mark.parametrize("small", [0, 1 << 40])
def test_quantiles_equal_the_definition(spark, monkeypatch, small):
    monkeypatch.setattr(quantiles, "RANGES", 8)
    rng = random.Random(3)
    rows = [(k, None if rng.random() < 0.1 else rng.choice([rng.gauss(0, 9), float(rng.randrange(4)), 1e300 * rng.random()])) for k in ("a", "a", "a", "b", None) for _ in range(120)]
    rows += [("one", 2.5), ("none", None), *[("same", 7.0)] * 500]
    of = {**{n: ("v", s) for n, s in SHARES.items()}, "other": ("w", 0.5)}
    got = quantiles.exact(spark.createDataFrame([(k, v, None if v is None else -v) for k, v in rows], "k string, v double, w double").repartition(5), ["k"], of, small=small)
    assert got.columns == ["k", *SHARES, "other"]
    found = {r["k"]: list(r)[1:] for r in got.collect()}
    assert found.pop("none") == [None] * 6
    want = {k: np.array([v for x, v in rows if x == k and v is not None]) for k in {k for k, _ in rows}}
    assert set(found) == {k for k, v in want.items() if len(v)}
    for k, (*q, middle) in found.items():
        np.testing.assert_allclose(middle, -np.quantile(want[k], 0.5), rtol=1e-12, atol=1e-12)
        np.testing.assert_allclose(q, np.quantile(want[k], list(SHARES.values())), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("small", [0, 1 << 40])
def test_whole_tables_and_groups_without_values(spark, small):
    rows = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, None), (None, 5.0)], "k int, v double")
    whole = quantiles.exact(rows, [], {"m": ("v", 0.5)}, [F.count("*").alias("count")], small).collect()
    assert [tuple(r) for r in whole] == [(4, 2.0)]
    by = quantiles.exact(rows, ["k"], {"m": ("v", 0.5), "h": ("v", 0.9)}, [F.count("*").alias("count")], small).collect()
    assert {(r["k"], r["count"], r["m"]) for r in by} == {(1, 2, 1.5), (2, 1, None), (None, 1, 5.0)}
    assert quantiles.exact(rows.limit(0), ["k"], {"m": ("v", 0.5)}, small=small).count() == 0


def test_four_measures_take_one_scan(spark, tmp_path):
    spark.createDataFrame([(i % 3, float(i), i * 2.0, -i * 1.0, i % 7 * 1.0) for i in range(90)], "k int, a double, b double, c double, d double").write.parquet(f"{tmp_path}/t")
    got = quantiles.exact(spark.read.parquet(f"{tmp_path}/t"), ["k"], {f"m_{c}": (c, 0.5) for c in "abcd"}, [F.count("*").alias("n")])
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {tuple(r)[:4] for r in got.collect()} == {(0, 30, 43.5, 87.0), (1, 30, 44.5, 89.0), (2, 30, 45.5, 91.0)}

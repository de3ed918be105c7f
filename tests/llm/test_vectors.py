from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import vectors as v

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.95):
    """(vec_id, n_links, component_id, kept) of rows whose vec_ids differ, by all pairs."""
    good = [i for i, (_, x) in enumerate(rows) if x is not None and len(x) and all(y is not None and np.isfinite(y) for y in x) and any(x)]
    near = {i: [] for i in range(len(rows))}
    for dim in {len(rows[i][1]) for i in good}:
        own = [i for i in good if len(rows[i][1]) == dim]
        x = np.array([rows[i][1] for i in own], dtype=np.float32).astype(float)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        for a, b in np.argwhere(x @ x.T >= cosine):
            if a != b:
                near[own[a]].append(own[b])
    label = list(range(len(rows)))
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        label[i] = min(rows[j][0] for j in seen)
    return {(r[0], len(near[i]), label[i], label[i] == r[0]) for i, r in enumerate(rows)}


def made(rng, n, groups, dim=64):
    """Random vectors and groups of (size, noise) around random centres; cosines within a group are about 1 / (1 + noise**2)."""
    out = [rng.standard_normal((n, dim))]
    for size, noise in groups:
        out.append(rng.standard_normal(dim) + noise * rng.standard_normal((size, dim)))
    x = np.concatenate(out).astype(np.float32)
    return [(i * 3 + 1, r.tolist()) for i, r in enumerate(rng.permutation(x))]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA).repartition(5)
    return [tuple(r) for r in v.near_vectors(df, **kw).collect()]


def test_equals_all_pairs(spark):
    rng = np.random.default_rng(1)
    rows = made(rng, 800, [(60, 0.1), (40, 0.18), (30, 0.22), (25, 0.25), (3, 0.1), (2, 0.15)] + [(2, 0.2)] * 40)
    got = run(spark, rows)
    assert len(got) == len(rows)
    want = brute(rows)
    assert sum(r[1] for r in want) > 3000
    assert set(got) == want


def test_recall_right_at_the_least_cosine():
    """Pairs right at the cosine, counted as the operator counts."""
    rng = np.random.default_rng(2)
    p = v.plan(10_000)
    n = 4000
    a = v.unit(rng.standard_normal((n, 64)))
    b = rng.standard_normal((n, 64))
    b = v.unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    b = 0.9501 * a + np.sqrt(1 - 0.9501**2) * b
    hits = np.zeros(n, dtype=int)
    for _, d in v._directions(64, p.directions):
        x, y = a.astype(np.float32) @ d, b.astype(np.float32) @ d
        hits += ((np.abs(x) >= p.least) & (np.abs(y) >= p.least) & (np.abs(x - y) <= p.window)).sum(axis=1)
    s = v._block(64, 0, v.SIGNS, 3)
    signs = ((a @ s >= 0) != (b @ s >= 0)).sum(axis=1)
    assert ((hits >= p.count) & (signs <= p.signs)).mean() >= 0.999
    expected = 2 * p.directions * v.collision(0.9501, p.least, p.window)
    assert abs(hits.mean() / expected - 1) < 0.05


def test_a_group_with_a_third_of_the_rows(spark, monkeypatch):
    """Also in crowded lines that are cut into chunks, with and without balls."""
    rng = np.random.default_rng(3)
    rows = made(rng, 600, [(400, 0.08), (150, 0.21)])
    want = brute(rows)
    assert set(run(spark, rows)) == want
    monkeypatch.setattr(v, "CHUNK", 40)
    assert set(run(spark, rows)) == want
    monkeypatch.setattr(v, "_balls", lambda c, cosine, scratch: c.withColumn("ball", F.lit(None).cast("long")))
    assert set(run(spark, rows)) == want


def test_copies_are_one_class(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal(16)
    rows = [(i, x.tolist()) for i in range(50)] + [(100 + i, (2 * x).tolist()) for i in range(3)] + [(200 + i, r.tolist()) for i, r in enumerate(rng.standard_normal((30, 16)))]
    assert set(run(spark, rows)) == brute(rows)


def test_awkward_vectors(spark):
    e = [1.0, 0.0, 0.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, -0.0]), (4, [1.0, None, 0.0]), (5, [float("nan"), 1.0, 0.0]), (6, [float("inf"), 0.0, 0.0]), (7, e), (8, [3e38, 0.0, -0.0]), (9, [1e-40, 0.0, 0.0]), (10, [1.0, 0.0]), (11, [2.0, 0.0]), (12, [-1.0, 0.0, 0.0])]
    assert set(run(spark, rows)) == brute(rows)
    rows = [(7, e), (7, e), (7, [0.0, 1.0, 0.0]), (None, [0.0, 2.0, 0.0]), (None, [0.0, 0.0, 1.0]), (None, None)]
    got = sorted(run(spark, rows), key=str)
    assert got == sorted([(7, 1, 7, True), (7, 1, 7, True), (7, 1, 7, True), (None, 1, 7, False), (None, 0, None, False), (None, 0, None, False)], key=str)


def test_no_rows_and_clashing_columns(spark):
    assert v.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    more = {c: F.lit("x") for c in ("row", "node", "n", "ball", "line", "grid", "side", "value", "bits", "fp_a", "fp_b", "vector", "component_id", "n_links", "kept", "l_", "v")}
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0)], SCHEMA).withColumns(more)
    out = v.near_vectors(df)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert {tuple(r) for r in out.collect()} == {(1, 1, 1, True), (2, 1, 1, False)}


@pytest.mark.parametrize("rows", [1, 500, 10**6, 10**9])
def test_plans_keep_the_recall(rows):
    p = v.plan(rows)
    hit = 2 * v.collision(0.95, p.least, p.window)
    assert v._at_least(p.directions, hit, p.count) >= 1 - 1e-4
    assert v.LEAST <= p.directions <= v.MOST

from __future__ import annotations

import random

from plumbline.operators import versions as v


def test_equal_neighbours_are_one_version(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 5, "y"), ("a", 7, None), ("a", 9, None), ("b", 3, "z"), (None, 4, "n"), ("a", None, "q")], "k string, at int, name string")
    got = {tuple(r) for r in v.versions(rows, ["k"], "at", ["name"]).collect()}
    assert got == {("a", "x", 1, 5), ("a", "y", 5, 7), ("a", None, 7, None), ("b", "z", 3, None), (None, "n", 4, None)}


def test_as_of_equals_a_search(spark):
    rng = random.Random(1)
    seen = [(rng.randrange(4), rng.randrange(40), i, rng.choice("xyz")) for i in range(90)]
    facts = [(i, rng.choice((None, 0, 1, 2, 3, 9)), rng.choice((None, *range(45)))) for i in range(300)]
    snap = spark.createDataFrame(seen, "k int, at int, no int, name string")
    got = {(r["id"], r["name"]) for r in v.as_of(spark.createDataFrame(facts, "id int, k int, t int"), v.versions(snap, ["k"], "at", ["name"], tie=["no"]), ["k"], "t").collect()}
    want = set()
    for i, k, t in facts:
        before = [s for s in seen if s[0] == k and t is not None and s[1] <= t]
        want.add((i, max(before, key=lambda s: (s[1], s[2]))[3] if before else None))
    assert got == want and len(got) == 300
